"""Session helpers.

`local_session` is what tests and the bench use. Library operators never create a session;
they receive DataFrames. `shared_dir` gives a fresh folder
inside the cluster's shared checkpoint location (``spark.checkpoint.dir``), which is where round-trip
writes, streaming checkpoints and lineage cuts go; `clear_scratch` deletes an application's.
Only on a local master may the setting be missing: a new temporary folder then stands in.
"""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_FALLBACK_ROOT: str | None = None


def local_session(cores: str | int = "*", shuffle_partitions: int = 8,
                  app: str = "tickweave", driver_memory: str | None = None) -> SparkSession:
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         # local mode: list many partition folders with a few tasks, not one task per folder
         .config("spark.sql.sources.parallelPartitionDiscovery.parallelism", str(max(8, shuffle_partitions))))
    if driver_memory:
        b = b.config("spark.driver.memory", driver_memory)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; where it is unset, a new local one on a
    local master, and an error on any other: executors would not see it."""
    global _FALLBACK_ROOT
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if _FALLBACK_ROOT is None:
        _FALLBACK_ROOT = tempfile.mkdtemp(prefix="tickweave-ckpt-")
        spark.sparkContext.setCheckpointDir(_FALLBACK_ROOT)
    return _FALLBACK_ROOT


def _scratch_root(spark: SparkSession) -> str:
    return f"{checkpoint_root(spark)}/tickweave/{spark.conf.get('spark.app.id', 'app')}"


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A new, unique folder path under the shared checkpoint root (not created yet)."""
    sub = "/".join(p.strip("/") for p in parts if p)
    return f"{_scratch_root(spark)}/{sub}/{uuid.uuid4().hex}"


def land(df: DataFrame, label: str) -> DataFrame:
    """Write `df` as Parquet in the shared scratch folder and read it back."""
    path = shared_dir(df.sparkSession, "landed", label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> None:
    """Delete everything this application has put under the shared checkpoint root. For the caller,
    when no DataFrame that reads it is used any more."""
    delete_dir(spark, _scratch_root(spark))


def _at(spark: SparkSession, path: str):
    """A path and the file system it is in."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def delete_dir(spark: SparkSession, path: str) -> None:
    at, fs = _at(spark, path)
    fs.delete(at, True)


def input_bytes(spark: SparkSession, *paths: str) -> int:
    """The size of the files under `paths`."""
    return sum(fs.getContentSummary(at).getLength() for at, fs in (_at(spark, p) for p in paths))


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished jobs. It does when the driver collects their owners as
    garbage, which on a driver with little to do may be never: a long flow asks between its steps."""
    gc.collect()
    spark._jvm.System.gc()


def is_local_path(path: str) -> bool:
    return "://" not in path or path.startswith("file:")


def local_fs_path(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path


def ensure_local_dir(path: str) -> None:
    """Create a local folder (used only for the file: scheme, e.g. test landing areas)."""
    if is_local_path(path):
        os.makedirs(local_fs_path(path), exist_ok=True)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make `tickweave` importable in executor Python workers (as `--py-files` would).

    Operators that run Python on executors (UDFs, mapInPandas) pickle functions by module
    reference, so the package must be on the workers' path. Zips the installed package once per
    application and registers it with `addPyFile`; Spark distributes it to every executor.
    """
    import hashlib
    import zipfile

    try:
        sc = spark.sparkContext
        app = sc.applicationId
    except Exception:  # noqa: BLE001 - Spark Connect: ship as a session artifact instead
        sc, app = None, f"connect-{spark.session_id}"
    if app in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    files = []
    for root, _dirs, names in os.walk(pkg_dir):
        if "__pycache__" in root:
            continue
        files.extend(os.path.join(root, n) for n in sorted(names) if n.endswith(".py"))
    digest = hashlib.sha256()
    for f in sorted(files):
        with open(f, "rb") as fh:
            digest.update(f.encode() + fh.read())
    root_dir = checkpoint_root(spark)
    target_dir = local_fs_path(root_dir) if is_local_path(root_dir) else tempfile.mkdtemp(prefix="tickweave-py-")
    target_dir = os.path.join(target_dir, "tickweave", "pyfiles")
    os.makedirs(target_dir, exist_ok=True)
    target = os.path.join(target_dir, f"tickweave-{digest.hexdigest()[:16]}.zip")
    if not os.path.exists(target):
        tmp = f"{target}.{uuid.uuid4().hex}.tmp"
        with zipfile.ZipFile(tmp, "w", zipfile.ZIP_DEFLATED) as z:
            for f in files:
                z.write(f, os.path.join("tickweave", os.path.relpath(f, pkg_dir)))
        os.replace(tmp, target)
    if sc is not None:
        sc.addPyFile(target)
    else:
        spark.addArtifacts(target, pyfile=True)
    _SHIPPED.add(app)
