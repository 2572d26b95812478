"""Token ids as flat binary files.

A part is three files without headers, little-endian: `.ids` (unsigned integers, 2 bytes each
where the vocabulary allows it, else 4), `.off` (unsigned 64-bit, one more than the documents:
document i holds ids off[i] .. off[i + 1] - 1 of the part) and `.doc` (signed 64-bit document
ids; the lowest value stands for null). Parts hold ascending ranges of document ids; the
manifest has a row per part, and the first place of each part among all ids and all documents
is a prefix sum over it.

A part is written under its task attempt's own name and counts only if the landed manifest
names it, so lost or repeated attempts leave nothing that is read. Files go to the shared folder
of spark.checkpoint.dir and are memory-mapped where that is a mounted path."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from .common import land, shared_dir, ship_package, shuffle_partitions, slices
from .tokens import bpe_json_path, worker_encoder

NULL_ID = -(1 << 63)
MANIFEST = "pid bigint, path string, width int, n_docs bigint, n_ids bigint"


def write_token_files(docs: DataFrame, end_id: int | None = 2, key: str = "doc_id",
                      text: str = "text", vocabulary: str | None = None,
                      partitions: int | None = None, directory: str | None = None) -> DataFrame:
    """Encode all texts and write them in ascending order of the (integer) key; returns the landed
    manifest: pid, path (without the endings), width, n_docs, n_ids, first_doc, first_id.

    A null or empty text is its end id alone (or, without one, no ids); null keys come first;
    repeated rows are written each, those of one key in order of their texts' hashes; an empty
    table gives an empty manifest; other columns are not read."""
    spark = docs.sparkSession
    ship_package(spark)
    path = vocabulary or bpe_json_path()
    directory = directory or shared_dir(spark, "llm", "token-files")
    rows = (docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
            .repartitionByRange(partitions or shuffle_partitions(spark), "doc_id")
            .sortWithinPartitions("doc_id", F.xxhash64("text")))

    def write(batches):
        from pyarrow import fs
        enc = worker_encoder(path)
        tail = b"" if end_id is None else end_id.to_bytes(enc.width, "little")
        task = TaskContext.get()
        name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}"
        store, root = fs.FileSystem.from_uri(directory)
        outs, n_docs, n_ids = None, 0, 0
        for b in slices(batches, 1000):
            if outs is None:
                store.create_dir(root, recursive=True)
                outs = [store.open_output_stream(f"{root}/{name}{e}") for e in (".ids", ".off", ".doc")]
                outs[1].write((0).to_bytes(8, "little"))
            lengths = np.empty(b.num_rows, np.uint64)
            for i, t in enumerate(b["text"].to_pylist()):
                raw = enc.encode(t or "") + tail
                lengths[i] = len(raw) // enc.width
                outs[0].write(raw)
            outs[1].write((np.uint64(n_ids) + np.cumsum(lengths)).astype("<u8").tobytes())
            outs[2].write(b["doc_id"].fill_null(NULL_ID).to_numpy().astype("<i8").tobytes())
            n_docs += b.num_rows
            n_ids += int(lengths.sum())
        if outs is not None:
            for o in outs:
                o.close()
            yield pa.record_batch([pa.array([v]) for v in (task.partitionId(), f"{directory}/{name}")]
                                  + [pa.array([enc.width], pa.int32()), pa.array([n_docs]), pa.array([n_ids])],
                                  ["pid", "path", "width", "n_docs", "n_ids"])

    manifest = land(rows.mapInArrow(write, MANIFEST), "token-manifest")
    earlier = Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)  # a row per part
    return land(manifest.withColumns({
        "first_doc": F.coalesce(F.sum("n_docs").over(earlier), F.lit(0)),
        "first_id": F.coalesce(F.sum("n_ids").over(earlier), F.lit(0))}), "token-manifest")


def _mapped(store, path: str, dtype: str, n: int) -> np.ndarray:
    from pyarrow import fs
    if n == 0:
        return np.empty(0, dtype)
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(path, dtype, "r", shape=(n,))
    with store.open_input_file(path) as f:
        return np.frombuffer(f.read(), dtype)


def read_token_files(manifest: DataFrame, with_ids: bool = False, partitions: int | None = None) -> DataFrame:
    """One row per document of the files: doc_id, start (ids of all documents before it), n_tokens,
    ids_crc32 (of its ids as little-endian unsigned 32-bit integers), and with `with_ids` those
    bytes."""
    spark = manifest.sparkSession
    ship_package(spark)
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + (
        ", ids binary" if with_ids else "")

    def read(batches):
        from pyarrow import fs
        for b in batches:
            for part in b.to_pylist():
                store, at = fs.FileSystem.from_uri(part["path"])
                n = part["n_docs"]
                ids = _mapped(store, at + ".ids", f"<u{part['width']}", part["n_ids"])
                off = _mapped(store, at + ".off", "<u8", n + 1).astype(np.int64)
                doc = _mapped(store, at + ".doc", "<i8", n)
                for lo in range(0, n, 4096):
                    hi = min(lo + 4096, n)
                    raws = [ids[off[i]:off[i + 1]].astype("<u4").tobytes() for i in range(lo, hi)]
                    some = np.asarray(doc[lo:hi])
                    cols = [pa.array(some, pa.int64(), mask=some == NULL_ID),
                            pa.array(off[lo:hi] + part["first_id"]), pa.array(np.diff(off[lo:hi + 1])),
                            pa.array([zlib.crc32(r) for r in raws], pa.int64())]
                    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                    if with_ids:
                        cols.append(pa.array(raws, pa.binary()))
                        names.append("ids")
                    yield pa.record_batch(cols, names)

    dealt = manifest.repartition(partitions or shuffle_partitions(spark), "pid")
    return dealt.mapInArrow(read, schema)
