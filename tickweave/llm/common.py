"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from tickweave.session import shared_dir, ship_package

LOCAL_BITS = 33  # monotonically_increasing_id(): partition number above, row number below


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batches, rows: int):
    """Record batches of at most `rows` rows, so that what a task makes of one stays small."""
    return (b.slice(at, rows) for b in batches for at in range(0, b.num_rows, rows))


def land(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write `df` as Parquet in the shared folder of spark.checkpoint.dir and read it back:
    a lineage cut that survives lost executors, with its rows and partition numbers fixed."""
    path = shared_dir(df.sparkSession, "llm", label)
    df.write.options(**{"compression": "zstd", **options}).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._landed_at = path
    return out


def drop_landed(df: DataFrame) -> None:
    """Delete the folder of a `land`ed table that nothing will read any more."""
    spark, path = df.sparkSession, df._landed_at
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(p, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def task_ordinals(df: DataFrame) -> DataFrame:
    """Add `pid` (partition number) and `lid` (row number in it) of the current partitioning."""
    mid = F.monotonically_increasing_id()
    return (df.withColumn("_mid", mid)
            .withColumn("pid", F.shiftright("_mid", LOCAL_BITS))
            .withColumn("lid", F.col("_mid").bitwiseAND((1 << LOCAL_BITS) - 1))
            .drop("_mid"))


def bases(numbered: DataFrame, group: list[str], amount) -> DataFrame:
    """Exclusive prefix sums of `amount` over `pid` within `group`: one row for each pair of a
    partition and a group it holds, columns pid, *group, base, amount_sum, first_lid.
    The window sees one row per partition and group, never the rows themselves."""
    per = numbered.groupBy("pid", *group).agg(F.sum(amount).alias("amount_sum"),
                                              F.min("lid").alias("first_lid"))
    w = Window.partitionBy(*(group or [F.lit(0)])).orderBy("pid") \
        .rowsBetween(Window.unboundedPreceding, -1)
    return per.withColumn("base", F.coalesce(F.sum("amount_sum").over(w), F.lit(0)).cast("long"))


__all__ = ["table", "land", "slices", "drop_landed", "shuffle_partitions", "task_ordinals", "bases",
           "ship_package", "shared_dir"]
