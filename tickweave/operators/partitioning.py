"""User-level partitioning and reuse hints."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame


def spread(df: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Round-robin to `num_partitions` before a sink; without a number, a `rebalance`
    hint lets AQE pick evenly sized partitions."""
    return df.repartition(num_partitions) if num_partitions else df.hint("rebalance")


def by_key(df: DataFrame, *keys: str, num_partitions: int | None = None) -> DataFrame:
    """R2: rows of a key together, as far as evenly sized partitions allow: a `rebalance` hint on the
    key, whose large partitions AQE splits."""
    return df.hint("rebalance", *([num_partitions] if num_partitions else []), *keys)


def reuse(df: DataFrame) -> DataFrame:
    """Keep a table that feeds several branches (memory, spilling to disk). Lost blocks are
    recomputed from lineage, so inputs must be deterministic; land to Parquet otherwise. The
    caller owns it and calls `unpersist()` when the branches are written."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)
