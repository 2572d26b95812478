"""Union-all accumulation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def union_all(parts: list[DataFrame], schema: T.StructType | None = None,
              spark: SparkSession | None = None) -> DataFrame:
    """By-name union of many frames in one plan, starting from an empty typed table when
    `schema` is given (so an empty input list still has the right columns)."""
    frames = list(parts)
    if schema is not None:
        session = spark or (frames[0].sparkSession if frames else SparkSession.active())
        frames.insert(0, session.createDataFrame([], schema))
    if not frames:
        raise ValueError("union_all needs at least one frame or a schema")
    return reduce(lambda a, b: a.unionByName(b), frames)
