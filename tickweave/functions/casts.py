"""Casts (F8)."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def narrow_to_float(df: DataFrame, cols: list[str]) -> DataFrame:
    """F8: narrow the given double columns to 32-bit float (loses precision; opt-in only)."""
    return df.withColumns({c: F.col(c).cast("float") for c in cols})
