"""Row filters (W1-W7). All are plain column predicates so they push below joins and into
Parquet scans; "today" is always an `as_of` argument, never the clock."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..defaults import EXPIRY_LOOKBACK_DAYS
from ..functions.arrays import empty_if_null, nonempty
from ..functions.timefns import as_date, epoch_millis, in_day_range_millis


def drop_null(df: DataFrame, col: str = "ticker") -> DataFrame:
    """W1."""
    return df.where(F.col(col).isNotNull())


def expiring_since(df: DataFrame, as_of, days: int = EXPIRY_LOOKBACK_DAYS, col: str = "expiration_date") -> DataFrame:
    """`expiration_date >= as_of - days`."""
    return df.where(F.col(col) >= F.date_sub(as_date(as_of), days))


def by_expired_flag(df: DataFrame, as_of, expired: bool = False, col: str = "expiration_date") -> DataFrame:
    """Expired contracts (expiration before `as_of`) or, by default, unexpired ones.

    A contract expiring on `as_of` itself counts as not expired.
    """
    day = as_date(as_of)
    return df.where(F.col(col) < day) if expired else df.where(F.col(col) >= day)


def bars_in_day_range(df: DataFrame, start, end, col: str = "t") -> DataFrame:
    """Bars whose epoch-ms start lies in the inclusive UTC day range [start, end]."""
    return df.where(in_day_range_millis(col, start, end))


def bars_since(df: DataFrame, start, col: str = "t") -> DataFrame:
    """W4 with an open end: bars from the UTC day `start` on."""
    return df.where(F.col(col) >= epoch_millis(as_date(start).cast("timestamp_ntz")))


def for_underlyings(df: DataFrame, underlyings, col: str = "underlying_ticker") -> DataFrame:
    """One underlying (equality), a short literal list (IN), or a DataFrame of them (semi join)."""
    if isinstance(underlyings, DataFrame):
        keys = underlyings.select(F.col(underlyings.columns[0]).alias(col)).distinct()
        return df.join(keys, col, "left_semi")
    if isinstance(underlyings, (list, tuple, set)):
        return df.where(F.col(col).isin(list(underlyings)))
    return df.where(F.col(col) == underlyings)


def with_results(df: DataFrame, col: str = "results") -> DataFrame:
    """Drop records whose array is null or empty."""
    return df.where(nonempty(col))


def null_results_to_empty(df: DataFrame, col: str = "results") -> DataFrame:
    """Null arrays become empty arrays of the same type."""
    return df.withColumn(col, empty_if_null(col, df.schema[col].dataType))


def tag_missing(df: DataFrame, required: dict[str, str], name: str = "dropped") -> DataFrame:
    """W1 with a record of what it drops: a column `name` with the reason of the first column of
    `required` (column -> reason) that is null, itself null for a row to keep. Kept and dropped rows come
    from one pass: land the result, then take `name IS NULL` and `IS NOT NULL` of it."""
    why = F.coalesce(*[F.when(F.col(c).isNull(), F.lit(reason)) for c, reason in required.items()])
    return df.withColumn(name, why)
