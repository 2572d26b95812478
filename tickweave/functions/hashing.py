"""Hashes and ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: the null marker and field separator of the collision-safe row id
NULL_MARKER = "∅"
FIELD_SEP = "|"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def md5_of_text(col) -> Column:
    """lower-hex MD5 of the value's decimal text (e.g. an epoch-ms timestamp)."""
    return F.md5(_c(col).cast("string"))


def murmur_fingerprint(*cols) -> Column:
    """hex of Spark's 32-bit Murmur3 over the given columns, in the given order.

    A fingerprint only: 32 bits collide often at scale and nulls are skipped, so
    (1, null) and (null, 1) hash alike. Use `row_id` as a key.
    """
    return F.hex(F.hash(*[_c(c) for c in cols]))


def _escaped(col: Column) -> Column:
    """Text in which separators and the null marker cannot be mistaken for the real ones."""
    for c in ("\\", FIELD_SEP, NULL_MARKER):
        col = F.replace(col, F.lit(c), F.lit("\\" + c))
    return col


def _canonical_text(col: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        text = _escaped(col)
    elif isinstance(dtype, T.DateType):
        text = F.date_format(col, "yyyy-MM-dd")
    elif isinstance(dtype, T.TimestampNTZType):
        text = F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    elif isinstance(dtype, T.TimestampType):
        text = F.unix_micros(col).cast("string")  # an instant, whatever the session's time zone
    elif isinstance(dtype, (T.DoubleType, T.FloatType)):
        text = F.when(col == 0, F.lit(0).cast(dtype)).otherwise(col).cast("string")  # -0.0 equals 0.0
    else:
        # numbers: Spark's text form of a double is the shortest text that reads back to the
        # same value, so distinct values never share a text
        text = col.cast("string")
    return F.coalesce(text, F.lit(NULL_MARKER))


def row_id(df_schema: T.StructType, cols: list[str], **made: Column) -> Column:
    """Collision-safe id = SHA-256 over the canonical text of `cols` joined by `|`.

    Text columns escape the separator and the null marker, nulls become that marker, dates and
    zone-free times use a fixed format, instants their microseconds and numbers their shortest
    exact text, so equal rows give equal ids and (1, null) differs from (null, 1). `made`: columns that
    are not there yet, as what they will be.
    """
    types = {f.name: f.dataType for f in df_schema.fields}
    parts = [_canonical_text(made.get(c, F.col(c)), types[c]) for c in cols]
    return F.sha2(F.concat_ws(FIELD_SEP, *parts), 256)


def sha256_hex(col) -> Column:
    """SHA-256 lower-hex of a key's UTF-8 bytes."""
    return F.sha2(_c(col).cast("string"), 256)


def batch_key(hash_col, day_col) -> Column:
    """`<hash>-<yyyy-MM-dd>` folder/batch key."""
    return F.concat_ws("-", _c(hash_col), F.date_format(_c(day_col), "yyyy-MM-dd"))


def bar_id(ticker, t, multiplier: int = 1, timespan: str = "day") -> Column:
    """Bar key per (ticker, t, multiplier, timespan): two tickers on one day never share it; null
    without a ticker or a time, which `idempotent_append` keeps apart."""
    return F.sha2(F.concat(_escaped(_c(ticker)), F.lit(FIELD_SEP), _c(t).cast("string"),
                           F.lit(f"{FIELD_SEP}{multiplier}{FIELD_SEP}{timespan}")), 256)
