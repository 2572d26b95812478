"""Time helpers (F5, F6, F7, F9 and the W4 range predicate).

All conversions are written so they do not depend on the session time zone:
TIMESTAMP_NTZ values are treated as UTC wall-clock time, `t` is epoch ms UTC, and zone
shifts use `convert_timezone`, which handles daylight-saving changes (23/25-hour days).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

def _epoch() -> Column:
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
NEW_YORK = "America/New_York"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def epoch_millis(ntz) -> Column:
    """TIMESTAMP_NTZ (UTC wall clock) -> epoch milliseconds (bigint), floor semantics.

    Built from the calendar day and the time-of-day fields, which NTZ values carry without
    any zone, so the result does not depend on the session time zone (casting to TIMESTAMP
    would apply the session zone's offset).
    """
    c = _c(ntz)
    millis_of_day = (F.hour(c) * 3_600_000 + F.minute(c) * 60_000
                     + F.floor(F.date_part(F.lit("SECOND"), c) * 1000)).cast("bigint")
    return F.unix_date(F.to_date(c)).cast("bigint") * 86_400_000 + millis_of_day


def epoch_millis_of_instant(ts) -> Column:
    """TIMESTAMP (an instant) -> epoch milliseconds (bigint)."""
    return F.unix_millis(_c(ts))


def utc_ntz_from_millis(ms) -> Column:
    """Epoch milliseconds -> TIMESTAMP_NTZ holding the UTC wall clock (F9 inverse)."""
    return F.timestamp_add("MILLISECOND", _c(ms), _epoch())


def instant_from_millis(ms) -> Column:
    """Epoch milliseconds -> TIMESTAMP instant."""
    return F.timestamp_millis(_c(ms))


def wall_clock(ntz_utc, tz: str) -> Column:
    """UTC wall clock -> wall clock in `tz` (both TIMESTAMP_NTZ)."""
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), _c(ntz_utc))


def utc_from_wall_clock(ntz_local, tz: str) -> Column:
    return F.convert_timezone(F.lit(tz), F.lit("UTC"), _c(ntz_local))


def local_day(ntz_utc, tz: str = NEW_YORK) -> Column:
    """Calendar date of a UTC instant as seen in `tz` (F5 applied to a given instant)."""
    return F.to_date(wall_clock(ntz_utc, tz))


def local_day_text(ntz_utc, tz: str = NEW_YORK) -> Column:
    """`yyyy-MM-dd` text of the `tz` calendar day of a UTC instant."""
    return F.date_format(wall_clock(ntz_utc, tz), "yyyy-MM-dd")


def days_before(day, n: int) -> Column:
    """`day - n days`."""
    return F.date_sub(_c(day), n)


def ymd_text(day) -> Column:
    """date -> `yyyy-MM-dd`."""
    return F.date_format(_c(day), "yyyy-MM-dd")


def as_date(value) -> Column:
    """A literal date / `yyyy-MM-dd` string / Column -> date Column."""
    if isinstance(value, Column):
        return F.to_date(value)
    if isinstance(value, _dt.datetime):
        value = value.date()
    if isinstance(value, _dt.date):
        value = value.isoformat()
    return F.lit(value).cast("date")


def in_day_range(ts, start, end) -> Column:
    """Inclusive day range [start, end] as a half-open timestamp range.

    `ts >= start AND ts < end + 1 day` keeps both end days whole and stays a plain
    comparison on the stored column, so Parquet min/max pushdown applies.
    """
    col = _c(ts)
    lo = as_date(start).cast("timestamp_ntz")
    hi = F.date_add(as_date(end), 1).cast("timestamp_ntz")
    return (col >= lo) & (col < hi)


def in_day_range_millis(t, start, end) -> Column:
    """W4 for epoch-ms bar times: [start 00:00 UTC, end + 1 day 00:00 UTC)."""
    lo = epoch_millis(as_date(start).cast("timestamp_ntz"))
    hi = epoch_millis(F.date_add(as_date(end), 1).cast("timestamp_ntz"))
    col = _c(t)
    return (col >= lo) & (col < hi)
