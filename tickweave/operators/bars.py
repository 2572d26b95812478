"""OHLCV bars: build from ticks (A3) and roll finer bars up into coarser ones (A4).

Both are one `groupBy(ticker, bucket)` with map-side partial aggregation, so a hot ticker is
pre-combined inside every map task and ships at most one partial row per task and bucket:
no group is ever gathered whole in one place.

Buckets: minute/hour/day are fixed widths aligned to the epoch (with `tz`: days of that zone, and
minutes and hours counted from their first instant); week buckets start on Monday, month/quarter/year on the first day of the period,
counted from 1970 so multipliers > 1 are stable. `t` is the bucket start in epoch ms UTC.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timefns import epoch_millis, utc_from_wall_clock, utc_ntz_from_millis, wall_clock
from ..schemas import TIMESPANS

_FIXED_MS = {"minute": 60_000, "hour": 3_600_000, "day": 86_400_000}
_MONTHS = {"month": 1, "quarter": 3, "year": 12}


def bucket_start(ntz: Column, multiplier: int, timespan: str) -> Column:
    """Start of the `multiplier x timespan` bucket holding wall-clock time `ntz` (TIMESTAMP_NTZ)."""
    if timespan not in TIMESPANS:
        raise ValueError(f"timespan must be one of {TIMESPANS}, got {timespan!r}")
    if multiplier < 1:
        raise ValueError("multiplier must be >= 1")
    if timespan in _FIXED_MS:
        width = multiplier * _FIXED_MS[timespan]
        ms = epoch_millis(ntz)
        return utc_ntz_from_millis(ms - F.pmod(ms, F.lit(width)))
    day = F.to_date(ntz)
    if timespan == "week":
        monday = F.lit("1970-01-05").cast("date")  # the first Monday after the epoch
        days = F.datediff(day, monday)
        start = F.date_add(monday, days - F.pmod(days, F.lit(7 * multiplier)))
    else:
        months = (F.year(day) - 1970) * 12 + F.month(day) - 1
        start = F.add_months(F.lit("1970-01-01").cast("date"), months - F.pmod(months, F.lit(_MONTHS[timespan] * multiplier)))
    return start.cast("timestamp_ntz")


def _bucket_t(ntz_utc: Column, multiplier: int, timespan: str, tz: str | None) -> Column:
    """Bucket start in epoch ms. With `tz`, spans below a day are counted on the time line from the
    instant the local day begins, so the repeated hour of an autumn clock change stays two."""
    if tz is None:
        return epoch_millis(bucket_start(ntz_utc, multiplier, timespan))
    if timespan in ("minute", "hour"):
        day = epoch_millis(utc_from_wall_clock(bucket_start(wall_clock(ntz_utc, tz), 1, "day"), tz))
        since = epoch_millis(ntz_utc) - day
        return day + since - F.pmod(since, F.lit(multiplier * _FIXED_MS[timespan]))
    local = bucket_start(wall_clock(ntz_utc, tz), multiplier, timespan)
    return epoch_millis(utc_from_wall_clock(local, tz))


def _order_key(ntz: Column, tick_id: Column) -> Column:
    """(time, id) as one number: microseconds * 2^64 and the id counted from the lowest. Aggregates
    ordered by it hash; by a struct they would sort."""
    micros = epoch_millis(ntz) * 1000 + F.pmod(F.floor(F.date_part(F.lit("SECOND"), ntz) * 1_000_000), F.lit(1000))
    high = micros.cast("decimal(18,0)") * F.expr("CAST('18446744073709551616' AS DECIMAL(20,0))")
    low = F.coalesce(tick_id.cast("bigint"), F.lit(-(1 << 63))).cast("decimal(20,0)") \
        + F.expr("CAST('9223372036854775808' AS DECIMAL(19,0))")
    return (high + low).cast("decimal(38,0)")


def _vwap(pv: str, v: str) -> Column:
    return F.when(F.col(v) != 0, F.col(pv) / F.col(v))


def bars_from_ticks(ticks: DataFrame, multiplier: int = 1, timespan: str = "day", tz: str | None = None,
                    *, ticker: str = "ticker", ts: str = "ts", price: str = "price",
                    size: str = "size", tick_id: str = "tick_id") -> DataFrame:
    """A3: ticks -> bars `ticker, c, h, l, n, o, t, v, vw`.

    open/close are the first/last price by (ts, tick_id), so equal timestamps break ties the
    same way on every run (a whole tick id; a null one sorts first); vwap is sum(price*size)/sum(size), null when volume is 0.
    `ts` is a TIMESTAMP_NTZ holding UTC wall-clock time.
    """
    order = _order_key(F.col(ts), F.col(tick_id))
    keyed = ticks.select(
        F.col(ticker).alias("ticker"),
        _bucket_t(F.col(ts), multiplier, timespan, tz).alias("t"),
        F.col(price).alias("_p"),
        F.col(size).cast("bigint").alias("_s"),
        order.alias("_ord"),
    )
    agg = keyed.groupBy("ticker", "t").agg(
        F.min_by("_p", "_ord").alias("o"),
        F.max("_p").alias("h"),
        F.min("_p").alias("l"),
        F.max_by("_p", "_ord").alias("c"),
        F.sum("_s").alias("v"),
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("_p") * F.col("_s")).alias("_pv"),
    )
    return agg.select("ticker", "c", "h", "l", "n", "o", "t", "v", _vwap("_pv", "v").alias("vw"))


def rollup_bars(bars: DataFrame, multiplier: int = 1, timespan: str = "week", tz: str | None = None) -> DataFrame:
    """A4: finer bars -> coarser bars.

    open/close come from the first/last finer bar by `t` ((ticker, t) is the bar key),
    high/low are max/min, volume and trade count add up, and vwap is volume-weighted:
    sum(vw * v) / sum(v).
    """
    keyed = bars.select(
        "ticker", "o", "h", "l", "c", "v", "n",
        F.col("t").alias("_t0"),
        _bucket_t(utc_ntz_from_millis(F.col("t")), multiplier, timespan, tz).alias("t"),
        (F.col("vw") * F.col("v")).alias("_pvw"),
    )
    agg = keyed.groupBy("ticker", "t").agg(
        F.min_by("o", "_t0").alias("o"),
        F.max("h").alias("h"),
        F.min("l").alias("l"),
        F.max_by("c", "_t0").alias("c"),
        F.sum("v").alias("v"),
        F.sum("n").alias("n"),
        F.sum("_pvw").alias("_pv"),
    )
    return agg.select("ticker", "c", "h", "l", "n", "o", "t", "v", _vwap("_pv", "v").alias("vw"))
