"""Bar queries: A3 (ticks -> bars) and A4 (rollup). Floating sums are rounded to 6 digits
on both sides because addition order differs between engines."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import testdata as td
from ..operators.bars import bars_from_ticks, rollup_bars
from ..operators.joins import segmented_documents
from .registry import register

_BAR_COLS = ["ticker", "c", "h", "l", "n", "o", "t", "v"]


def _rounded(df):
    return df.select(*_BAR_COLS, F.round("vw", 6).alias("vw"))


def _tick_bars_sql(bucket_ms: str, ticker: str) -> str:
    return td.with_views(f"""
SELECT ticker,
  first(price ORDER BY ts DESC, tick_id DESC) AS c,
  max(price) AS h, min(price) AS l, count(*) AS n,
  first(price ORDER BY ts, tick_id) AS o,
  {bucket_ms} AS t,
  CAST(sum(size) AS BIGINT) AS v,
  round(CASE WHEN sum(size) <> 0 THEN sum(price * size) / sum(size) END, 6) AS vw
FROM ticks_v GROUP BY ticker, {bucket_ms}""", ticks=ticker)


_DAY_MS = "epoch_us(date_trunc('day', ts)) // 1000"
_WEEK_MS = "epoch_us(date_trunc('week', ts)) // 1000"
_15MIN_MS = "(epoch_us(ts) // 1000) - ((epoch_us(ts) // 1000) % 900000)"


@register("bars_day", _tick_bars_sql(_DAY_MS, "event_type"))
def bars_day(spark, sf_dir):
    return _rounded(bars_from_ticks(td.ticks(spark, sf_dir, "event_type"), 1, "day"))


@register("bars_15min", _tick_bars_sql(_15MIN_MS, "user_id"))
def bars_15min(spark, sf_dir):
    return _rounded(bars_from_ticks(td.ticks(spark, sf_dir, "user_id"), 15, "minute"))


@register("bars_week", _tick_bars_sql(_WEEK_MS, "event_type"))
def bars_week(spark, sf_dir):
    return _rounded(bars_from_ticks(td.ticks(spark, sf_dir, "event_type"), 1, "week"))


_NY_LOCAL = "date_trunc('day', timezone('America/New_York', ts AT TIME ZONE 'UTC'))"
_NY_DAY_MS = f"epoch_us(timezone('America/New_York', {_NY_LOCAL})) // 1000"
_MONTH_MS = "epoch_us(date_trunc('month', ts)) // 1000"


@register("bars_day_ny", _tick_bars_sql(_NY_DAY_MS, "event_type"))
def bars_day_ny(spark, sf_dir):
    """Day bars on New York trading days (bucket starts at New York midnight)."""
    return _rounded(bars_from_ticks(td.ticks(spark, sf_dir, "event_type"), 1, "day", tz="America/New_York"))


_NY_INSTANT = f"({_NY_DAY_MS})"
_NY_4H_MS = (f"{_NY_INSTANT} + ((epoch_us(ts) // 1000 - {_NY_INSTANT}) // 14400000) * 14400000")


@register("bars_4h_ny", _tick_bars_sql(_NY_4H_MS, "event_type"))
def bars_4h_ny(spark, sf_dir):
    """Four-hour bars counted from New York midnight."""
    return _rounded(bars_from_ticks(td.ticks(spark, sf_dir, "event_type"), 4, "hour", tz="America/New_York"))


@register("bars_month", _tick_bars_sql(_MONTH_MS, "user_id"))
def bars_month(spark, sf_dir):
    return _rounded(bars_from_ticks(td.ticks(spark, sf_dir, "user_id"), 1, "month"))


@register("bars_rollup_week", td.with_views(f"""
, day_bars AS (
  SELECT ticker, {_DAY_MS} AS t,
    first(price ORDER BY ts, tick_id) AS o, max(price) AS h, min(price) AS l,
    first(price ORDER BY ts DESC, tick_id DESC) AS c,
    sum(size) AS v, count(*) AS n,
    CASE WHEN sum(size) <> 0 THEN sum(price * size) / sum(size) END AS vw
  FROM ticks_v GROUP BY ticker, {_DAY_MS})
SELECT ticker,
  first(c ORDER BY t DESC) AS c, max(h) AS h, min(l) AS l, CAST(sum(n) AS BIGINT) AS n,
  first(o ORDER BY t) AS o,
  epoch_us(date_trunc('week', make_timestamp(t * 1000))) // 1000 AS t,
  CAST(sum(v) AS BIGINT) AS v,
  round(CASE WHEN sum(v) <> 0 THEN sum(vw * v) / sum(v) END, 6) AS vw
FROM day_bars GROUP BY ticker, epoch_us(date_trunc('week', make_timestamp(t * 1000))) // 1000
""", ticks="event_type"))
def bars_rollup_week(spark, sf_dir):
    day = bars_from_ticks(td.ticks(spark, sf_dir, "event_type"), 1, "day")
    return _rounded(rollup_bars(day, 1, "week"))


# minute bars of users, of whom one ticker stands for a third
_MINUTE_TICKER = "CASE WHEN user_id % 3 = 0 THEN 'hot' ELSE CAST(user_id AS {}) END"
_DOCUMENT_ROWS = 20


@register("join_minute_documents", f"""
WITH bars AS (SELECT DISTINCT {_MINUTE_TICKER.format("VARCHAR")} AS ticker,
    epoch_us(date_trunc('minute', ts)) // 1000 AS t FROM events),
parts AS (SELECT *, CAST(strftime(make_timestamp(t * 1000), '%Y%m%d') AS INTEGER) AS part FROM bars),
placed AS (SELECT *, (row_number() OVER (PARTITION BY ticker, part ORDER BY t) - 1) // {_DOCUMENT_ROWS} AS segment FROM parts)
SELECT ticker AS underlying_ticker, ticker, part, CAST(segment AS INTEGER) AS segment, CAST(count(*) AS INTEGER) AS n_aggs,
  min(t) AS first_ts, max(t) AS last_ts, sha256(ticker || '|' || CAST(max(t) AS VARCHAR) || '|1|minute') AS last_id
FROM placed GROUP BY ticker, part, segment""")
def join_minute_documents(spark, sf_dir):
    """J3 over minute bars: a part is a day, and a hot ticker's day is several documents."""
    ticks = td.ticks(spark, sf_dir, "user_id").withColumn("ticker", F.expr(
        "CASE WHEN CAST(ticker AS BIGINT) % 3 = 0 THEN 'hot' ELSE ticker END"))
    bars = bars_from_ticks(ticks, 1, "minute")
    null = F.lit(None)
    contracts = ticks.select("ticker").distinct().select(
        F.col("ticker").alias("underlying_ticker"), "ticker", null.cast("string").alias("contract_type"),
        null.cast("date").alias("expiration_date"), null.cast("double").alias("strike_price"))
    docs = segmented_documents(contracts, bars, 1, "minute", rows=_DOCUMENT_ROWS)
    last = F.get("aggs", F.size("aggs") - 1)
    return docs.select("underlying_ticker", "ticker", "part", "segment", F.size("aggs").alias("n_aggs"),
                       F.get("aggs", 0)["timestamp"].alias("first_ts"), last["timestamp"].alias("last_ts"),
                       last["agg_id"].alias("last_id"))
