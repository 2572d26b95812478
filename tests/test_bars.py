import datetime as dt

from pyspark.sql import functions as F

from tickweave import testdata as td
from tickweave.operators.bars import bars_from_ticks, rollup_bars

TICK = "ticker string, ts timestamp_ntz, price double, size bigint, tick_id bigint"


def _ms(s):
    return int((dt.datetime.fromisoformat(s) - dt.datetime(1970, 1, 1)).total_seconds() * 1000)


def test_ohlcv_with_tie_on_timestamp(spark):
    ts = dt.datetime(2024, 9, 19, 14, 0)
    rows = [("O:A", ts, 2.0, 10, 2), ("O:A", ts, 1.0, 5, 1),  # equal ts: tick_id decides
            ("O:A", ts + dt.timedelta(hours=1), 3.0, 5, 3), ("O:A", ts + dt.timedelta(hours=1), 0.5, 0, 4)]
    out = bars_from_ticks(spark.createDataFrame(rows, TICK), 1, "day").collect()
    assert len(out) == 1
    b = out[0]
    assert (b.o, b.c, b.h, b.l, b.v, b.n) == (1.0, 0.5, 3.0, 0.5, 20, 4)
    assert b.t == _ms("2024-09-19T00:00:00")
    assert abs(b.vw - (2 * 10 + 1 * 5 + 3 * 5) / 20) < 1e-12


def test_zero_volume_gives_null_vwap(spark):
    rows = [("O:Z", dt.datetime(2024, 1, 2, 10), 1.0, 0, 1)]
    b = bars_from_ticks(spark.createDataFrame(rows, TICK)).first()
    assert b.v == 0 and b.vw is None


def test_calendar_buckets(spark):
    rows = [("X", dt.datetime(2024, 1, 3, 12), 1.0, 1, 1),   # Wednesday
            ("X", dt.datetime(2024, 2, 29, 23, 59), 2.0, 1, 2)]
    df = spark.createDataFrame(rows, TICK)
    weeks = sorted(r.t for r in bars_from_ticks(df, 1, "week").collect())
    assert weeks == [_ms("2024-01-01T00:00:00"), _ms("2024-02-26T00:00:00")]
    months = sorted(r.t for r in bars_from_ticks(df, 1, "month").collect())
    assert months == [_ms("2024-01-01T00:00:00"), _ms("2024-02-01T00:00:00")]
    quarters = [r.t for r in bars_from_ticks(df, 1, "quarter").collect()]
    assert quarters == [_ms("2024-01-01T00:00:00")]
    mins = sorted(r.t for r in bars_from_ticks(df, 15, "minute").collect())
    assert mins == [_ms("2024-01-03T12:00:00"), _ms("2024-02-29T23:45:00")]


def test_new_york_day_bars_across_dst(spark):
    # 03:30 UTC belongs to the previous New York day; DST changes on 2024-03-10 and 2024-11-03
    rows = [("X", dt.datetime(2024, 3, 10, 3, 30), 1.0, 1, 1), ("X", dt.datetime(2024, 3, 10, 12), 2.0, 1, 2),
            ("X", dt.datetime(2024, 11, 3, 3, 30), 3.0, 1, 3), ("X", dt.datetime(2024, 11, 3, 12), 4.0, 1, 4)]
    out = sorted((r.t, r.n) for r in bars_from_ticks(spark.createDataFrame(rows, TICK), 1, "day",
                                                       tz="America/New_York").collect())
    # New York midnight is 05:00 UTC under EST and 04:00 UTC under EDT (both change days start in the old offset)
    assert out == [(_ms("2024-03-09T05:00:00"), 1), (_ms("2024-03-10T05:00:00"), 1),
                   (_ms("2024-11-02T04:00:00"), 1), (_ms("2024-11-03T04:00:00"), 1)]


def test_week_rollup_of_day_bars_equals_direct_week_bars(spark):
    ticks = td.ticks(spark, "/root/testdata/sf0.001")
    direct = bars_from_ticks(ticks, 1, "week")
    rolled = rollup_bars(bars_from_ticks(ticks, 1, "day"), 1, "week")
    cols = ["ticker", "t", "o", "h", "l", "c", "v", "n"]
    a = sorted(tuple(r) for r in direct.select(*cols, F.round("vw", 6)).collect())
    b = sorted(tuple(r) for r in rolled.select(*cols, F.round("vw", 6)).collect())
    assert a == b and len(a) > 0


def test_rejects_unknown_timespan(spark):
    import pytest
    with pytest.raises(ValueError):
        bars_from_ticks(spark.createDataFrame([], TICK), 1, "fortnight")


def test_hour_bars_in_a_zone_follow_the_time_line(spark):
    """Both clock changes of New York in 2024: the repeated hour is two bars, the skipped one none."""
    stamps = ["2024-11-03 04:30:00", "2024-11-03 05:30:00", "2024-11-03 06:30:00", "2024-11-03 07:30:00",
              "2024-03-10 06:30:00", "2024-03-10 07:30:00", "2024-03-10 04:59:59"]
    ticks = spark.createDataFrame([("A", s, 1.0, 1, i) for i, s in enumerate(stamps)],
                                  "ticker string, ts string, price double, size bigint, tick_id bigint") \
        .withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    from tickweave.operators.bars import bars_from_ticks
    ms = lambda s: int(dt.datetime.fromisoformat(s + "+00:00").timestamp() * 1000)
    hours = {r.t: r.n for r in bars_from_ticks(ticks, 1, "hour", tz="America/New_York").collect()}
    assert hours == {ms(s[:13] + ":00:00"): 1 for s in stamps}
    days = {r.t: r.n for r in bars_from_ticks(ticks, 12, "hour", tz="America/New_York").collect()}
    assert days == {ms("2024-11-03 04:00:00"): 4, ms("2024-03-10 05:00:00"): 2, ms("2024-03-09 17:00:00"): 1}


def test_equal_times_break_by_tick_id_and_microseconds_count(spark):
    rows = [("A", "2024-01-01 00:00:00.000002", 3.0, 1, 1), ("A", "2024-01-01 00:00:00.000001", 2.0, 1, 9),
            ("A", "2024-01-01 00:00:00.000001", 1.0, 1, -5), ("A", "2024-01-01 00:00:00.000002", 4.0, 1, 2),
            ("A", "1969-12-31 23:59:59.999999", 9.0, 1, 0), ("A", "1969-12-31 23:59:59.999998", 8.0, 1, 0)]
    ticks = spark.createDataFrame(rows, "ticker string, ts string, price double, size bigint, tick_id bigint") \
        .withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    from tickweave.operators.bars import bars_from_ticks
    got = {(r.o, r.c) for r in bars_from_ticks(ticks, 1, "day").collect()}
    assert got == {(1.0, 4.0), (8.0, 9.0)}
