import hashlib

from pyspark.sql import functions as F

from tickweave.functions import hashing as H
from tickweave.functions.arrays import empty_if_null, first_or_null


def test_row_id_separates_null_positions(spark):
    df = spark.createDataFrame([(1, None), (None, 1), (1, None)], "a int, b int")
    ids = [r[0] for r in df.select(H.row_id(df.schema, ["a", "b"])).collect()]
    assert ids[0] != ids[1] and ids[0] == ids[2]


def test_row_id_escapes_separator(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c")], "x string, y string")
    ids = [r[0] for r in df.select(H.row_id(df.schema, ["x", "y"])).collect()]
    assert ids[0] != ids[1]


def test_murmur_fingerprint_is_null_blind(spark):
    df = spark.createDataFrame([(1, None), (None, 1)], "a int, b int")
    fp = [r[0] for r in df.select(H.murmur_fingerprint("a", "b")).collect()]
    assert fp[0] == fp[1]  # why it is only a fingerprint, never a key


def test_md5_and_sha_match_python(spark):
    df = spark.createDataFrame([(1726718400000, "AAPL")], "t bigint, s string")
    r = df.select(H.md5_of_text("t"), H.sha256_hex("s")).first()
    assert r[0] == hashlib.md5(b"1726718400000").hexdigest()
    assert r[1] == hashlib.sha256(b"AAPL").hexdigest()


def test_bar_id_differs_per_ticker_and_matches_python(spark):
    df = spark.createDataFrame([("O:A", 1), ("O:B", 1)], "ticker string, t bigint")
    ids = [r[0] for r in df.select(H.bar_id("ticker", "t")).collect()]
    assert ids[0] != ids[1]
    assert ids[0] == hashlib.sha256(b"O:A|1|1|day").hexdigest()


def test_array_helpers(spark):
    df = spark.createDataFrame([([1, 2],), ([],), (None,)], "a array<int>")
    out = df.select(first_or_null("a").alias("f"), F.size(empty_if_null("a", "array<int>")).alias("n")).collect()
    assert [(r.f, r.n) for r in out] == [(1, 2), (None, 0), (None, 0)]


def test_row_ids_tell_marker_zone_and_zero_apart(spark):
    from tickweave.functions.hashing import bar_id, row_id
    df = spark.createDataFrame([("∅",), (None,), ("\\∅",), ("a|b",), ("a",)], "s string")
    assert len({r.i for r in df.select(row_id(df.schema, ["s"]).alias("i")).collect()}) == 5
    times = spark.sql("SELECT timestamp_millis(1726718400123) AS t")
    seen = set()
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            seen.add(times.select(row_id(times.schema, ["t"]).alias("i")).first().i)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert len(seen) == 1
    zeros = spark.createDataFrame([(0.0,), (-0.0,), (1.0,)], "x double")
    assert len({r.i for r in zeros.select(row_id(zeros.schema, ["x"]).alias("i")).collect()}) == 2
    bars = spark.createDataFrame([("A|1", 2), ("A", 12), (None, 2), ("A", None)], "ticker string, t bigint")
    ids = [r.i for r in bars.select(bar_id("ticker", "t").alias("i")).collect()]
    assert ids[2] is None and ids[3] is None and ids[0] != ids[1]
