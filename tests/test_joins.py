import datetime as dt

from tickweave.operators import joins as J

CONTRACT = "underlying_ticker string, ticker string, contract_type string, expiration_date date, strike_price double"
BAR = "ticker string, c double, h double, l double, n int, o double, t bigint, v bigint, vw double"


def _contracts(spark):
    d = dt.date(2024, 9, 20)
    return spark.createDataFrame([("AAPL", "O:A1", "call", d, 5.0), ("AAPL", "O:A2", "put", d, 6.0),
                                  ("TRUE", "O:T1", "call", d, 1.0), (None, None, "call", d, 1.0)], CONTRACT)


def _bars(spark):
    return spark.createDataFrame([("O:A1", 1.0, 1.0, 1.0, 1, 1.0, t, 10, 1.0) for t in (3, 1, 2)], BAR)


def test_universe_join_dedups_symbols_and_keeps_strings(spark):
    uni = spark.createDataFrame([("AAPL",), ("AAPL",), (None,), ("TRUE",), ("NONE",)], "underlying_ticker string")
    out = J.universe_contracts(uni, _contracts(spark)).collect()
    assert sorted(r.ticker for r in out) == ["O:A1", "O:A2", "O:T1"]


def test_documents_keep_contracts_without_bars(spark):
    docs = {r.ticker: r for r in J.contract_documents(_contracts(spark), _bars(spark)).collect() if r.ticker}
    assert [a.timestamp for a in docs["O:A1"].aggs] == [1, 2, 3]
    assert docs["O:A2"].aggs == [] and docs["O:A2"].part is None and docs["O:A1"].part == 1970


def test_documents_split_by_calendar_year(spark):
    year = 366 * 86_400_000  # 1970, 1971, 1972, 1973 from the epoch on
    times = [5, 0, 7, year, year + 1, 3 * year]
    bars = spark.createDataFrame([("O:A1", 1.0, 1.0, 1.0, 1, 1.0, t, 1, 1.0) for t in times], BAR)
    docs = sorted((r.part, [a.timestamp for a in r.aggs])
                  for r in J.contract_documents(_contracts(spark), bars).collect() if r.ticker == "O:A1")
    assert docs == [(1970, [0, 5, 7]), (1971, [year, year + 1]), (1973, [3 * year])]


def test_not_yet_loaded(spark):
    out = J.not_yet_loaded(_contracts(spark).where("ticker is not null"), _bars(spark)).collect()
    assert sorted(r.ticker for r in out) == ["O:A2", "O:T1"]


def test_idempotent_append_twice_is_once(spark):
    batch = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "row_id string, x int")
    stored = spark.createDataFrame([("b", 2)], "row_id string, x int")
    first = J.idempotent_append(batch, stored)
    assert sorted(r.row_id for r in first.collect()) == ["a"]
    stored2 = stored.unionByName(first)
    assert J.idempotent_append(batch, stored2).count() == 0


def test_rows_without_an_id_are_routed_out(spark):
    batch = spark.createDataFrame([("a", 1), (None, 2), (None, 3)], "row_id string, x int")
    stored = spark.createDataFrame([], "row_id string, x int")
    assert [r.x for r in J.idempotent_append(batch, stored).collect()] == [1]
    assert sorted((r.x, r.reason) for r in J.without_id(batch).collect()) == [(2, "missing_id"), (3, "missing_id")]


def test_joins_run_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("joins-run-no-job", "building joins")
    uni = _contracts(spark).select("underlying_ticker")
    J.universe_contracts(uni, _contracts(spark))
    J.contract_documents(_contracts(spark), _bars(spark))
    J.not_yet_loaded(_contracts(spark), _bars(spark))
    assert len(tracker.getJobIdsForGroup("joins-run-no-job")) == 0


def test_skew_safe_left_join_equals_left_join(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, x int")
    right = spark.createDataFrame([("a", 10), ("a", 11), ("c", 12)], "k string, y int")
    want = {tuple(r) for r in left.join(right, "k", "left").select("k", "x", "y").collect()}
    got = {tuple(r) for r in J.skew_safe_left_join(left, right, "k").select("k", "x", "y").collect()}
    assert got == want and len(got) == 4


def test_documents_in_segments_of_a_hot_part(spark):
    from collections import defaultdict

    from tickweave.operators.joins import segmented_documents
    minute = 60_000
    bars = [("hot", k % 700 * minute, k % 3, 1.0) for k in range(2100)] + [("cold", k * 86_400_000, 1, 1.0) for k in range(3)]
    df = spark.createDataFrame(bars, "ticker string, t bigint, n int, c double").repartition(7)
    contracts = spark.createDataFrame([("A", t, None, None, None) for t in ("hot", "cold", "none")], "underlying_ticker string, "
                                      "ticker string, contract_type string, expiration_date date, strike_price double")
    got = defaultdict(list)
    for r in segmented_documents(contracts, df, 1, "minute", tiebreak=["n", "c"], rows=64).collect():
        got[r.ticker].append((r.part, r.segment, [a.timestamp for a in r.aggs]))
    assert got["none"] == [(None, None, [])]
    assert sorted(got["cold"]) == [(19700101 + k, 0, [k * 86_400_000]) for k in range(3)]
    hot = sorted(got["hot"])
    assert [len(x[2]) for x in hot] == [64] * 32 + [52] and [x[1] for x in hot] == list(range(33))
    assert [t for x in hot for t in x[2]] == sorted(t for _, t, *_ in bars[:2100])
