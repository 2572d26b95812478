"""Decoding landed responses, on the hand-made edge rows of FIXTURES.md."""

import json

from tickweave.sources.responses import decode_contract_responses, split_bar_responses

CLEAN = {"ticker": "O:A", "status": "OK", "resultsCount": 1,
         "results": [{"c": 1.5, "h": 2, "l": 1, "n": 3, "o": 1.2, "t": 1726718400000, "v": 10, "vw": 1.4}]}


def _with(**kw):
    d = json.loads(json.dumps(CLEAN))
    d.update(kw)
    return json.dumps(d)


def _bar(**kw):
    d = json.loads(json.dumps(CLEAN))
    d["results"][0].update(kw)
    return json.dumps(d)


CASES = {
    "clean": json.dumps(CLEAN),
    "unknown_key": _with(zzz=1),
    "null_results": json.dumps({"ticker": "O:B", "results": None}),
    "missing_results": json.dumps({"ticker": "O:C"}),
    "empty_results": json.dumps({"ticker": "O:D", "results": []}),
    "fractional_volume": _bar(v=10.5),
    "big_volume": _bar(v=3000000000),
    "wrong_type": _bar(n="x"),
    "count_mismatch": _with(resultsCount=2),
    "malformed": "nope",
    "null_line": None,
}


def _texts(spark, names):
    return spark.createDataFrame([(n, CASES[n]) for n in names], "case string, value string")


def test_each_case(spark):
    expect = {  # case -> (good bars, dead letters, reason)
        "clean": (1, 0, None), "unknown_key": (1, 0, None), "null_results": (0, 0, None),
        "missing_results": (0, 0, None), "empty_results": (0, 0, None),
        "fractional_volume": (0, 1, "fractional_volume"), "big_volume": (1, 0, None),
        "wrong_type": (0, 1, "malformed"), "count_mismatch": (1, 0, None), "malformed": (0, 1, "malformed"),
        "null_line": (0, 0, None),
    }
    for name, (n_good, n_bad, reason) in expect.items():
        good, bad, _ = split_bar_responses(_texts(spark, [name]))
        g, b = good.collect(), bad.collect()
        assert (len(g), len(b)) == (n_good, n_bad), name
        if reason:
            assert b[0].reason == reason, name
        if name == "big_volume":
            assert g[0].v == 3_000_000_000
        if g:
            assert g[0].ticker == "O:A"  # envelope ticker copied onto each bar


def test_good_bar_schema(spark):
    good, _, _ = split_bar_responses(_texts(spark, ["clean"]))
    assert [f.name for f in good.schema.fields] == ["ticker", "c", "h", "l", "n", "o", "t", "v", "vw"]
    assert good.schema["v"].dataType.simpleString() == "bigint"


def test_envelopes_report_count_mismatch(spark):
    from tickweave.operators.quality import envelope_report
    _, _, env = split_bar_responses(_texts(spark, ["clean", "count_mismatch", "empty_results"]))
    r = {x.status: x for x in envelope_report(env).collect()}
    assert r["OK"].n_responses == 2 and r["OK"].n_mismatched == 1
    assert r[None].n_undeclared == 1 and r[None].n_mismatched == 0  # the empty case declares nothing


def test_contract_responses(spark):
    texts = [json.dumps({"request_id": "r1", "results": [
                {"ticker": "O:AAPL240920C00005000", "underlying_ticker": "AAPL", "expiration_date": "2024-09-20",
                 "strike_price": 5, "contract_type": "call", "extra": 1}]}),
             json.dumps({"request_id": "r2", "results": None}), "{broken"]
    df = decode_contract_responses(spark.createDataFrame([(t,) for t in texts], "value string"))
    rows = df.collect()
    assert len(rows) == 1
    assert rows[0].strike_price == 5.0 and str(rows[0].expiration_date) == "2024-09-20"


def test_array_columns_follow_the_same_rules(spark):
    from pyspark.sql import functions as F

    from tickweave.functions.hashing import bar_id
    from tickweave.sources.responses import bars_of, classify_bar_responses, contracts_of
    texts = spark.createDataFrame([(t,) for t in BAD_BARS + list(CASES.values())], "value string")
    got = texts.select(F.explode(bars_of("value")).alias("b")).select("b.*")
    good = classify_bar_responses(texts).where("reason IS NULL")
    want = good.select("t", "c", "n", bar_id("ticker", "t").alias("agg_id"))
    assert sorted(map(tuple, got.select("timestamp", "close", "transactions", "agg_id").collect())) == \
        sorted(map(tuple, want.collect()))
    body = {"results": [{"ticker": "O:1", "expiration_date": "2024-09-20"}, {"ticker": "O:2", "expiration_date": "soon"}]}
    rows = spark.createDataFrame([(json.dumps(body),), ("nope",), (None,)], "value string") \
        .select(F.explode(contracts_of("value")).alias("c")).select("c.ticker").collect()
    assert [r.ticker for r in rows] == ["O:1"]


BAD_BARS = [_bar(v=1e20), json.dumps(CLEAN).replace('"v": 10', '"v": NaN'),
            json.dumps(CLEAN).replace('"v": 10', '"v": 1e400'), json.dumps(CLEAN).replace('"c": 1.5', '"c": Infinity'),
            _bar(c=None), _bar(vw=None), _bar(n=None), json.dumps({k: v for k, v in CLEAN.items() if k != "ticker"}),
            json.dumps({"status": "ERROR", "error": "no such ticker"}), json.dumps({"status": "NOT_AUTHORIZED"}),
            _with(results=[None]), "[1, 2]"]


def test_one_bad_record_never_stops_the_others(spark):
    from tickweave.sources.responses import classify_bar_responses
    texts = spark.createDataFrame([(t,) for t in BAD_BARS + [CASES["clean"]]], "value string")
    rows = classify_bar_responses(texts).collect()
    assert sum(r.reason is None for r in rows) == 1
    from collections import Counter
    assert Counter(r.reason for r in rows if r.reason) == Counter({
        "volume_out_of_range": 3, "price_not_finite": 1, "missing_field": 3, "missing_ticker": 1,
        "error_response": 2, "null_bar": 1, "malformed": 1})
    assert all(r.record for r in rows if r.reason and r.reason != "null_bar")


def test_request_key_attributes_unreadable_responses(spark):
    from tickweave.sources.responses import classify_bar_responses
    texts = spark.createDataFrame([('{"ticker":"O:A","results":[{"c":1', "O:A"), (CASES["clean"], "O:Z")],
                                  "value string, request_ticker string")
    rows = {(r.ticker, r.reason) for r in classify_bar_responses(texts, request_key="request_ticker").collect()}
    # the truncated body keeps no envelope: its request key names it; a readable envelope wins
    assert rows == {("O:A", "malformed"), ("O:A", None)}


def test_contract_dead_letters(spark):
    from tickweave.sources.responses import classify_contract_responses
    texts = [json.dumps({"results": [{"ticker": "O:1", "expiration_date": "2024-09-20"},
                                     {"ticker": "O:2", "expiration_date": "2024-09-27"}]}),
             '{"results": [{"ticker": "O:3"', None, json.dumps({"results": None})]
    rows = classify_contract_responses(spark.createDataFrame([(t,) for t in texts], "value string")).collect()
    good = sorted(r.ticker for r in rows if r.reason is None)
    bad = [r for r in rows if r.reason is not None]
    assert good == ["O:1", "O:2"]
    assert len(bad) == 1 and bad[0].reason == "malformed" and bad[0].record.startswith('{"results"')


def test_bad_dates_and_error_bodies_of_contract_lists(spark):
    from tickweave.sources.responses import classify_contract_responses
    texts = [json.dumps({"results": [{"ticker": "O:1", "expiration_date": "2024-13-45"},
                                     {"ticker": "O:2", "expiration_date": "soon"}, {"ticker": "O:3"},
                                     {"ticker": "O:4", "expiration_date": "2024-09-20"}]}),
             json.dumps({"status": "ERROR", "results": None})]
    rows = classify_contract_responses(spark.createDataFrame([(t,) for t in texts], "value string")).collect()
    assert sorted((r.reason or "", r.ticker or "") for r in rows) == [
        ("", "O:3"), ("", "O:4"), ("bad_date", "O:1"), ("bad_date", "O:2"), ("error_response", "")]


def _bars(*bars):
    """A body with the clean bar, changed by each of `bars` (None: null instead of a bar)."""
    return json.dumps({"ticker": "O:A", "status": "OK", "count": "many", "results": [
        None if b is None else CLEAN["results"][0] | b for b in bars]})


def test_a_bad_bar_takes_no_other_of_its_response(spark):
    from tickweave.sources.responses import bar_outcomes, bars_of, classify_bar_responses, rejects_of
    from pyspark.sql import functions as F
    body = _bars({}, {"v": "abc"}, None, {"n": 3_000_000_000}, {"t": 2 ** 63 - 1}, {"t": -62135596800001}, {"t": 2 ** 63},
                 {"c": None}, {"v": 0.5}, {"n": {"x": 1}}, {"extra": [1]}, {"t": 253402300799999})
    texts = spark.createDataFrame([(body,)], "value string")
    rows = classify_bar_responses(texts).collect()
    assert [r.reason for r in rows] == [None, "malformed", "null_bar", "malformed", "time_out_of_range", "time_out_of_range",
                                        "malformed", "missing_field", "fractional_volume", "malformed", None, None]
    assert all(r.ticker == "O:A" for r in rows)
    assert json.loads(rows[1].record)["v"] == "abc" and rows[3].record.startswith("{") and rows[0].origin is None
    assert len({r.origin for r in rows if r.reason}) == 9
    got = texts.select(F.size(bars_of("value")).alias("good"), rejects_of(bar_outcomes("value")).alias("bad")).first()
    assert got.good == 3 and [b.reason for b in got.bad] == [r.reason for r in rows if r.reason]


def test_times_that_pass_can_be_placed_in_a_calendar(spark):
    from tickweave.operators.joins import contract_documents
    from tickweave.sources.responses import decode_bar_responses
    body = _bars({"t": 2 ** 63 - 1}, {"t": -62135596800000}, {"t": 253402300799999}, {"t": 0})
    bars = decode_bar_responses(spark.createDataFrame([(body,)], "value string"))
    contracts = spark.createDataFrame([("A", "O:A", None, None, None)], "underlying_ticker string, ticker string, "
                                      "contract_type string, expiration_date date, strike_price double")
    for span, parts in (("day", [1, 1970, 9999]), ("hour", [101, 197001, 999912]), ("minute", [10101, 19700101, 99991231])):
        assert sorted(r.part for r in contract_documents(contracts, bars, 1, span).collect()) == parts


def test_a_bad_contract_takes_no_other_of_its_list(spark):
    from pyspark.sql import functions as F

    from tickweave.sources.responses import classify_contract_responses, contract_outcomes, contracts_of, rejects_of
    body = {"results": [{"ticker": "O:1", "expiration_date": "2024-09-20"}, {"ticker": "O:2", "strike_price": "x"}, None,
                        {"ticker": 5, "correction": 3_000_000_000}, {"expiration_date": "2024-09-20"}, [1]]}
    texts = spark.createDataFrame([(json.dumps(body), "AAPL"), (json.dumps({"results": {"ticker": "O:9"}}), "MSFT")],
                                  "value string, asked string")
    rows = classify_contract_responses(texts, request_key="asked").collect()
    assert [(r.reason, r.ticker) for r in rows[:5]] == [(None, "O:1"), ("malformed", "O:2"), ("null_contract", None),
                                                        ("malformed", "5"), (None, None)]
    assert [r.reason for r in rows[5:]] == ["malformed", "malformed"]
    assert [r.underlying_ticker for r in rows] == [None, "AAPL", "AAPL", "AAPL", None, "AAPL", "MSFT"]
    got = texts.select(F.size(contracts_of("value")).alias("good"), F.size(rejects_of(contract_outcomes("value"))).alias("bad"))
    assert [tuple(r) for r in got.collect()] == [(2, 4), (0, 1)]


def test_envelopes_do_not_depend_on_their_bars(spark):
    from tickweave.sources.responses import decode_envelopes
    texts = spark.createDataFrame([(_bars({"v": "abc"}, {}),), (_with(resultsCount="x"),), ("{",), (None,)], "value string")
    rows = decode_envelopes(texts).collect()
    assert [(r.ticker, r.status, r.resultsCount, len(r.results)) for r in rows] == [("O:A", "OK", None, 2), ("O:A", "OK", None, 1)]


def test_flat_map_records_against_a_plain_loop(spark):
    from tickweave.operators.generators import flat_map_records

    def plain(row):
        for part in row["text"].split():
            if part == "!":
                raise ValueError(part)
            yield {"at": row["at"], "n": float(part) if "." in part else part if part.isalpha() else int(part)}
            if part == "7":
                yield {"at": row["at"], "odd": 1}

    rows = [(k, t) for k, t in enumerate(["1 2 3", "", None, "4 x 5", "6 ! 7", "7 8", "1.5 2.0", "99999999999", "9 " * 50])] * 3
    df = spark.createDataFrame(rows, "at bigint, text string").repartition(3)
    got = flat_map_records(df, plain, "at bigint, n int", "text").collect()
    good, failed, bad = [], 0, 0
    for at, text in rows:
        try:
            for r in plain({"at": at, "text": text}):
                if set(r) == {"at", "n"} and type(r["n"]) is int and abs(r["n"]) < 2 ** 31:
                    good.append((at, r["n"]))
                else:
                    bad += 1
        except Exception:  # noqa: BLE001
            failed += 1
    assert sorted((r.at, r.n) for r in got if r.reason is None) == sorted(good)
    assert sum(r.reason == "failed" for r in got) == failed == 6
    assert sum(r.reason == "bad_record" for r in got) == bad == 15
    assert {r.record for r in got if r.reason == "failed"} == {None, "6 ! 7"}
    assert flat_map_records(df.limit(0), plain, "at bigint, n int", "text").count() == 0
