"""The whole flow on a few rows: filters, caps, and runs that are repeated or come later."""

import functools
import json

import pytest

from tickweave.plans import populate as flow
from tickweave.plans.populate import STAGES, TABLES
from tickweave.session import delete_dir, shared_dir
from tickweave.sinks import runs


populate = functools.partial(flow.populate, id_buckets=4)


def _bar(t, **kw):
    return {"c": 1.0, "h": 1.0, "l": 1.0, "n": 1, "o": 1.0, "t": t, "v": 1, "vw": 1.0} | kw


def _inputs(spark, extra=()):
    root = shared_dir(spark, "t_populate_in")
    spark.createDataFrame([("AAPL", "x"), ("NONE", "y")], "Symbol string, Name string") \
        .write.option("header", True).csv(f"{root}/universe")
    contracts = [{"ticker": f"O:{i}", "underlying_ticker": "AAPL", "expiration_date": d, "strike_price": 1.0}
                 for i, d in enumerate(["2024-01-05", "2024-02-10", "2024-03-15", "2023-01-01"])]
    texts = [json.dumps({"status": "OK", "results": contracts}), json.dumps({"status": "ERROR"})]
    spark.createDataFrame([(t,) for t in texts], "value string").write.text(f"{root}/contracts")
    day = 86_400_000
    bodies = [(json.dumps({"ticker": "O:1", "status": "OK", "results": [_bar(19_700 * day), _bar(19_701 * day),
                                                                         _bar(19_702 * day, v=0.5)]}), "O:1"),
              ("{cut", "O:2"), ("{cut too", None), *extra]
    spark.createDataFrame(bodies, "value string, request_ticker string").write.json(f"{root}/bars")
    return [f"{root}/universe", f"{root}/contracts", f"{root}/bars"]


def _counts(spark, paths):
    # with a schema, since a run without a row writes no file to read one from
    return [spark.read.schema("run_id string").parquet(p).count() for p in (paths.contracts_path, paths.documents_path, paths.rows_path,
                                                    paths.dead_letters_path)]


def test_repeated_and_later_runs(spark):
    out, first = shared_dir(spark, "t_populate_out"), _inputs(spark)
    for run in ("a", "a", "b"):  # repeated under its id, then over the same input under another
        paths = populate(spark, *first, out, run_id=run, as_of="2024-02-01")
        assert _counts(spark, paths) == [3, 3, 2, 4]
    more = _inputs(spark, [(json.dumps({"ticker": "O:0", "status": "OK", "results": [_bar(19_700 * 86_400_000)]}), "O:0")])
    paths = populate(spark, *more, out, run_id="c", as_of="2024-02-01")
    assert _counts(spark, paths) == [3, 4, 3, 4]  # a bar, and a document for its year
    audit = {r.underlying_ticker: r for r in spark.read.parquet(paths.audit_path).where("run_id = 'c'").collect()}
    assert (audit["AAPL"].n_contracts, audit["AAPL"].n_with_bars, audit["AAPL"].n_bars) == (3, 2, 3)
    assert audit["AAPL"].n_failed == 2 and (audit[None].n_failed, audit[None].n_failed_contracts) == (1, 1)


@pytest.mark.parametrize("options,want", [
    ({"lookback_days": None}, [4, 4, 2]), ({"expired": True, "lookback_days": None}, [2, 2, 0]),
    ({"expired": False}, [2, 2, 2]), ({"contracts_per_underlying": 1}, [1, 1, 0]),
    ({"bars_per_contract": 1}, [3, 3, 1]), ({"bar_range": ("2023-12-10", "2023-12-10")}, [3, 3, 1])])
def test_fetch_filters(spark, options, want):
    paths = populate(spark, *_inputs(spark), shared_dir(spark, "t_populate_out"), run_id="r", as_of="2024-02-01", **options)
    assert _counts(spark, paths)[:3] == want


def test_an_empty_rerun_empties_its_run(spark):
    out, inputs = shared_dir(spark, "t_populate_out"), _inputs(spark)
    paths = populate(spark, *inputs, out, run_id="a", as_of="2024-02-01")
    assert _counts(spark, paths) == [3, 3, 2, 4]
    nothing = shared_dir(spark, "t_populate_in")
    for name in ("contracts", "bars"):
        spark.createDataFrame([], "value string").coalesce(1).write.text(f"{nothing}/{name}")
    populate(spark, inputs[0], f"{nothing}/contracts", f"{nothing}/bars", out, run_id="a", as_of="2024-02-01")
    assert _counts(spark, paths) == [0, 0, 0, 0]
    populate(spark, *inputs, out, run_id="b", as_of="2024-02-01")
    assert _counts(spark, paths) == [3, 3, 2, 4]


def test_a_killed_run_leaves_nothing_that_counts(spark, monkeypatch):
    out, inputs = shared_dir(spark, "t_populate_out"), _inputs(spark)
    with monkeypatch.context() as m:
        m.setattr(runs.Run, "commit", lambda self: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            populate(spark, *inputs, out, run_id="a", as_of="2024-02-01")
    log = runs.RunLog(spark, out)
    assert log.entries() == [] and log.vacuum([*TABLES, *STAGES]) == 9
    for run in ("b", "c"):  # stores everything, as if the killed run had not been
        paths = populate(spark, *inputs, out, run_id=run, as_of="2024-02-01")
        assert _counts(spark, paths) == [3, 3, 2, 4]
    assert log.vacuum(TABLES) == 0 and [r for _, r, _ in log.entries()] == ["b", "c"]


def test_of_two_runs_at_a_time_one_is_told(spark):
    log = runs.RunLog(spark, shared_dir(spark, "t_runs"))
    one, two, same = log.begin("one"), log.begin("two"), log.begin("one")
    for run in (one, two, same):
        run.write(spark.range(3), "rows")
    two.commit()
    for late in (one, same):
        with pytest.raises(runs.ConcurrentRun):
            late.commit()
    again = log.begin("one")
    schema = spark.range(1).schema
    assert again.stored("rows", schema).count() == 3 and again.with_stored("absent", schema).count() == 0
    again.write(spark.range(5), "rows")
    assert log.read("rows", schema).count() == 3
    again.commit()
    assert log.read("rows", schema).count() == 8 and log.read("rows", schema, ["one"]).count() == 5
    with pytest.raises(ValueError):
        log.begin("a/b")


def test_stored_ids_are_joined_where_they_lie(spark):
    from tickweave.operators.joins import idempotent_append
    log = runs.RunLog(spark, shared_dir(spark, "t_runs"))
    ids = [spark.range(a, b).selectExpr("CAST(id AS STRING) AS row_id", "id * 2 AS v") for a, b in ((0, 500), (300, 900), (0, 900))]
    for name, batch in zip("ab", ids):
        run = log.begin(name)
        with run.stored_ids("rows", "row_id", buckets=6) as stored:
            fresh = idempotent_append(batch, stored, "row_id", 6)
            run.write(fresh, "rows", bucket_id="row_id", buckets=6, dealt=True)
        run.commit()
    assert sorted(r.run_id for r in log.read("rows", ids[0].schema).collect()) == ["a"] * 500 + ["b"] * 400
    run = log.begin("c")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with run.stored_ids("rows", "row_id", buckets=6) as stored:
            fresh = idempotent_append(ids[2], stored, "row_id", 6)
            assert fresh.count() == 0
            plan = fresh._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "LeftAnti" in plan and plan.count("Exchange") == 1, plan  # the batch's only
    scan = plan.index("FileScan parquet")
    assert "Exchange" not in plan[plan.rindex("Sort", 0, scan):scan] and "SelectedBucketsCount" in plan


def test_ids_of_several_columns_are_joined_where_they_lie(spark):
    from tickweave.operators.joins import idempotent_append
    log, ids = runs.RunLog(spark, shared_dir(spark, "t_runs")), ["origin", "kind"]
    rows = spark.range(600).selectExpr("CAST(id % 300 AS STRING) AS origin", "IF(id < 300, 'a', 'b') AS kind", "id")
    run = log.begin("one")
    for part, new in ((rows.where("id < 200"), 200), (rows.where("id < 400"), 400), (rows.union(rows), 600)):
        with run.stored_ids("dead", ids, buckets=6, own=True) as stored:
            written = run.write(idempotent_append(part, stored, ids, 6), "dead", bucket_id="origin", buckets=6, dealt=True,
                                append=True)
        assert written.count() == written.select(*ids).distinct().count() == new
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(run.path("dead")).select("path").collect()
    assert all(".zstd." in r.path for r in files)
    run.commit()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with log.begin("two").stored_ids("dead", ids, buckets=6) as stored:
            fresh = idempotent_append(rows, stored, ids, 6)
            assert fresh.count() == 0
            plan = fresh._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "LeftAnti" in plan and plan.count("Exchange") == 1, plan  # the batch's only


@pytest.mark.parametrize("options,rows", [({}, 2), ({"bars_per_contract": 1}, 1)])
def test_responses_may_come_in_parts(spark, options, rows):
    """A part is asked for when what the one before holds is stored, which may then be gone."""
    universe, contracts, bars = _inputs(spark)
    at = []

    def parts():
        schema = "value string, request_ticker string"
        texts = spark.read.json(bars, schema=schema).collect()
        for some in (texts[:1], texts, texts[1:]):  # some come again
            at.append(shared_dir(spark, "t_populate_part"))
            spark.createDataFrame(some, schema).write.json(at[-1])
            yield at[-1]
            delete_dir(spark, at[-1])

    out = shared_dir(spark, "t_populate_out")
    paths = flow.populate(spark, universe, contracts, parts(), out, run_id="a", as_of="2024-02-01",
                          id_buckets=4, **options)
    assert len(at) == 3 and _counts(spark, paths) == [3, 3, rows, 4]
    paths = flow.populate(spark, universe, [contracts], bars, out, run_id="b", as_of="2024-02-01", id_buckets=4, **options)
    assert _counts(spark, paths) == [3, 3, rows, 4]
    with pytest.raises(ValueError):
        flow.populate(spark, universe, contracts, [], out, run_id="c", as_of="2024-02-01", id_buckets=4)


def test_dropped_contracts_are_reported(spark):
    root, inputs = shared_dir(spark, "t_populate_in"), _inputs(spark)
    lists = [({"status": "OK", "results": [{"ticker": "O:8", "underlying_ticker": "AAPL", "expiration_date": "2024-03-01"},
                                           {"underlying_ticker": "AAPL"}, {"ticker": "O:9"}, {"ticker": "O:7", "correction": "x"}]}, "AAPL"),
             ({"status": "ERROR"}, "MSFT")]
    spark.createDataFrame([(json.dumps(b), k) for b, k in lists], "value string, asked string").write.json(f"{root}/lists")
    paths = populate(spark, inputs[0], f"{root}/lists", inputs[2], shared_dir(spark, "t_populate_out"), run_id="a",
                     as_of="2024-02-01", contract_request_key="asked")
    dead = spark.read.parquet(paths.dead_letters_path).where("kind = 'contracts'").collect()
    assert sorted((r.underlying_ticker, r.ticker or "", r.reason) for r in dead) == [
        ("AAPL", "", "missing_ticker"), ("AAPL", "O:7", "malformed"), ("AAPL", "O:9", "missing_underlying"),
        ("MSFT", "", "error_response")]
    assert all(r.record for r in dead)
    audit = {r.underlying_ticker: r for r in spark.read.parquet(paths.audit_path).collect()}
    assert (audit["AAPL"].n_contracts, audit["AAPL"].n_failed_contracts) == (1, 3)
    assert (audit["MSFT"].n_contracts, audit["MSFT"].n_failed_contracts, audit[None].n_failed) == (0, 1, 3)
