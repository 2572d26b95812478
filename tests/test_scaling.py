"""What moves, what is tried and what is written does not grow faster than the input has to."""

import json
import re
import types

import pyarrow as pa

import __spark_entry__ as entry
from conftest import SF_SMOKE
from tickweave import testdata as td
from tickweave.operators import generators
from tickweave.plans import flow_queries
from tickweave.session import shared_dir
from tickweave.sinks.runs import MIN_BUCKETS, RunLog, buckets_for
from tickweave.sources.responses import classify_bar_responses


def _plan(df, which="optimizedPlan"):
    return re.sub(r"#\d+L?", "", getattr(df._jdf.queryExecution(), which)().toString())


def _below_the_first_exchange(df):
    """The physical plan from its outermost exchange of line items down."""
    plan = _plan(df, "executedPlan")
    return plan[plan.index("Exchange hashpartitioning(ticker"):]


def test_documents_move_times_only(spark):
    for name in ("explode_replace", "join_contract_documents"):
        plan = _plan(entry.queries()[name](spark, SF_SMOKE), "executedPlan")
        gathered = [line for line in plan.splitlines() if "collect_list(" in line]
        assert gathered and not any("sha2" in line or "vw" in line for line in gathered), (name, gathered)


def test_texts_are_made_after_the_exchange(spark):
    plan = _below_the_first_exchange(td.bar_texts_with_defects(spark, SF_SMOKE))
    assert "collect_list" not in plan and "StructsToJson" not in plan and "l_extendedprice" in plan


def test_a_status_is_judged_once(spark):
    rows = classify_bar_responses(spark.createDataFrame([("{}", "a")], "value string, k string"), request_key="k")
    assert _plan(rows).count("upper(") == 1


def test_plain_records_need_no_trial_conversion(spark, monkeypatch):
    tried = []

    class Counted:
        @staticmethod
        def from_pylist(rows, schema):
            tried.append(len(rows))
            return pa.RecordBatch.from_pylist(rows, schema=schema)

    fake = types.SimpleNamespace(**{k: getattr(pa, k) for k in dir(pa) if not k.startswith("_")} | {"RecordBatch": Counted})
    monkeypatch.setattr(generators, "pa", fake)
    monkeypatch.setattr(generators, "ship_package", lambda spark: None)
    frame = types.SimpleNamespace(sparkSession=None, mapInArrow=lambda run, schema: run)
    values = [1, -5, 2 ** 63 - 1, -2 ** 63, None, 2 ** 63, 1.0, "1", True]
    run = generators.flat_map_records(frame, lambda row: json.loads(row["value"]), "n bigint, x double, s string", "value")
    records = [{"n": v, "x": 0.5, "s": "a"} for v in values] + [{"n": 1, "y": 1}, {"x": 2 ** 53 + 1}, {"x": 7, "s": "\u00e9"}]
    batch = pa.RecordBatch.from_pylist([{"value": json.dumps(records)}, {"value": "{"}])
    got = [r for b in run(iter([batch])) for r in b.to_pylist()]
    assert [r["n"] for r in got if r["reason"] is None] == [1, -5, 2 ** 63 - 1, -2 ** 63, None, None]
    assert [r["reason"] for r in got if r["reason"]] == ["bad_record"] * 6 + ["failed"]
    assert tried == [1, 1, 13]  # the two that their types do not tell, and the batch


def test_landed_inputs_are_compressed_and_their_shuffles_released(spark):
    root = shared_dir(spark, "t_landed")
    paths = flow_queries._landed_inputs(spark, SF_SMOKE, root)
    assert len(paths) == 3
    for path, texts in zip(paths[1:], (td.contract_texts_with_defects, td.bar_texts_with_defects)):
        files = spark.read.format("binaryFile").load(path).select("path").collect()
        assert files and all(r.path.endswith(".json.gz") for r in files)
        assert spark.read.json(path).count() == texts(spark, SF_SMOKE).count()


def test_buckets_follow_the_input(spark, monkeypatch):
    path = shared_dir(spark, "t_buckets")
    spark.range(20_000).selectExpr("sha2(cast(id AS string), 256) AS value").write.text(path)
    assert buckets_for(spark, path) == MIN_BUCKETS
    monkeypatch.setattr("tickweave.sinks.runs.BUCKET_INPUT", 10_000)
    assert buckets_for(spark, path) == 130 and buckets_for(spark, path, path) == 260


def test_rows_of_runs_get_their_bar_id_after_they_moved(spark):
    """Rows hold what they held: ids over all columns, `agg_id` among them."""
    from tickweave.functions.hashing import bar_id, row_id
    from tickweave.plans.populate import FLAT_COLUMNS
    rows = spark.read.parquet(flow_queries._populated(spark, SF_SMOKE).rows_path)
    again = rows.withColumns({"a": bar_id("ticker", "timestamp"), "h": row_id(rows.schema, FLAT_COLUMNS)})
    assert rows.count() > 0 and again.where("NOT (a <=> agg_id AND h <=> hash_id)").count() == 0
    assert RunLog(spark, shared_dir(spark, "t_none")).entries() == []


def _files(spark, path):
    return [r.path for r in spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path").collect()]


def test_bars_are_landed_in_parts_that_go_once_they_are_stored(spark, monkeypatch):
    monkeypatch.setattr(flow_queries, "LANDED_INPUT", 30_000)
    seen, land = [], flow_queries.land_bar_stream

    def watched(spark, landing, table, checkpoint, **options):
        seen.append((landing, checkpoint, {f.rsplit("/", 2)[1] for f in _files(spark, landing)}, table))
        assert all(f.endswith(".json.gz") for f in _files(spark, landing))
        return land(spark, landing, table, checkpoint, **options)

    monkeypatch.setattr(flow_queries, "land_bar_stream", watched)
    rows = flow_queries.stream_land_bars(spark, SF_SMOKE)
    good = classify_bar_responses(td.bar_texts_with_defects(spark, SF_SMOKE), request_key="request_ticker").where("reason IS NULL")
    assert rows.count() == rows.distinct().count() == good.count() > 0
    assert rows.exceptAll(good.select(*rows.columns)).isEmpty()
    assert [parts for _, _, parts, _ in seen] == [{"0"}, {"1"}] * 2  # no part stays beside the next
    assert len({checkpoint for _, checkpoint, _, _ in seen}) == 2
    assert all(".zstd." in f for f in _files(spark, seen[0][3]))
    for landing in {s[0] for s in seen}:
        status = spark._jvm.org.apache.hadoop.fs.Path(landing)
        assert not status.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(status)
