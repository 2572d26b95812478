"""Scale guards on the physical plans: pushdown, map-side combining, single parse, bounded
broadcast. These fail if a change silently loses one of them."""

import re

import __spark_entry__ as entry
from conftest import SF_SMOKE


def _plans(spark, name):
    df = entry.queries()[name](spark, SF_SMOKE)
    qe = df._jdf.queryExecution()
    strip = lambda s: re.sub(r"#\d+L?", "", s)  # noqa: E731 - drop expression ids
    return strip(qe.optimizedPlan().toString()), strip(qe.executedPlan().toString())


def test_day_range_is_pushed_to_the_scan(spark):
    _, physical = _plans(spark, "filter_bar_range")
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in physical


def test_top_n_limits_before_the_shuffle(spark):
    _, physical = _plans(spark, "topn_per_key")
    assert "WindowGroupLimit" in physical and "Partial" in physical


def test_bars_combine_map_side(spark):
    for name in ("bars_day", "prev_close", "load_audit"):
        _, physical = _plans(spark, name)
        assert "partial_" in physical, name
    _, physical = _plans(spark, "distinct_tickers")  # distinct: a partial and a final aggregate
    assert physical.count("HashAggregate(keys=[underlying_ticker], functions=[]") == 2


def test_each_decode_parses_once(spark):
    """No parse is there twice: that of the body, and for bodies of a wrong type those of the envelope and
    of each element."""
    for name, parses in (("json_contracts", 3), ("json_bars", 3), ("decode_good_bad_split", 3), ("load_audit_failed", 3),
                         ("quality_envelope_counts", 1), ("udf_array_struct_contracts", 3)):
        optimized, _ = _plans(spark, name)
        found = [p.split(", (mode")[0] for p in optimized.split("from_json(")[1:]]
        assert len(found) == len(set(found)) == parses, (name, len(found))


def test_no_window_partitioned_by_ticker_for_ordinals(spark):
    for name in ("sort_bars", "batch_assign"):
        _, physical = _plans(spark, name)
        assert "row_number()" not in physical, name
        assert "_pid" in physical, name  # windows see a row per partition and key


def test_ordered_first_and_last_hash(spark):
    for name in ("bars_day", "bars_4h_ny", "bars_rollup_week"):
        _, physical = _plans(spark, name)
        assert "SortAggregate" not in physical and "HashAggregate" in physical, name


def test_queries_leave_nothing_cached(spark):
    spark.catalog.clearCache()
    for name in ("json_bars", "explode_replace", "join_contract_documents", "cache_two_branches", "populate_audit",
                 "stream_land_bars", "sort_bars", "udf_array_struct_bars"):
        entry.queries()[name](spark, SF_SMOKE).count()
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


def test_decode_inputs_need_one_shuffle_at_most(spark):
    for name in ("json_bars", "json_contracts", "flatmap_map_in_pandas", "udf_array_struct_bars"):
        _, physical = _plans(spark, name)
        assert physical.count("Exchange ") <= 1 and "Python" not in physical and "Pandas" not in physical, name
    _, physical = _plans(spark, "decode_good_bad_split")
    assert physical.count("Exchange ") == 2  # of the input, which gathers the bars of a body, and of the counts
