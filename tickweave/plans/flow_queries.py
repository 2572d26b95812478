"""Decode-quality, array-of-struct, flatMap, streaming and whole-flow queries (E1, A5, D-U1, D-U2,
G2, B2)."""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import functions as F

from .. import testdata as td
from ..operators.generators import flat_map_records
from ..operators.quality import envelope_report, load_audit_outcomes
from ..schemas import BAR, CONTRACT
from ..session import delete_dir, input_bytes, release, shared_dir
from ..sinks.runs import RunLog, buckets_for
from ..sources.responses import (as_json_text, bar_response_pages, bars_of, classify_bar_responses,
                                 classify_contract_responses, contract_response_pages, contracts_of,
                                 decode_bar_responses, split_bar_responses)
from ..streaming.landing import land_bar_stream, land_contract_stream
from .populate import PopulationResult, populate
from .registry import register

v = td.with_views


@register("decode_good_bad_split", f"""
SELECT reason, count(*) AS n_records FROM (SELECT {td.BAR_REASON_SQL} AS reason FROM lineitem)
WHERE reason <> 'none' GROUP BY reason""")
def decode_good_bad_split(spark, sf):
    rows = classify_bar_responses(td.bar_texts_with_defects(spark, sf))
    return rows.groupBy(F.coalesce("reason", F.lit("good")).alias("reason")).agg(
        F.count(F.lit(1)).alias("n_records"))


@register("decode_contracts_split", f"""
SELECT reason, count(*) AS n_records FROM (SELECT {td.CONTRACT_REASON_SQL} AS reason FROM orders)
GROUP BY reason""")
def decode_contracts_split(spark, sf):
    rows = classify_contract_responses(td.contract_texts_with_defects(spark, sf))
    return rows.groupBy(F.coalesce("reason", F.lit("good")).alias("reason")).agg(
        F.count(F.lit(1)).alias("n_records"))


_DEFECT_CASE = f"""CASE {td.BAR_REASON_SQL} WHEN 'good' THEN 'good' WHEN 'none' THEN 'none' ELSE 'failed' END"""


def _audit_sql(contracts: str) -> str:
    """The audit over a contract table, with the failed records of no contract in a null row."""
    return f"""
, per_ticker AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS ticker,
    count(*) FILTER (WHERE {_DEFECT_CASE} = 'good') AS good,
    count(*) FILTER (WHERE {_DEFECT_CASE} = 'failed') AS failed
  FROM lineitem GROUP BY l_orderkey), listed AS ({contracts})
SELECT c.underlying_ticker, count(*) AS n_contracts, count(*) FILTER (WHERE p.good > 0) AS n_with_bars,
  count(*) FILTER (WHERE coalesce(p.good, 0) = 0) AS n_empty, CAST(coalesce(sum(p.good), 0) AS BIGINT) AS n_bars,
  CAST(coalesce(sum(p.failed), 0) AS BIGINT) AS n_failed
FROM listed c LEFT JOIN per_ticker p ON p.ticker = c.ticker GROUP BY c.underlying_ticker"""


@register("load_audit_failed", v(_audit_sql("SELECT * FROM contracts_v"), contracts=True))
def load_audit_failed(spark, sf):
    outcomes = classify_bar_responses(td.bar_texts_with_defects(spark, sf), request_key="request_ticker")
    return load_audit_outcomes(td.contracts(spark, sf), outcomes)


# ---- the whole flow: landed twice under two run ids, so the second run must change nothing ----

LANDED_BODIES = 250_000  # of a landed file
LANDED_INPUT = 256 << 20  # bytes of tables whose responses are landed at a time
AS_OF, LOOKBACK, BAR_RANGE = "1998-01-31", 30, ("1998-01-01", "1999-12-31")  # of the flow with filters only
_LISTED_SQL = "SELECT * FROM contracts_v WHERE CAST(ticker AS BIGINT) % 10 NOT IN (1, 2, 3, 5, 7, 9)"
_GOOD_SQL = f"""SELECT CAST(l_orderkey AS VARCHAR) AS ticker, l_extendedprice AS c, l_extendedprice * (1 + l_tax) AS h,
    l_extendedprice * (1 - l_discount) * (1 - l_tax) AS l, l_linenumber AS n,
    l_extendedprice * (1 - l_discount) AS o, epoch_us(l_shipdate) // 1000 AS t, CAST(l_quantity AS BIGINT) AS v,
    (l_extendedprice * (1 + l_tax) + l_extendedprice * (1 - l_discount) * (1 - l_tax) + l_extendedprice) / 3 AS vw
  FROM lineitem WHERE {_DEFECT_CASE} = 'good'"""
_AUDIT_COUNTS = ["n_contracts", "n_with_bars", "n_empty", "n_bars", "n_failed", "n_failed_contracts"]
_FLOWS: dict[tuple[str, str], tuple[str, PopulationResult]] = {}


def _land(texts, path) -> str:
    """Responses as landed files: compressed, small enough for many tasks to read."""
    texts.write.options(compression="gzip", maxRecordsPerFile=LANDED_BODIES).json(path)
    release(texts.sparkSession)
    return path


def _landed_in_parts(texts, key: str, path: str, parts: int) -> Iterator[str]:
    """Lands the responses part by part, by the hash of the key they were requested for: a part when it is asked
    for, while that before is deleted."""
    for k in range(parts):
        yield _land(texts.where(F.pmod(F.xxhash64(key), F.lit(parts)) == k), f"{path}/{k}")
        delete_dir(texts.sparkSession, f"{path}/{k}")


def _landed_universe(spark, sf, root) -> str:
    (td.table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("Symbol"),
                                            F.col("c_name").alias("Name"))
     .write.option("header", True).csv(f"{root}/in/universe"))
    return f"{root}/in/universe"


def _landed_inputs(spark, sf, root):
    """The inputs as the fetch stage would land them: a universe CSV, contract lists, bar responses."""
    return [_landed_universe(spark, sf, root), _land(td.contract_texts_with_defects(spark, sf), f"{root}/in/contracts"),
            _land(td.bar_texts_with_defects(spark, sf), f"{root}/in/bars")]


def _populate(spark, sf, root, runs: list[str], **options) -> PopulationResult:
    """The runs, each over the whole landed tables. What `LANDED_INPUT` bytes of tables give is landed once for
    all runs; of more, each run lands the responses again, part by part, so what is landed, staged and
    shuffled at a time does not grow with the tables."""
    tables = [f"{sf.rstrip('/')}/{n}.parquet" for n in ("orders", "lineitem")]
    parts = -(-input_bytes(spark, *tables) // LANDED_INPUT)
    if parts <= 1:
        universe, *landed = _landed_inputs(spark, sf, root)
        buckets = buckets_for(spark, *landed)
    else:
        universe, buckets = _landed_universe(spark, sf, root), buckets_for(spark, *tables)
    for run in runs:
        inputs = landed if parts <= 1 else [
            _landed_in_parts(td.contract_texts_with_defects(spark, sf), "request_underlying", f"{root}/in/contracts", parts),
            _landed_in_parts(td.bar_texts_with_defects(spark, sf), "request_ticker", f"{root}/in/bars", parts)]
        paths = populate(spark, universe, *inputs, f"{root}/out", run_id=run, as_of=AS_OF,
                         contract_request_key="request_underlying", id_buckets=buckets, **options)
    delete_dir(spark, f"{root}/in")
    return paths


def _populated(spark, sf) -> PopulationResult:
    """Both runs over the whole tables, once for a session and input: the queries read five outputs of
    one landing."""
    key = (spark.sparkContext.applicationId, sf)
    root, paths = _FLOWS.get(key, (None, None))
    if root is None or len(RunLog(spark, f"{root}/out").entries()) < 2:
        root = shared_dir(spark, "populate")
        paths = _populate(spark, sf, root, ["first", "second"], lookback_days=None)
        _FLOWS[key] = (root, paths)
    return paths


_ROWS_SQL = """
SELECT sha256(b.ticker || '|' || CAST(b.t AS VARCHAR) || '|1|day') AS agg_id, c.underlying_ticker, b.ticker,
  b.o AS open, b.h AS high, b.l AS low, b.c AS close, b.v AS volume, b.vw AS vwap, b.t AS timestamp,
  b.n AS transactions
FROM listed c JOIN good b ON b.ticker = c.ticker"""


@register("populate_end_to_end", v(f", listed AS ({_LISTED_SQL}), good AS ({_GOOD_SQL}) {_ROWS_SQL}", contracts=True))
def populate_end_to_end(spark, sf):
    rows = spark.read.parquet(_populated(spark, sf).rows_path)
    return rows.drop("run_id", "attempt", "hash_id")


@register("populate_filtered", v(f"""
, listed AS ({_LISTED_SQL} AND expiration_date >= DATE '{AS_OF}' - INTERVAL {LOOKBACK} DAY AND expiration_date >= DATE '{AS_OF}'),
good AS ({_GOOD_SQL} AND CAST(l_shipdate AS DATE) BETWEEN DATE '{BAR_RANGE[0]}' AND DATE '{BAR_RANGE[1]}') {_ROWS_SQL}""",
                                 contracts=True))
def populate_filtered(spark, sf):
    """The fetch's own filters (W2, W3, W4) on the whole tables, read back through the commit log."""
    root = shared_dir(spark, "populate")
    _populate(spark, sf, root, ["only"], lookback_days=LOOKBACK, expired=False, bar_range=BAR_RANGE)
    path = spark.read.parquet(f"{root}/out/rows").drop("run_id", "attempt")
    return RunLog(spark, f"{root}/out").read("rows", path.schema).drop("run_id", "hash_id")


@register("populate_documents", v(f"""
, listed AS ({_LISTED_SQL}), good AS ({_GOOD_SQL})
SELECT c.underlying_ticker, c.ticker, s.part, CAST(coalesce(s.n, 0) AS INTEGER) AS n_aggs, s.first_ts, s.last_ts
FROM listed c LEFT JOIN (
  SELECT ticker, CAST(date_part('year', make_timestamp(t * 1000)) AS INTEGER) AS part, count(*) AS n,
    min(t) AS first_ts, max(t) AS last_ts FROM good GROUP BY ALL) s ON s.ticker = c.ticker""", contracts=True))
def populate_documents(spark, sf):
    docs = spark.read.parquet(_populated(spark, sf).documents_path)
    return docs.select("underlying_ticker", "ticker", "part", F.size("aggs").alias("n_aggs"),
                       F.get("aggs", 0)["timestamp"].alias("first_ts"),
                       F.get("aggs", F.size("aggs") - 1)["timestamp"].alias("last_ts"))


@register("populate_contracts", v(f"""
, listed AS ({_LISTED_SQL})
SELECT underlying_ticker, ticker, contract_type, exercise_style, expiration_date, strike_price FROM listed""",
                                  contracts=True))
def populate_contracts(spark, sf):
    return spark.read.parquet(_populated(spark, sf).contracts_path).select(
        "underlying_ticker", "ticker", "contract_type", "exercise_style", "expiration_date", "strike_price")


@register("populate_dead_letters", f"""
SELECT 'bars' AS kind, CAST(NULL AS VARCHAR) AS underlying_ticker, CAST(l_orderkey AS VARCHAR) AS ticker,
  {td.BAR_REASON_SQL} AS reason FROM lineitem WHERE {_DEFECT_CASE} = 'failed'
UNION ALL SELECT 'contracts', CAST(o_custkey AS VARCHAR),
  CASE WHEN o_orderkey % 10 IN (2, 3, 5) THEN CAST(o_orderkey AS VARCHAR) END, {td.LISTED_REASON_SQL}
FROM orders WHERE {td.LISTED_REASON_SQL} <> 'good'""")
def populate_dead_letters(spark, sf):
    return spark.read.parquet(_populated(spark, sf).dead_letters_path).select(
        "kind", "underlying_ticker", "ticker", "reason")


@register("populate_audit", v(f"""
, listed AS ({_LISTED_SQL}), good AS ({_GOOD_SQL}),
bars AS (SELECT ticker, count(*) AS n FROM good GROUP BY ticker),
failed AS (SELECT CAST(l_orderkey AS VARCHAR) AS ticker, count(*) AS n FROM lineitem
  WHERE {_DEFECT_CASE} = 'failed' GROUP BY l_orderkey),
lists AS (SELECT CAST(o_custkey AS VARCHAR) AS underlying_ticker, count(*) AS n FROM orders
  WHERE {td.LISTED_REASON_SQL} <> 'good' GROUP BY o_custkey),
per AS (
SELECT c.underlying_ticker, count(*) AS n_contracts, count(b.n) AS n_with_bars, count(*) - count(b.n) AS n_empty,
  coalesce(sum(b.n), 0) AS n_bars, coalesce(sum(f.n), 0) AS n_failed, 0 AS n_failed_contracts
FROM listed c LEFT JOIN bars b ON b.ticker = c.ticker LEFT JOIN failed f ON f.ticker = c.ticker
GROUP BY c.underlying_ticker
UNION ALL SELECT NULL, 0, 0, 0, 0, sum(n), 0 FROM failed
WHERE ticker NOT IN (SELECT ticker FROM listed) HAVING count(*) > 0
UNION ALL SELECT underlying_ticker, 0, 0, 0, 0, 0, n FROM lists)
SELECT underlying_ticker, {", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in _AUDIT_COUNTS)}
FROM per GROUP BY underlying_ticker""", contracts=True))
def populate_audit(spark, sf):
    audit = spark.read.parquet(_populated(spark, sf).audit_path)
    return audit.where(F.col("run_id") == "second").drop("run_id", "attempt")


@register("quality_envelope_counts", v("""
, per AS (SELECT ticker, date_part('year', make_timestamp(t * 1000)) AS page, count(*) AS n FROM bars_v GROUP BY ALL)
SELECT 'OK' AS status, count(*) AS n_responses, count(*) FILTER (WHERE page % 2 = 0) AS n_mismatched,
  CAST(0 AS BIGINT) AS n_undeclared, CAST(sum(n + CASE WHEN page % 2 = 0 THEN 1 ELSE 0 END) AS BIGINT)
  AS declared_total, CAST(sum(n) AS BIGINT) AS actual_total FROM per""", bars=True))
def quality_envelope_counts(spark, sf):
    pages = bar_response_pages(td.bars(spark, sf))
    # envelopes of even years declare one bar more than they hold
    even = 1 - F.pmod(F.substring_index("request_id", "-", -1).cast("int"), F.lit(2))
    declared = pages.withColumn("resultsCount", F.col("resultsCount") + even)
    _, _, envelopes = split_bar_responses(as_json_text(declared))
    return envelope_report(envelopes)


@register("udf_array_struct_contracts", v("""
SELECT ticker, underlying_ticker, contract_type, exercise_style, strftime(expiration_date, '%Y-%m-%d')
  AS expiration_date, strike_price FROM contracts_v""", contracts=True))
def udf_array_struct_contracts(spark, sf):
    texts = as_json_text(contract_response_pages(td.contracts(spark, sf)), drop=["underlying_ticker", "page"])
    return texts.select(F.explode(contracts_of("value")).alias("c")).select("c.*")


@register("udf_array_struct_bars", v("""
SELECT ticker, o AS open, h AS high, l AS low, c AS close, v AS volume, vw AS vwap, t AS timestamp,
  n AS transactions, sha256(ticker || '|' || CAST(t AS VARCHAR) || '|1|day') AS agg_id FROM bars_v""",
                                     bars=True))
def udf_array_struct_bars(spark, sf):
    pages = bar_response_pages(td.bars(spark, sf))
    texts = pages.select("ticker", F.to_json(F.struct(*pages.columns)).alias("value"))
    return texts.select("ticker", F.explode(bars_of("value")).alias("b")).select("ticker", "b.*")


def bars_in_body(row: dict) -> Iterator[dict]:
    """The elements of a response body, as a user's own function for `flat_map_records` may yield them."""
    body = json.loads(row["value"])
    for bar in body.get("results") or []:
        if isinstance(bar, dict):
            volume = bar.get("v")
            whole = isinstance(volume, float) and volume.is_integer()
            yield {"ticker": body.get("ticker"), **bar, "v": int(volume) if whole else volume}
        else:
            yield {"bar": bar}  # no field of the schema: a dead letter


@register("flatmap_map_in_pandas", v("SELECT * FROM bars_v", bars=True))
def flatmap_map_in_pandas(spark, sf):
    """G2, one text -> 0..n typed bars by a Python function over Arrow batches."""
    texts = as_json_text(bar_response_pages(td.bars(spark, sf)))
    return flat_map_records(texts, bars_in_body, BAR, "value").where("reason IS NULL").select(*BAR.fieldNames())


# a body that is no JSON fails; a value that does not fit its type is a bad record; the rest has its types
@register("flatmap_dead_letters", f"""
SELECT CASE WHEN l_linenumber = 7 THEN 'failed'
  WHEN {td.BAR_REASON_SQL} IN ('malformed', 'null_bar', 'fractional_volume', 'volume_out_of_range') THEN 'bad_record'
  ELSE 'good' END AS reason, count(*) AS n_records
FROM lineitem WHERE {td.BAR_REASON_SQL} NOT IN ('none', 'error_response') GROUP BY ALL""")
def flatmap_dead_letters(spark, sf):
    """G2 over faulty bodies: good and bad records of one body, and bodies that the function fails on."""
    rows = flat_map_records(td.bar_texts_with_defects(spark, sf), bars_in_body, BAR, "value")
    return rows.groupBy(F.coalesce("reason", F.lit("good")).alias("reason")).agg(F.count(F.lit(1)).alias("n_records"))


@register("stream_land_bars", v(f"""
SELECT ticker, c, h, l, n, o, t, v, vw FROM (
  SELECT CAST(l_orderkey AS VARCHAR) AS ticker, l_extendedprice AS c, l_extendedprice * (1 + l_tax) AS h,
    l_extendedprice * (1 - l_discount) * (1 - l_tax) AS l, l_linenumber AS n,
    l_extendedprice * (1 - l_discount) AS o, epoch_us(l_shipdate) // 1000 AS t, CAST(l_quantity AS BIGINT) AS v,
    (l_extendedprice * (1 + l_tax) + l_extendedprice * (1 - l_discount) * (1 - l_tax) + l_extendedprice) / 3 AS vw
  FROM lineitem WHERE {_DEFECT_CASE} = 'good')""", bars=True))
def stream_land_bars(spark, sf):
    """Two landings, each with a checkpoint of its own, into one table and under one run id; the input has
    defects."""
    table, dead = shared_dir(spark, "landed", "bars"), shared_dir(spark, "landed", "bars_dead_letter")
    texts = td.bar_texts_with_defects(spark, sf)
    odd = F.pmod(F.col("request_ticker").cast("bigint"), F.lit(2)) == 1
    parts = max(1, -(-input_bytes(spark, f"{sf.rstrip('/')}/lineitem.parquet") // (2 * LANDED_INPUT)))
    for half in (texts.where(odd), texts.where(~odd)):
        checkpoint = shared_dir(spark, "streams", "land_bars")
        landing = shared_dir(spark, "landing", "bars")
        # what arrives later is what the checkpoint has not seen
        for _ in _landed_in_parts(half, "request_ticker", landing, parts):
            land_bar_stream(spark, f"{landing}/*", table, checkpoint, dead_letter_dir=dead, request_key="request_ticker",
                            run_id="nightly")
    return spark.read.parquet(table).select(*BAR.fieldNames())


# a contract without a ticker or an underlying is landed as it came
_LANDED_CONTRACT = {"ticker": "CASE WHEN CAST(ticker AS BIGINT) % 10 <> 1 THEN ticker END AS ticker",
                    "underlying_ticker": "CASE WHEN CAST(ticker AS BIGINT) % 10 <> 5 THEN underlying_ticker END AS underlying_ticker"}


def _landed_contracts(spark, sf) -> tuple[str, str]:
    landing, table, dead = (shared_dir(spark, n, "contracts") for n in ("landing", "landed", "landed_dead"))
    td.contract_texts_with_defects(spark, sf).write.json(landing)
    land_contract_stream(spark, landing, table, shared_dir(spark, "streams", "land_contracts"), dead_letter_dir=dead,
                         request_key="request_underlying")
    return table, dead


@register("stream_land_contracts", v(f"""
SELECT {", ".join(_LANDED_CONTRACT.get(c, c) for c in CONTRACT.fieldNames())} FROM contracts_v
WHERE CAST(ticker AS BIGINT) % 10 NOT IN (2, 3, 7, 9)""", contracts=True))
def stream_land_contracts(spark, sf):
    return spark.read.parquet(_landed_contracts(spark, sf)[0]).select(*CONTRACT.fieldNames())


@register("stream_contract_dead_letters", f"""
SELECT CAST(o_custkey AS VARCHAR) AS underlying_ticker, {td.CONTRACT_REASON_SQL} AS reason, count(*) AS n_records
FROM orders WHERE {td.CONTRACT_REASON_SQL} <> 'good' GROUP BY ALL""")
def stream_contract_dead_letters(spark, sf):
    """E2's input from a stream: failed contract lists and contracts, under the underlying asked for."""
    dead = spark.read.parquet(_landed_contracts(spark, sf)[1])
    return dead.groupBy("underlying_ticker", "reason").agg(F.count(F.lit(1)).alias("n_records"))
