"""Projection, filter, scalar, ranking, join and aggregate queries over the stand-in views.

Fixed parameters (as-of dates, ranges, n) are chosen inside the data's 1995-2001 span.
Bar orderings always end in the full tiebreak (t, n, c, o, h, l, v, vw): whole rows are
unique but (ticker, t) is not.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import testdata as td
from ..functions import hashing as H
from ..functions import timefns as TF
from ..functions.arrays import first_or_null, keep_fields
from ..functions.casts import narrow_to_float
from ..operators import filters as W
from ..operators import joins as J
from ..operators import projections as P
from ..operators import quality as Q
from ..operators import ranking as R
from ..operators.batching import assign_batches
from ..operators.combine import union_all
from ..operators.partitioning import by_key, reuse, spread
from ..schemas import BAR
from ..session import land
from ..sources.responses import bar_response_pages
from .registry import register

AS_OF = "1999-01-01"
CLOSE_AS_OF = "2000-06-01"
RANGE = ("2000-01-01", "2000-03-31")
TIEBREAK = ["n", "c", "o", "h", "l", "v", "vw"]
BAR_ORDER_SQL = "t, n, c, o, h, l, v, vw"
NARROW = ", ".join(P.CONTRACT_NARROW)
v = td.with_views


def _esc_sql(col: str) -> str:
    return f"coalesce(replace(replace(replace({col}, '\\', '\\\\'), '|', '\\|'), '∅', '\\∅'), '∅')"


# ---------------- projections ----------------

@register("proj_contract_columns", v(f"SELECT {NARROW} FROM contracts_v", contracts=True))
def proj_contract_columns(spark, sf):
    return P.contract_columns(td.contracts(spark, sf))


@register("proj_struct_fields", v(f"SELECT {NARROW} FROM contracts_v", contracts=True))
def proj_struct_fields(spark, sf):
    nested = td.contracts(spark, sf).select(
        "underlying_ticker",
        F.struct("ticker", "contract_type", "exercise_style", "expiration_date", "strike_price").alias("option"))
    return P.flatten_struct(nested, "option", ["ticker", "contract_type", "exercise_style", "expiration_date",
                                               "strike_price"], keep=["underlying_ticker"])


@register("proj_with_column", v("SELECT *, c * v AS notional FROM bars_v", bars=True))
def proj_with_column(spark, sf):
    return td.bars(spark, sf).withColumn("notional", F.col("c") * F.col("v"))


@register("explode_replace", v("""
SELECT b.ticker, b.t AS timestamp,
  sha256(b.ticker || '|' || CAST(b.t AS VARCHAR) || '|1|day') AS agg_id
FROM contracts_v c JOIN bars_v b ON b.ticker = c.ticker""", contracts=True, bars=True))
def explode_replace(spark, sf):
    docs = J.contract_documents(td.contracts(spark, sf), td.bars(spark, sf))
    return P.replace_with_element(docs, "aggs").select(
        "ticker", F.col("aggs.timestamp").alias("timestamp"), F.col("aggs.agg_id").alias("agg_id"))


@register("proj_select_expr", v(f"SELECT {NARROW} FROM contracts_v", contracts=True))
def proj_select_expr(spark, sf):
    from ..sources.responses import contract_response_pages
    pages = contract_response_pages(td.contracts(spark, sf))
    return (pages.selectExpr("underlying_ticker", "explode(results) AS option")
            .selectExpr("underlying_ticker", "option.ticker AS ticker", "option.contract_type AS contract_type",
                        "option.exercise_style AS exercise_style",
                        "to_date(option.expiration_date) AS expiration_date",
                        "option.strike_price AS strike_price"))


@register("proj_rename", v("""
SELECT cfi, contract_type AS contractType, correction, exercise_style AS exerciseStyle,
  expiration_date AS expirationDate, primary_exchange AS primaryExchange,
  shares_per_contract AS sharesPerContract, strike_price AS strikePrice, ticker,
  underlying_ticker AS underlyingTicker FROM contracts_v""", contracts=True))
def proj_rename(spark, sf):
    return P.to_camel_case(td.contracts(spark, sf))


@register("proj_bar_names", v("""
SELECT ticker, c AS close, h AS high, l AS low, n AS transactions, o AS open, t AS timestamp,
  v AS volume, vw AS vwap FROM bars_v""", bars=True))
def proj_bar_names(spark, sf):
    return P.bar_long_names(td.bars(spark, sf))


# ---------------- filters ----------------

@register("filter_not_null", v("""
SELECT u.underlying_ticker, c.ticker FROM universe_v u LEFT JOIN contracts_v c
  ON c.underlying_ticker = u.underlying_ticker WHERE c.ticker IS NOT NULL""", universe=True, contracts=True))
def filter_not_null(spark, sf):
    joined = J.skew_safe_left_join(td.universe(spark, sf),
                                   td.contracts(spark, sf).select("underlying_ticker", "ticker"), "underlying_ticker")
    return W.drop_null(joined, "ticker")


@register("filter_expiry_gte", v(f"""
SELECT {NARROW} FROM contracts_v WHERE expiration_date >= DATE '{AS_OF}' - INTERVAL 30 DAY""", contracts=True))
def filter_expiry_gte(spark, sf):
    return P.contract_columns(W.expiring_since(td.contracts(spark, sf), AS_OF, 30))


@register("filter_expired_flag", v(f"""
SELECT {NARROW} FROM contracts_v WHERE expiration_date >= DATE '{AS_OF}'""", contracts=True))
def filter_expired_flag(spark, sf):
    return P.contract_columns(W.by_expired_flag(td.contracts(spark, sf), AS_OF, expired=False))


@register("filter_expired_true", v(f"""
SELECT {NARROW} FROM contracts_v WHERE expiration_date < DATE '{AS_OF}'""", contracts=True))
def filter_expired_true(spark, sf):
    return P.contract_columns(W.by_expired_flag(td.contracts(spark, sf), AS_OF, expired=True))


@register("filter_bar_range", v(f"""
SELECT * FROM bars_v WHERE CAST(make_timestamp(t * 1000) AS DATE)
  BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}'""", bars=True))
def filter_bar_range(spark, sf):
    # the same day range on the stored timestamp first, so the scan skips row groups
    # (PushedFilters); the operator then applies W4 on the bar's epoch-ms `t`
    return W.bars_in_day_range(td.bars(spark, sf, TF.in_day_range("l_shipdate", *RANGE)), *RANGE)


@register("filter_underlying", v(f"""
SELECT {NARROW} FROM contracts_v WHERE underlying_ticker IN
  (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_mktsegment = 'BUILDING')""", contracts=True))
def filter_underlying(spark, sf):
    chosen = (td.table(spark, sf, "customer").where(F.col("c_mktsegment") == "BUILDING")
              .select(F.col("c_custkey").cast("string").alias("underlying_ticker")))
    return P.contract_columns(W.for_underlyings(td.contracts(spark, sf), chosen))


@register("filter_nonempty_array", v("""
SELECT ticker, CAST(date_part('year', make_timestamp(t * 1000)) AS INTEGER) AS part, CAST(count(*) AS INTEGER) AS n_aggs
FROM bars_v WHERE ticker IN (SELECT ticker FROM contracts_v) GROUP BY ALL""", contracts=True, bars=True))
def filter_nonempty_array(spark, sf):
    docs = J.contract_documents(td.contracts(spark, sf), td.bars(spark, sf))
    return W.with_results(docs, "aggs").select("ticker", "part", F.size("aggs").alias("n_aggs"))


_PAGE_SQL = "CAST(strftime(make_timestamp(t * 1000), '%Y') AS INTEGER)"


def _page():
    """The year of a response page, from its request id."""
    return F.substring_index("request_id", "-", -1).cast("int")


@register("coalesce_empty_array", v(f"""
SELECT c.ticker, p.page, CAST(coalesce(p.n, 0) AS INTEGER) AS n_results
FROM contracts_v c LEFT JOIN (SELECT ticker, {_PAGE_SQL} AS page, count(*) AS n FROM bars_v GROUP BY ALL) p
  ON p.ticker = c.ticker""", contracts=True, bars=True))
def coalesce_empty_array(spark, sf):
    # pages per ticker are bounded by its months, so the right side has no hot key
    pages = bar_response_pages(td.bars(spark, sf)).select("ticker", _page().alias("page"), "results")
    joined = td.contracts(spark, sf).select("ticker").join(pages, "ticker", "left")
    return W.null_results_to_empty(joined, "results").select("ticker", "page", F.size("results").alias("n_results"))


# ---------------- generators / arrays ----------------

@register("explode_bars", v("SELECT * FROM bars_v", bars=True))
def explode_bars(spark, sf):
    pages = bar_response_pages(td.bars(spark, sf))
    out = pages.select("ticker", F.explode("results").alias("b"))
    return out.select("ticker", *[(F.col("b.v").cast("bigint") if n == "v" else F.col(f"b.{n}")).alias(n)
                                  for n in ["c", "h", "l", "n", "o", "t", "v", "vw"]])


@register("hof_transform", v("SELECT ticker, t AS timestamp, vw AS vwap FROM bars_v", bars=True))
def hof_transform(spark, sf):
    pages = bar_response_pages(td.bars(spark, sf))
    kept = pages.select("ticker", keep_fields("results", {"t": "timestamp", "vw": "vwap"}).alias("aggs"))
    return kept.select("ticker", F.explode("aggs").alias("a")).select("ticker", "a.timestamp", "a.vwap")


@register("array_first", v(f"""
SELECT c.ticker, f.t AS first_t, f.c AS first_c FROM contracts_v c LEFT JOIN (
  SELECT ticker, t, c FROM bars_v QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY {BAR_ORDER_SQL}) = 1
) f ON f.ticker = c.ticker""", contracts=True, bars=True))
def array_first(spark, sf):
    pages = bar_response_pages(td.bars(spark, sf)).groupBy("ticker").agg(F.min_by("results", _page()).alias("results"))
    joined = W.null_results_to_empty(td.contracts(spark, sf).select("ticker").join(pages, "ticker", "left"), "results")
    first = first_or_null("results")
    return joined.select("ticker", first["t"].alias("first_t"), first["c"].alias("first_c"))


# ---------------- scalar functions ----------------

@register("hash_md5", v("SELECT ticker, t, md5(CAST(t AS VARCHAR)) AS agg_id FROM bars_v", bars=True))
def hash_md5(spark, sf):
    return td.bars(spark, sf).select("ticker", "t", H.md5_of_text("t").alias("agg_id"))


def _u(n: int) -> str:
    return f"CAST({n} AS UBIGINT)"


_M32 = _u(1 << 32)


def _rotl(x: str, r: int) -> str:
    return f"(({x}) * {_u(1 << r)} % {_M32} + ({x}) // {_u(1 << (32 - r))})"


def _mixed_word(w: str) -> str:
    """A 32-bit word as Murmur3 mixes it into the state."""
    return f"({_rotl(f'({w} * {_u(3432918353)} % {_M32})', 15)} * {_u(461845907)} % {_M32})"


def _text_words(col: str) -> str:
    """UTF-8 bytes as the hash takes them: words of four, then each byte left over, signed."""
    x, size = f"hex({col})", f"(length(hex({col})) // 2)"
    four = " || ".join(f"substr({x}, CAST(8 * i + {k} AS BIGINT), 2)" for k in (7, 5, 3, 1))
    last = f"CAST('0x' || substr({x}, CAST(2 * i + 1 AS BIGINT), 2) AS UBIGINT)"
    return f"""list_concat(list_transform(range({size} // 4), lambda i: CAST('0x' || {four} AS UBIGINT)),
      list_transform(range({size} // 4 * 4, {size}), lambda i: {last} + CASE WHEN {last} > 127 THEN {_u((1 << 32) - 256)} ELSE {_u(0)} END))"""


def _murmur_sql(steps: list[tuple[str, str]], columns: str) -> str:
    """Murmur3 (32 bit, seed 42) over (column, 'int' | 'long' | 'double' | 'text') of bars_v, step by step in
    CTEs of unsigned arithmetic; each column's hash is the seed of the next."""
    ctes, last, k = ["m0 AS (SELECT *, CAST(42 AS UBIGINT) AS state FROM bars_v)"], "m0", 0

    def step(value: str):
        nonlocal last, k
        k += 1
        ctes.append(f"m{k} AS (SELECT * REPLACE (CAST({value} AS UBIGINT) AS state) FROM {last})")
        last = f"m{k}"

    for value, kind in steps:
        if kind == "text":
            added = f"list_transform({_text_words(value)}, lambda w: {_mixed_word('w')})"
            step(f"list_reduce(list_prepend(state, {added}), lambda a, w: "
                 f"({_rotl('xor(a, w)', 13)} * {_u(5)} + {_u(3864292196)}) % {_M32})")
            step(f"xor(state, length(hex({value})) // 2)")
        else:
            wide = f"CAST(CAST(CASE WHEN {value} = 0 THEN 0.0 ELSE {value} END AS DOUBLE)::BIT AS UBIGINT)" if kind == "double" \
                else f"CAST((CAST({value} AS HUGEINT) + 18446744073709551616) % 18446744073709551616 AS UBIGINT)"
            words = [f"({wide} % {_M32})"] + ([] if kind == "int" else [f"({wide} // {_M32})"])
            for w in words:
                step(f"xor(state, {_mixed_word(w)})")
                step(_rotl("state", 13))
                step(f"(state * {_u(5)} + {_u(3864292196)}) % {_M32}")
            step(f"xor(state, {_u(4 * len(words))})")
        for shift, factor in ((16, 2246822507), (13, 3266489909), (16, None)):
            step(f"xor(state, state // {_u(1 << shift)})" + (f" * {_u(factor)} % {_M32}" if factor else ""))
    return ", " + ",\n".join(ctes) + f"\nSELECT {columns}, " \
        f"printf('%X', CASE WHEN state < 2147483648 THEN CAST(state AS BIGINT) ELSE CAST(state AS BIGINT) - 4294967296 END) AS hash_id FROM {last}"


# record-bean column order: properties alphabetically
_ROW_HASH = [("c", "double"), ("h", "double"), ("l", "double"), ("n", "int"), ("o", "double"), ("t", "long"),
             ("ticker", "text"), ("v", "long"), ("vw", "double")]


@register("hash_row_murmur", v(_murmur_sql(_ROW_HASH, ", ".join(BAR.fieldNames())), bars=True))
def hash_row_murmur(spark, sf):
    return td.bars(spark, sf).withColumn("hash_id", H.murmur_fingerprint(*[c for c, _ in _ROW_HASH]))


@register("hash_int_murmur", v(_murmur_sql([("n", "int"), ("t", "long"), ("v", "long")], "ticker, n, t, v"), bars=True))
def hash_int_murmur(spark, sf):
    """F2 over the integral columns."""
    b = td.bars(spark, sf).select("ticker", "n", "t", "v")
    return b.withColumn("hash_id", H.murmur_fingerprint("n", "t", "v"))


@register("hash_text_murmur", v(_murmur_sql([("contract_type", "text"), ("ticker", "text"), ("strike_price", "double")], "ticker")
                                .replace("bars_v", "contracts_v"), contracts=True))
def hash_text_murmur(spark, sf):
    """F2 over texts of many lengths and a double."""
    c = td.contracts(spark, sf)
    return c.select("ticker", H.murmur_fingerprint("contract_type", "ticker", "strike_price").alias("hash_id"))


_F2B_COLS = ["ticker", "underlying_ticker", "contract_type", "exercise_style", "expiration_date", "cfi", "correction"]


@register("hash_row_sha2", v(f"""
SELECT ticker, sha256(concat_ws('|', {_esc_sql('ticker')}, {_esc_sql('underlying_ticker')},
  {_esc_sql('contract_type')}, {_esc_sql('exercise_style')},
  coalesce(strftime(expiration_date, '%Y-%m-%d'), '∅'), {_esc_sql('cfi')},
  coalesce(CAST(correction AS VARCHAR), '∅'))) AS row_id FROM contracts_v""", contracts=True))
def hash_row_sha2(spark, sf):
    c = td.contracts(spark, sf)
    return c.select("ticker", H.row_id(c.schema, _F2B_COLS).alias("row_id"))


@register("hash_sha256", v("SELECT ticker, sha256(ticker) AS ticker_sha256 FROM contracts_v", contracts=True))
def hash_sha256(spark, sf):
    return td.contracts(spark, sf).select("ticker", H.sha256_hex("ticker").alias("ticker_sha256"))


@register("str_batch_key", v("""
SELECT ticker, sha256(underlying_ticker) || '-' || strftime(expiration_date, '%Y-%m-%d') AS batch_key
FROM contracts_v""", contracts=True))
def str_batch_key(spark, sf):
    return td.contracts(spark, sf).select(
        "ticker", H.batch_key(H.sha256_hex("underlying_ticker"), "expiration_date").alias("batch_key"))


@register("date_ny_day", """
SELECT event_id, strftime(timezone('America/New_York', ts AT TIME ZONE 'UTC'), '%Y-%m-%d') AS ny_day,
  CAST(timezone('America/New_York', ts AT TIME ZONE 'UTC') AS DATE) AS ny_date
FROM events""")
def date_ny_day(spark, sf):
    ev = td.table(spark, sf, "events")
    return ev.select("event_id", TF.local_day_text("ts").alias("ny_day"), TF.local_day("ts").alias("ny_date"))


@register("date_sub_days", v("""
SELECT ticker, expiration_date, CAST(expiration_date - INTERVAL 30 DAY AS DATE) AS lookback_date
FROM contracts_v""", contracts=True))
def date_sub_days(spark, sf):
    return td.contracts(spark, sf).select("ticker", "expiration_date",
                                          TF.days_before("expiration_date", 30).alias("lookback_date"))


@register("date_format_ymd", v("""
SELECT ticker, strftime(expiration_date, '%Y-%m-%d') AS expiration_text FROM contracts_v""", contracts=True))
def date_format_ymd(spark, sf):
    return td.contracts(spark, sf).select("ticker", TF.ymd_text("expiration_date").alias("expiration_text"))


@register("cast_float", v(f"""
SELECT {NARROW.replace('strike_price', 'CAST(strike_price AS FLOAT) AS strike_price')} FROM contracts_v""",
                          contracts=True))
def cast_float(spark, sf):
    return narrow_to_float(P.contract_columns(td.contracts(spark, sf)), ["strike_price"])


@register("ts_epoch_ms", """
SELECT event_id, epoch_us(ts) // 1000 AS t, make_timestamp((epoch_us(ts) // 1000) * 1000) AS ts_ms FROM events""")
def ts_epoch_ms(spark, sf):
    ev = td.table(spark, sf, "events").select("event_id", TF.epoch_millis("ts").alias("t"))
    return ev.withColumn("ts_ms", TF.utc_ntz_from_millis("t"))


# ---------------- aggregates, order, limits, union ----------------

@register("agg_count", "SELECT count(*) AS n FROM lineitem")
def agg_count(spark, sf):
    return Q.row_count(td.bars(spark, sf))


@register("agg_result_size", v("""
SELECT ticker, count(DISTINCT date_trunc('year', make_timestamp(t * 1000))) AS n_responses, count(*) AS n_results
FROM bars_v GROUP BY ticker""", bars=True))
def agg_result_size(spark, sf):
    return Q.result_sizes(bar_response_pages(td.bars(spark, sf)))


@register("sort_bars", v(f"""
SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY {BAR_ORDER_SQL}) AS seq FROM bars_v""", bars=True))
def sort_bars(spark, sf):
    return R.with_sequence(td.bars(spark, sf), tiebreak=TIEBREAK)


@register("sort_bars_desc", v("""
SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY t DESC, n DESC, c DESC, o DESC, h DESC, l DESC,
  v DESC, vw DESC) AS seq FROM bars_v""", bars=True))
def sort_bars_desc(spark, sf):
    return R.with_sequence(td.bars(spark, sf), descending=True, tiebreak=TIEBREAK)


@register("limit_topk", v(f"""
SELECT {NARROW} FROM contracts_v ORDER BY strike_price DESC, ticker LIMIT 100""", contracts=True))
def limit_topk(spark, sf):
    c = P.contract_columns(td.contracts(spark, sf))
    return R.top_k(c, 100, [F.col("strike_price").desc(), F.col("ticker").asc()])


@register("topn_per_key", v(f"""
SELECT {NARROW},
  CAST(row_number() OVER (PARTITION BY underlying_ticker ORDER BY expiration_date DESC, ticker) AS INTEGER) AS rank
FROM contracts_v QUALIFY rank <= 3""", contracts=True))
def topn_per_key(spark, sf):
    c = P.contract_columns(td.contracts(spark, sf))
    return R.top_n_per_key(c, ["underlying_ticker"], [F.col("expiration_date").desc(), F.col("ticker").asc()],
                           3, rank_col="rank")


@register("union_all", v("SELECT * FROM bars_v", bars=True))
def union_all_q(spark, sf):
    cut, shipped = F.lit("2000-01-01").cast("timestamp_ntz"), F.col("l_shipdate")  # pushed to each scan
    parts = [td.bars(spark, sf, where) for where in (shipped < cut, shipped >= cut, shipped.isNull())]
    return union_all(parts, schema=BAR, spark=spark)


# ---------------- partitioning hints ----------------

@register("repartition_n", v("SELECT * FROM bars_v", bars=True))
def repartition_n(spark, sf):
    return spread(td.bars(spark, sf), 16)


@register("repartition_by_key", v("""
SELECT ticker, count(*) AS n_bars, CAST(sum(v) AS BIGINT) AS volume FROM bars_v GROUP BY ticker""", bars=True))
def repartition_by_key(spark, sf):
    return by_key(td.bars(spark, sf), "ticker").groupBy("ticker").agg(
        F.count(F.lit(1)).alias("n_bars"), F.sum("v").alias("volume"))


@register("cache_two_branches", v("""
SELECT c.underlying_ticker, count(*) AS n_bars, count(DISTINCT c.ticker) AS n_contracts
FROM contracts_v c JOIN bars_v b ON b.ticker = c.ticker GROUP BY c.underlying_ticker""",
                                  contracts=True, bars=True))
def cache_two_branches(spark, sf):
    shared = reuse(J.contract_bars(td.contracts(spark, sf).select("underlying_ticker", "ticker"),
                                   td.bars(spark, sf).select("ticker", "t")))
    flat = shared.groupBy("underlying_ticker").agg(F.count(F.lit(1)).alias("n_bars"))
    nested = shared.select("underlying_ticker", "ticker").distinct().groupBy("underlying_ticker") \
        .agg(F.count(F.lit(1)).alias("n_contracts"))
    try:
        return land(flat.join(nested, "underlying_ticker"), "two-branches")
    finally:
        shared.unpersist()


# ---------------- re-aimed fetches ----------------

@register("prev_close", v(f"""
SELECT ticker, t, n, c, o, h, l, v, vw FROM bars_v
WHERE t < epoch_us(TIMESTAMP '{CLOSE_AS_OF}') // 1000
QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY t DESC, n DESC, c DESC, o DESC, h DESC, l DESC,
  v DESC, vw DESC) = 1""", bars=True))
def prev_close(spark, sf):
    shipped_before = F.col("l_shipdate") < F.lit(CLOSE_AS_OF).cast("timestamp_ntz")  # pushed to the scan
    return R.previous_close(td.bars(spark, sf, shipped_before), CLOSE_AS_OF, tiebreak=TIEBREAK)


@register("distinct_tickers", v("SELECT DISTINCT underlying_ticker FROM contracts_v", contracts=True))
def distinct_tickers(spark, sf):
    return R.distinct_values(td.contracts(spark, sf), "underlying_ticker")


@register("join_universe_contracts", v(f"""
SELECT c.* FROM contracts_v c WHERE c.underlying_ticker IN (SELECT underlying_ticker FROM universe_v)""",
                                       universe=True, contracts=True))
def join_universe_contracts(spark, sf):
    return J.universe_contracts(td.universe(spark, sf), td.contracts(spark, sf))


@register("join_contract_bars", v(f"""
SELECT c.underlying_ticker, c.contract_type, c.expiration_date, c.strike_price, b.*
FROM contracts_v c JOIN bars_v b ON b.ticker = c.ticker""", contracts=True, bars=True))
def join_contract_bars(spark, sf):
    c = td.contracts(spark, sf).select("ticker", "underlying_ticker", "contract_type", "expiration_date",
                                       "strike_price")
    return J.contract_bars(c, td.bars(spark, sf))


@register("join_contract_documents", v(f"""
SELECT c.underlying_ticker, c.ticker, c.contract_type, c.expiration_date, c.strike_price,
  s.part, CAST(coalesce(s.n, 0) AS INTEGER) AS n_aggs, s.first_ts, s.last_ts, s.first_id
FROM contracts_v c LEFT JOIN (
  SELECT ticker, CAST(date_part('year', make_timestamp(t * 1000)) AS INTEGER) AS part, count(*) AS n,
    min(t) AS first_ts, max(t) AS last_ts, sha256(ticker || '|' || CAST(min(t) AS VARCHAR) || '|1|day') AS first_id
  FROM bars_v GROUP BY 1, 2) s ON s.ticker = c.ticker""", contracts=True, bars=True))
def join_contract_documents(spark, sf):
    docs = J.contract_documents(td.contracts(spark, sf), td.bars(spark, sf))
    last = F.get("aggs", F.size("aggs") - 1)
    return docs.select("underlying_ticker", "ticker", "contract_type", "expiration_date", "strike_price", "part",
                       F.size("aggs").alias("n_aggs"), F.get("aggs", 0)["timestamp"].alias("first_ts"),
                       last["timestamp"].alias("last_ts"), F.get("aggs", 0)["agg_id"].alias("first_id"))


@register("anti_join_not_loaded", v(f"""
SELECT {NARROW} FROM contracts_v c WHERE NOT EXISTS (SELECT 1 FROM bars_v b WHERE b.ticker = c.ticker)""",
                                    contracts=True, bars=True))
def anti_join_not_loaded(spark, sf):
    return P.contract_columns(J.not_yet_loaded(td.contracts(spark, sf), td.bars(spark, sf)))


_STORED_BEFORE = "2000-01-01"
_BATCH_FROM = "1999-07-01"
_RESENT = ("1999-07-01", "1999-09-30")


@register("dedup_append", v(f"""
, batch AS (
  SELECT * FROM bars_v WHERE t >= epoch_us(TIMESTAMP '{_BATCH_FROM}') // 1000
  UNION ALL
  SELECT * FROM bars_v WHERE CAST(make_timestamp(t * 1000) AS DATE) BETWEEN DATE '{_RESENT[0]}' AND DATE '{_RESENT[1]}')
SELECT * FROM batch EXCEPT SELECT * FROM bars_v WHERE t < epoch_us(TIMESTAMP '{_STORED_BEFORE}') // 1000""",
                            bars=True))
def dedup_append(spark, sf):
    shipped = F.col("l_shipdate")  # conditions on the stored time are pushed to the scans
    at = lambda day: F.lit(day).cast("timestamp_ntz")
    stored = td.bars(spark, sf, shipped < at(_STORED_BEFORE))
    stored = W.bars_since(stored, _BATCH_FROM)  # no older row can have an id of the batch
    batch = td.bars(spark, sf, shipped >= at(_BATCH_FROM)).unionByName(
        td.bars(spark, sf, TF.in_day_range("l_shipdate", *_RESENT)))
    ids = H.row_id(batch.schema, batch.columns)
    return J.idempotent_append(batch.withColumn("row_id", ids), stored.select(ids.alias("row_id"))).drop("row_id")


@register("batch_assign", v(f"""
SELECT *, (row_number() OVER (ORDER BY ticker, {BAR_ORDER_SQL}) - 1) // 2500 AS batch_id FROM bars_v""",
                            bars=True))
def batch_assign(spark, sf):
    return assign_batches(td.bars(spark, sf), ["ticker", "t", *TIEBREAK], 2500)


@register("load_audit", v("""
SELECT c.underlying_ticker, count(*) AS n_contracts, count(b.n) AS n_with_bars,
  count(*) - count(b.n) AS n_empty, CAST(coalesce(sum(b.n), 0) AS BIGINT) AS n_bars
FROM contracts_v c LEFT JOIN (SELECT ticker, count(*) AS n FROM bars_v GROUP BY ticker) b ON b.ticker = c.ticker
GROUP BY c.underlying_ticker""", contracts=True, bars=True))
def load_audit(spark, sf):
    return Q.load_audit(td.contracts(spark, sf), td.bars(spark, sf))
