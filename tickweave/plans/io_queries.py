"""Source and sink queries (S1-S6, K3-K6): write what Spark derives from the given tables into
a fresh folder under the shared checkpoint location, read it back with the source under test,
and return that read. JDBC sinks (K1, K2) are not registered: they need a database and none
may be started here (see README)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import testdata as td
from ..operators import joins as J
from ..operators import ranking as R
from ..schemas import BAR, CONTRACT, CONTRACT_DOCUMENT
from ..session import shared_dir
from ..sinks import writers as K
from ..sources import files as S
from ..sources.responses import (as_json_text, bar_response_pages, contract_response_pages,
                                 decode_bar_responses, decode_contract_responses)
from .basic_queries import CLOSE_AS_OF, TIEBREAK
from .registry import register

v = td.with_views
CONTRACT_COLS = ", ".join(CONTRACT.fieldNames())
LOAD_DATE = "2024-09-19"
LANDING_FILE_ROWS = 250_000


@register("src_csv_universe", v("SELECT underlying_ticker FROM universe_v", universe=True))
def src_csv_universe(spark, sf):
    path = shared_dir(spark, "universe_csv")
    (td.table(spark, sf, "customer")
     .select(F.col("c_custkey").cast("string").alias("Symbol"), F.col("c_name").alias("Name"),
             F.col("c_mktsegment").alias("Sector"))
     .write.option("header", True).csv(path))
    return S.read_universe_csv(spark, path, "Symbol")


def _land_contracts_nested(spark, sf):
    """Contracts landed in nested folders: a load date, and in it a fixed number of buckets."""
    path = shared_dir(spark, "contracts_nested")
    K.write_parquet_bucketed(td.contracts(spark, sf), f"{path}/load_date={LOAD_DATE}", "underlying_ticker", 16)
    return path


@register("src_parquet_recursive_schema", v(f"SELECT {CONTRACT_COLS} FROM contracts_v", contracts=True))
def src_parquet_recursive_schema(spark, sf):
    return S.read_landed_parquet(spark, _land_contracts_nested(spark, sf), CONTRACT)


@register("src_parquet_recursive", v(f"SELECT {CONTRACT_COLS} FROM contracts_v", contracts=True))
def src_parquet_recursive(spark, sf):
    return S.read_landed_parquet(spark, _land_contracts_nested(spark, sf)).select(*CONTRACT.fieldNames())


# fixed values: contract kind per order-priority code, the small inline lookup of S4
PRIORITY_KIND = [
    ("1-URGENT", "call"),
    ("2-HIGH", "put"),
    ("3-MEDIUM", "call"),
    ("4-NOT SPECIFIED", "put"),
    ("5-LOW", "call"),
]


@register("src_inline_rows", v("""
SELECT c.ticker, c.contract_type, k.kind FROM contracts_v c JOIN (VALUES
  ('1-URGENT', 'call'), ('2-HIGH', 'put'), ('3-MEDIUM', 'call'), ('4-NOT SPECIFIED', 'put'), ('5-LOW', 'call'))
  AS k(contract_type, kind) ON k.contract_type = c.contract_type""", contracts=True))
def src_inline_rows(spark, sf):
    kinds = S.inline_table(spark, PRIORITY_KIND, "contract_type string, kind string")
    # an inline list has a fixed, known size: safe to broadcast
    return td.contracts(spark, sf).select("ticker", "contract_type").join(F.broadcast(kinds), "contract_type")


@register("json_contracts", v(f"SELECT {CONTRACT_COLS} FROM contracts_v", contracts=True))
def json_contracts(spark, sf):
    texts = as_json_text(contract_response_pages(td.contracts(spark, sf)), drop=["underlying_ticker", "page"])
    return decode_contract_responses(texts)


@register("json_bars", v("SELECT * FROM bars_v", bars=True))
def json_bars(spark, sf):
    return decode_bar_responses(as_json_text(bar_response_pages(td.bars(spark, sf))))


@register("sink_documents", v("""
SELECT c.ticker, b.t AS timestamp,
  CASE WHEN b.t IS NOT NULL THEN sha256(c.ticker || '|' || CAST(b.t AS VARCHAR) || '|1|day') END AS agg_id
FROM contracts_v c LEFT JOIN bars_v b ON b.ticker = c.ticker""", contracts=True, bars=True))
def sink_documents(spark, sf):
    path = shared_dir(spark, "documents")
    docs = J.contract_documents(td.contracts(spark, sf), td.bars(spark, sf))
    K.write_documents(docs, path, fmt="json", mode="append",
                      options={"compression": "gzip", "maxRecordsPerFile": "500000"})
    schema = T.StructType(CONTRACT_DOCUMENT.fields + [T.StructField("part", T.IntegerType())])
    back = spark.read.schema(schema).json(path)
    return back.select("ticker", F.explode_outer("aggs").alias("a")).select(
        "ticker", F.col("a.timestamp").alias("timestamp"), F.col("a.agg_id").alias("agg_id"))


@register("sink_parquet_by_underlying", v(f"SELECT {CONTRACT_COLS} FROM contracts_v", contracts=True))
def sink_parquet_by_underlying(spark, sf):
    path = shared_dir(spark, "contracts_by_underlying")
    K.write_parquet_bucketed(td.contracts(spark, sf), path, "underlying_ticker", 16)
    return spark.read.schema(CONTRACT).parquet(path).select(*CONTRACT.fieldNames())


@register("sink_parquet_by_batch", v("SELECT * FROM bars_v", bars=True))
def sink_parquet_by_batch(spark, sf):
    path = shared_dir(spark, "bars_by_batch")
    rows = td.bars(spark, sf).withColumn("load_date", F.lit(LOAD_DATE).cast("date"))
    for _ in range(2):  # a re-run rewrites the same partition: nothing is appended twice
        K.write_parquet_partitioned(rows, path, ["load_date"], dynamic_overwrite=True,
                                    max_records_per_file=LANDING_FILE_ROWS)
    back = spark.read.parquet(path).where(F.col("load_date") == F.lit(LOAD_DATE).cast("date"))
    return back.select(*BAR.fieldNames())


@register("sink_csv_daily", v(f"""
SELECT ticker, t, n, c, o, h, l, v, vw FROM bars_v
WHERE t < epoch_us(TIMESTAMP '{CLOSE_AS_OF}') // 1000
QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY t DESC, n DESC, c DESC, o DESC, h DESC, l DESC,
  v DESC, vw DESC) = 1""", bars=True))
def sink_csv_daily(spark, sf):
    root = shared_dir(spark, "daily_closes")
    shipped_before = F.col("l_shipdate") < F.lit(CLOSE_AS_OF).cast("timestamp_ntz")  # pushed to the scan
    closes = R.previous_close(td.bars(spark, sf, shipped_before), CLOSE_AS_OF, tiebreak=TIEBREAK)
    folder = K.write_daily_csv(closes, root, CLOSE_AS_OF)
    schema = "ticker string, t bigint, n int, c double, o double, h double, l double, v bigint, vw double"
    return spark.read.schema(schema).option("header", True).csv(folder)


