"""Driver contract + every registered query against its DuckDB oracle on sf0.001."""

import hashlib
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMOKE
from tickweave.plans import registry

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
ROWS_ONLY = set()
registry.load_all()


def _digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):
        if isinstance(v, float) and not math.isnan(v):
            return repr(round(v, 6))
        return repr(v)
    return hashlib.sha256("\n".join(sorted("|".join(norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMOKE}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["ticker", "c", "h", "l", "n", "o", "t", "v", "vw"]
    assert df.count() > 0


def test_every_query_has_an_oracle_or_is_listed():
    q, o = registry.QUERIES, registry.ORACLE_SQL
    assert set(q) - set(o) == ROWS_ONLY
    assert set(o) <= set(q)
    assert set(q) <= set(entry.queries()) and set(o) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = registry.QUERIES[name](spark, SF_SMOKE)
    rows = [tuple(r) for r in df.collect()]
    if name in ROWS_ONLY:
        assert len(rows) > 0
        return
    res = duck.execute(registry.ORACLE_SQL[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _digest(rows, df.columns) == _digest(orows, ocols)
