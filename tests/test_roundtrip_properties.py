"""Properties from the survey's test strategy: decode(encode(x)) == x for bar and contract
pages."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tickweave.schemas import BAR, CONTRACT
from tickweave.sources.responses import (as_json_text, bar_response_pages, contract_response_pages,
                                         decode_bar_responses, decode_contract_responses)

price = st.floats(min_value=0.01, max_value=1e6, allow_nan=False, allow_infinity=False)
bar_row = st.tuples(st.sampled_from(["O:A", "O:B", "O:C"]), price, price, price, st.integers(0, 10_000), price,
                    st.integers(0, 2_000_000_000_000), st.integers(0, 5_000_000_000), price)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(bar_row, min_size=0, max_size=40, unique_by=lambda r: (r[0], r[6])))
def test_bar_pages_round_trip(spark, rows):
    bars = spark.createDataFrame(rows, BAR)
    back = decode_bar_responses(as_json_text(bar_response_pages(bars)))
    assert sorted(tuple(r) for r in back.collect()) == sorted(rows)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(n=st.integers(0, 30))
def test_contract_pages_round_trip(spark, n):
    rows = [(None, "call" if i % 2 else "put", None, "american", dt.date(2024, 9, 20) + dt.timedelta(days=i),
             None, 100.0, 5.0 + i, f"O:T{i}", "AAPL" if i % 3 else "MSFT") for i in range(n)]
    contracts = spark.createDataFrame(rows, CONTRACT)
    texts = as_json_text(contract_response_pages(contracts), drop=["underlying_ticker", "page"])
    back = decode_contract_responses(texts)
    assert sorted(tuple(r) for r in back.collect()) == sorted(rows)
