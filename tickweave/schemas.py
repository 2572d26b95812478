"""Record schemas of the options-market data model (snake_case everywhere).

`t` is epoch milliseconds UTC (bar start). Volume arrives as a JSON number that may be written
as a double; it is decoded as double, checked to be integral, and stored as bigint.
"""

from pyspark.sql import types as T

# ---- fixed values: field names of the market-data API records (must match the wire) ----
CONTRACT_FIELDS = [
    ("cfi", T.StringType()),
    ("contract_type", T.StringType()),
    ("correction", T.IntegerType()),
    ("exercise_style", T.StringType()),
    ("expiration_date", T.StringType()),
    ("primary_exchange", T.StringType()),
    ("shares_per_contract", T.DoubleType()),
    ("strike_price", T.DoubleType()),
    ("ticker", T.StringType()),
    ("underlying_ticker", T.StringType()),
]
BAR_WIRE_FIELDS = [
    ("c", T.DoubleType()),   # close
    ("h", T.DoubleType()),   # high
    ("l", T.DoubleType()),   # low
    ("n", T.IntegerType()),  # number of trades
    ("o", T.DoubleType()),   # open
    ("t", T.LongType()),     # bar start, epoch ms UTC
    ("v", T.DoubleType()),   # volume (wire: a JSON number)
    ("vw", T.DoubleType()),  # volume-weighted average price
]
# snake_case API keys -> camelCase record properties
SNAKE_TO_CAMEL = {
    "contract_type": "contractType",
    "exercise_style": "exerciseStyle",
    "expiration_date": "expirationDate",
    "primary_exchange": "primaryExchange",
    "shares_per_contract": "sharesPerContract",
    "strike_price": "strikePrice",
    "underlying_ticker": "underlyingTicker",
}
# short bar keys -> long names used by the document/SQL tables
BAR_SHORT_TO_LONG = {
    "o": "open",
    "h": "high",
    "l": "low",
    "c": "close",
    "v": "volume",
    "vw": "vwap",
    "t": "timestamp",
    "n": "transactions",
}
TIMESPANS = ["minute", "hour", "day", "week", "month", "quarter", "year"]
# ---- end of fixed values ----

CAMEL_TO_SNAKE = {v: k for k, v in SNAKE_TO_CAMEL.items()}


def _struct(fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# contract as it arrives on the wire (expiration as yyyy-MM-dd text)
CONTRACT_WIRE = _struct(CONTRACT_FIELDS)
# contract as stored (expiration parsed to a date)
CONTRACT = _struct([(n, T.DateType() if n == "expiration_date" else t) for n, t in CONTRACT_FIELDS])

CONTRACT_RESPONSE = T.StructType([
    T.StructField("request_id", T.StringType()),
    T.StructField("next_url", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("results", T.ArrayType(CONTRACT_WIRE)),
])

BAR_WIRE = _struct(BAR_WIRE_FIELDS)
BAR_RESPONSE = T.StructType([
    T.StructField("adjusted", T.BooleanType()),
    T.StructField("count", T.IntegerType()),
    T.StructField("queryCount", T.IntegerType()),
    T.StructField("request_id", T.StringType()),
    T.StructField("results", T.ArrayType(BAR_WIRE)),
    T.StructField("resultsCount", T.IntegerType()),
    T.StructField("status", T.StringType()),
    T.StructField("ticker", T.StringType()),
])

# stored bar: ticker + wire fields, volume widened to bigint
BAR = T.StructType(
    [T.StructField("ticker", T.StringType())]
    + [T.StructField(n, T.LongType() if n == "v" else t) for n, t in BAR_WIRE_FIELDS])
BAR_COLUMNS = [f.name for f in BAR.fields]

TICK = T.StructType([
    T.StructField("ticker", T.StringType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("size", T.LongType()),
    T.StructField("tick_id", T.LongType()),
])

UNIVERSE = T.StructType([T.StructField("underlying_ticker", T.StringType())])

CONTRACT_DOCUMENT = T.StructType([
    T.StructField("underlying_ticker", T.StringType()),
    T.StructField("ticker", T.StringType()),
    T.StructField("contract_type", T.StringType()),
    T.StructField("expiration_date", T.DateType()),
    T.StructField("strike_price", T.DoubleType()),
    T.StructField("aggs", T.ArrayType(T.StructType([
        T.StructField("timestamp", T.LongType()),
        T.StructField("agg_id", T.StringType()),
    ]))),
])


def ddl(schema: T.StructType) -> str:
    return schema.simpleString()[len("struct<"):-1]
