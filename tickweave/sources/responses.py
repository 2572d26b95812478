"""Landed API responses: encode tables into response pages (for landing) and decode landed
JSON text back into rows (S5, S6), routing bad records to a dead-letter table (E1).

A body is parsed with its whole schema. One in which anything has another type is parsed again, in two
steps: its envelope, in which each element of `results` stays the JSON text it is, and then each
element on its own. So a record of a wrong type, one that is null or one whose
value does not fit is a dead letter by itself, and the others of its response are rows. Only a
body that is no JSON object, whose `results` is no array, or whose status is not a good one is a dead
letter as a whole.

Decoding is lenient on unknown keys and on envelope fields that no row needs, treats missing/null
`results` as empty, and copies the envelope `ticker` onto each bar. Every wire field of a bar is
required; volume is read as double, must be within the bigint range and integral, and is stored as
bigint; times must lie in the years 1 to 9999. No conversion of a decoded value can fail.

Rows come out of generators: they bind what is parsed and make a row of each element, and the rules
are plain columns above them (generated code). Later predicates on decoded fields (a join's inferred `ticker IS NOT NULL`, a range on `t`) refer
to generator output and stay above it. Otherwise the optimizer would push them below the projection
and run `from_json` a second time inside a filter, possibly in the scan stage. `bar_outcomes` and
`contract_outcomes` are the same rules as one array column per body, bound by lambdas.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.arrays import element_count
from ..functions.hashing import bar_id
from ..functions.timefns import utc_ntz_from_millis
from ..schemas import BAR_RESPONSE, BAR_SHORT_TO_LONG, BAR_WIRE, CONTRACT, CONTRACT_RESPONSE, CONTRACT_WIRE

CORRUPT = "_corrupt_record"
_MAX_LONG = 2.0 ** 63
MIN_TIME, MAX_TIME = -62_135_596_800_000, 253_402_300_799_999  # epoch ms of the years 1 to 9999


def _envelope(schema: T.StructType) -> T.StructType:
    """The envelope of a response: its fields as text, each element of `results` as its JSON text."""
    return T.StructType([T.StructField(f.name, T.ArrayType(T.StringType()) if f.name == "results" else T.StringType())
                         for f in schema.fields])


BAR_ENVELOPE = _envelope(BAR_RESPONSE)
# ---- fixed values: envelope statuses of an answer that holds its data ----
GOOD_STATUS = ("OK", "DELAYED")
# ---- end of fixed values ----


# ---------- encoding (tables -> response pages) ----------

def month_of(day: Column) -> Column:
    """A date as yyyymm; 0 for null."""
    return F.coalesce(F.year(day) * 100 + F.month(day), F.lit(0))


def pack_pages(df: DataFrame, key: str, page: Column, order: list[Column | str], element: Column) -> DataFrame:
    """Group rows into one page per key and calendar period, elements in `order`.

    A page's size follows from the data's time and not from its volume, so a key with a long
    history is many groups; one shuffle, no ordinal. Output: key, page, results.
    """
    cols = [F.col(o) if isinstance(o, str) else o for o in order]
    entry = F.struct(*[c.alias(f"_{i}") for i, c in enumerate(cols)], element.alias("_el"))
    pages = df.select(F.col(key), page.alias("page"), entry.alias("_e")).groupBy(key, "page") \
        .agg(F.array_sort(F.collect_list("_e")).alias("_es"))
    return pages.select(key, "page", F.transform("_es", lambda e: e["_el"]).alias("results"))


def bar_wire(v: Column | None = None) -> Column:
    """A stored bar as its wire struct (volume as a JSON number)."""
    return F.struct(*[(v if (n == "v" and v is not None) else F.col(n).cast(BAR_WIRE[n].dataType)).alias(n)
                      for n in BAR_WIRE.fieldNames()])


def bar_response_pages(bars: DataFrame, wire_v: Column | None = None,
                       tiebreak: list[str] = ("n", "c", "o", "h", "l", "v", "vw"), period: str = "year") -> DataFrame:
    """Bars -> one aggregates response per ticker and calendar `period` (UTC): "year" for day bars,
    "month" for hour bars, "day" for minute bars. As struct columns."""
    day = F.to_date(utc_ntz_from_millis("t"))
    page = {"year": F.coalesce(F.year(day), F.lit(0)), "month": month_of(day),
            "day": F.coalesce(month_of(day) * 100 + F.day(day), F.lit(0))}[period]
    pages = pack_pages(bars, "ticker", page, ["t", *tiebreak], bar_wire(wire_v))
    size = F.size("results")
    return pages.select(
        F.lit(True).alias("adjusted"), size.alias("count"), size.alias("queryCount"),
        F.concat_ws("-", "ticker", F.col("page").cast("string")).alias("request_id"),
        "results", size.alias("resultsCount"), F.lit("OK").alias("status"), "ticker")


def contract_response_pages(contracts: DataFrame) -> DataFrame:
    """Contracts -> one list response per (underlying, expiration month)."""
    wire = F.struct(*[(F.date_format(n, "yyyy-MM-dd") if n == "expiration_date" else F.col(n)).alias(n)
                      for n in CONTRACT.fieldNames()])
    pages = pack_pages(contracts, "underlying_ticker", month_of(F.col("expiration_date")), ["ticker"], wire)
    return pages.select(
        F.concat_ws("-", "underlying_ticker", F.col("page").cast("string")).alias("request_id"),
        F.lit(None).cast("string").alias("next_url"),
        F.lit("OK").alias("status"), "results", "underlying_ticker", "page")


def as_json_text(responses: DataFrame, drop: list[str] = ()) -> DataFrame:
    cols = [c for c in responses.columns if c not in drop]
    return responses.select(F.to_json(F.struct(*cols)).alias("value"))


# ---------- decoding (landed text -> rows) ----------

def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])


def _parsed(text: Column, schema: T.StructType) -> Column:
    return F.from_json(text, _with_corrupt(schema), {"columnNameOfCorruptRecord": CORRUPT, "mode": "PERMISSIVE"})


def _bound(value: Column, of) -> Column:
    """`of(value)`, with `value` evaluated once however often `of` names it."""
    return F.get(F.transform(F.array(value), of), F.lit(0))


def _unreadable(r: Column) -> Column:
    """Why a whole response is a dead letter; null for a good one."""
    return (F.when(r[CORRUPT].isNotNull(), F.lit("malformed"))
            .when(~F.coalesce(F.upper(r["status"]).isin(*GOOD_STATUS), F.lit(True)), F.lit("error_response")))


def _outcomes(text: Column, response: T.StructType, element: T.StructType, of) -> Column:
    """A struct `of(r, e, record, origin, why)` for every element of the response `text`, or one for the
    response if it is a dead letter as a whole: the envelope, the element (null there), the text and the
    origin (MD5 of the body and place in it) that a dead letter keeps, and why it is one as far as its
    JSON says. Empty for a null text."""
    envelope = _envelope(response)
    whole = F.lit(None).cast(element)

    def origin(i: Column) -> Column:
        return F.concat_ws(":", F.md5(text), i)

    def plain(r: Column) -> Column:
        why = _unreadable(r)
        return F.transform(F.when(why.isNotNull(), F.array(whole)).otherwise(r["results"]), lambda e, i: of(
            r, e, F.when(why.isNotNull(), text).otherwise(F.to_json(e)), origin(i),
            F.coalesce(why, F.when(e.isNull(), F.lit("null_record")))))

    def by_element(r: Column) -> Column:
        why = _unreadable(r)
        items = F.when(why.isNotNull(), F.array(F.lit(None).cast("string"))).otherwise(r["results"])
        return F.transform(items, lambda item, i: _bound(_parsed(item, element), lambda e: of(
            r, e, F.when(why.isNotNull(), text).otherwise(item), origin(i),
            F.coalesce(why, F.when(item.isNull(), F.lit("null_record")), F.when(e[CORRUPT].isNotNull(), F.lit("malformed"))))))

    return _bound(_parsed(text, response), lambda r: F.when(r[CORRUPT].isNull(), plain(r))
                  .otherwise(_bound(_parsed(text, envelope), by_element)))


def _outcome_rows(texts: DataFrame, col: str, request_key: str | None, response: T.StructType,
                  element: T.StructType, of) -> DataFrame:
    """What `_outcomes` gives, as rows; `of` returns the columns."""
    asked = F.col(request_key) if request_key else F.lit(None).cast("string")
    envelope = _envelope(response)
    bodies = texts.select(asked.alias("_asked"), F.inline(F.array(F.struct(F.col(col).alias("_text"))))) \
        .select("*", F.inline(F.array(F.struct(F.md5("_text").alias("_body"), _parsed(F.col("_text"), response).alias("_t")))))
    odd = F.col(f"_t.{CORRUPT}").isNotNull()
    bodies = bodies.select("*", F.inline(F.array(F.struct(_parsed(F.when(odd, F.col("_text")), envelope).alias("_o")))))
    names = [n for n in ("status", "ticker") if n in envelope.fieldNames()]
    r = F.struct(*[F.when(odd, F.col(f"_o.{n}")).otherwise(F.col(f"_t.{n}")).alias(n) for n in names],
                 F.col(f"_o.{CORRUPT}").alias(CORRUPT))
    bodies = bodies.withColumns({"_r": r, "_why": _unreadable(r), "_odd": odd})
    why, odd = F.col("_why"), F.col("_odd")
    none, text = F.lit(None).cast(element).alias("e"), F.lit(None).cast("string").alias("item")
    items = F.when(why.isNotNull(), F.array(F.struct(text, none))) \
        .when(odd, F.transform("_o.results", lambda item: F.struct(item.alias("item"), none))) \
        .otherwise(F.transform("_t.results", lambda e: F.struct(text, e.alias("e"))))
    elements = bodies.select("_asked", "_body", "_r", "_why", F.when(why.isNotNull(), F.col("_text")).alias("_raw"),
                             F.posexplode(items).alias("_i", "_x"))
    parsed = elements.select("*", F.inline(F.array(F.struct(_parsed(F.col("_x.item"), element).alias("_p")))))
    item, e = F.col("_x.item"), F.col("_x.e")
    why = F.coalesce(F.col("_why"), F.when(item.isNull() & e.isNull(), F.lit("null_record")),
                     F.when(F.col(f"_p.{CORRUPT}").isNotNull(), F.lit("malformed")))
    both = F.struct(*[F.coalesce(e[n], F.col("_p")[n]).alias(n) for n in element.fieldNames()])
    return parsed.select(*of(F.col("_r"), both, F.coalesce("_raw", item, F.to_json(e)), F.concat_ws(":", "_body", "_i"),
                             why, F.col("_asked")))


def _text(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _bad_date(text: Column) -> Column:
    return text.isNotNull() & F.try_to_date(text, "yyyy-MM-dd").isNull()


def _contract_outcome(r: Column, c: Column, record: Column, origin: Column, why: Column, asked: Column) -> list[Column]:
    reason = F.coalesce(F.when(why == "null_record", F.lit("null_contract")).otherwise(why),
                        F.when(_bad_date(c["expiration_date"]), F.lit("bad_date")))
    fields = {n: c[n] for n in CONTRACT.fieldNames()}
    fields["expiration_date"] = F.try_to_date(c["expiration_date"], "yyyy-MM-dd")
    fields["underlying_ticker"] = F.coalesce(c["underlying_ticker"], F.when(reason.isNotNull(), asked))
    return [reason.alias("reason"), F.when(reason.isNotNull(), record).alias("record"), origin.alias("origin"),
            *[v.alias(n) for n, v in fields.items()]]


def contract_outcomes(col, request_key: str | None = None) -> Column:
    """Response text -> array<struct<reason, record, origin, contract fields>>, an entry for each contract of
    the list (`reason` null, or `null_contract`, `malformed` for a wrong type, `bad_date`) or one for an
    unreadable or error response (`malformed`, `error_response`). `origin` is the body's MD5 and the place
    in it. Dead letters keep their JSON in `record` and are of the underlying they name, else of the one
    that the list was requested for (`request_key`)."""
    asked = F.col(request_key) if request_key else F.lit(None).cast("string")
    return _outcomes(_text(col), CONTRACT_RESPONSE, CONTRACT_WIRE, lambda *a: F.struct(*_contract_outcome(*a, asked)))


def classify_contract_responses(texts: DataFrame, col: str = "value", request_key: str | None = None,
                                keep_request: str | None = None) -> DataFrame:
    """E1 for contract lists, one parse: what `contract_outcomes` gives, as rows, with the request's key
    in a column `keep_request` if one is named. A contract without a ticker or an underlying is decoded
    (all its fields are optional); `filters.tag_missing` tells where a flow drops it."""
    def of(*a):
        return [*_contract_outcome(*a), *([a[-1].alias(keep_request)] if keep_request else [])]
    return _outcome_rows(texts, col, request_key, CONTRACT_RESPONSE, CONTRACT_WIRE, of)


def decode_contract_responses(texts: DataFrame, col: str = "value") -> DataFrame:
    """Contract-list responses -> contract rows (expiration parsed to date); see
    `classify_contract_responses` for the rest."""
    return classify_contract_responses(texts, col).where(F.col("reason").isNull()).select(*CONTRACT.fieldNames())


def _bar_problem(b: Column) -> Column:
    """Why a bar is a dead letter; null for a good one. Ranges are tested before fractions, since no
    fraction is left in a double beyond the bigint range."""
    v, prices = b["v"], [b[n] for n in ("c", "h", "l", "o", "vw")]
    missing, infinite = F.lit(False), F.lit(False)
    for n in BAR_WIRE.fieldNames():
        missing = missing | b[n].isNull()
    for x in prices:
        infinite = infinite | F.isnan(x) | (F.abs(x) == float("inf"))
    return (F.when(missing, F.lit("missing_field"))
            .when(infinite, F.lit("price_not_finite"))
            .when(~b["t"].between(MIN_TIME, MAX_TIME), F.lit("time_out_of_range"))
            .when(F.isnan(v) | (F.abs(v) >= F.lit(_MAX_LONG)), F.lit("volume_out_of_range"))
            .when(v != F.floor(v), F.lit("fractional_volume")))


def _bar_outcome(r: Column, b: Column, record: Column, origin: Column, why: Column, asked: Column) -> list[Column]:
    ticker = F.coalesce(r["ticker"], asked)
    reason = F.coalesce(F.when(why == "null_record", F.lit("null_bar")).otherwise(why), _bar_problem(b),
                        F.when(ticker.isNull(), F.lit("missing_ticker")))
    bad = reason.isNotNull()
    return [ticker.alias("ticker"), reason.alias("reason"), F.when(bad, record).alias("record"),
            F.when(bad, origin).alias("origin"),
            *[(b["v"].try_cast("bigint") if n == "v" else b[n]).alias(n) for n in BAR_WIRE.fieldNames()]]


def bar_outcomes(col, request_key: str | None = None) -> Column:
    """Response text -> array<struct<ticker, reason, record, origin, c, h, l, n, o, t, v, vw>>, an entry for each
    bar or one for an unreadable or error response. `reason` is null for a good bar; dead letters keep
    the JSON of what is wrong: the body (`malformed`, `error_response`) or the bar (`malformed` for a
    wrong type or an integer that does not fit, `null_bar`, or the rule it breaks), and `origin` tells
    equal ones of a body, or of two bodies, apart.

    An unparsable body has no readable envelope, so its ticker is unknown unless the landing kept the
    request key next to it: pass that column as `request_key` and it is used whenever the envelope
    ticker is missing. A bar without either is a dead letter too.
    """
    asked = F.col(request_key) if request_key else F.lit(None).cast("string")
    return _outcomes(_text(col), BAR_RESPONSE, BAR_WIRE, lambda *a: F.struct(*_bar_outcome(*a, asked)))


def classify_bar_responses(texts: DataFrame, col: str = "value", request_key: str | None = None) -> DataFrame:
    """E1 in one pass: what `bar_outcomes` gives, as rows."""
    return _outcome_rows(texts, col, request_key, BAR_RESPONSE, BAR_WIRE, _bar_outcome)


def _good(outcomes: Column) -> Column:
    return F.filter(F.coalesce(outcomes, F.array()), lambda o: o["reason"].isNull())


def bars_of(col, request_key: str | None = None) -> Column:
    """D-U2 as a column: response text -> array<struct<bar>> of its good bars by the rules above, with
    long names and agg_id; empty for a response without any. `rejects_of(bar_outcomes(..))` has the rest."""
    return F.transform(_good(bar_outcomes(col, request_key)), lambda b: F.struct(
        *[b[s].alias(name) for s, name in BAR_SHORT_TO_LONG.items()], bar_id(b["ticker"], b["t"]).alias("agg_id")))


def contracts_of(col) -> Column:
    """D-U1 as a column: response text -> array<struct<contract>> of its good contracts (expiration as
    text); empty for a response without any. `rejects_of(contract_outcomes(..))` has the rest."""
    fields = ["ticker", "underlying_ticker", "contract_type", "exercise_style", "expiration_date", "strike_price"]
    return F.transform(_good(contract_outcomes(col)), lambda c: F.struct(
        *[(F.date_format(c[n], "yyyy-MM-dd") if n == "expiration_date" else c[n]).alias(n) for n in fields]))


def rejects_of(outcomes: Column) -> Column:
    """Outcomes -> array<struct<reason, record>> of what the D-U columns leave out."""
    bad = F.filter(F.coalesce(outcomes, F.array()), lambda o: o["reason"].isNotNull())
    return F.transform(bad, lambda o: F.struct(o["reason"].alias("reason"), o["record"].alias("record")))


def decode_envelopes(texts: DataFrame, col: str = "value") -> DataFrame:
    """The readable envelopes of bar responses: status, ticker, resultsCount (null unless an integer),
    results (JSON texts)."""
    rows = texts.select(F.inline(F.transform(F.array(_parsed(F.col(col), BAR_ENVELOPE)), lambda r: F.struct(
        (r[CORRUPT].isNull() & F.col(col).isNotNull()).alias("readable"), r["status"].alias("status"), r["ticker"].alias("ticker"),
        r["resultsCount"].try_cast("int").alias("resultsCount"), r["results"].alias("results")))))
    return rows.where("readable").drop("readable")


def split_bar_responses(texts: DataFrame, col: str = "value",
                        request_key: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """E1 + S6: landed bar-response texts -> (good bars, dead letters, readable envelopes).

    Good bars carry the envelope ticker and bigint volume; dead letters are `ticker, reason, record`.
    Each output is lazy; when both good and bad rows are written, persist `classify_bar_responses` once
    (as the streaming landing does) so the texts are parsed a single time.
    """
    classified = classify_bar_responses(texts, col, request_key)
    good = classified.where(F.col("reason").isNull()).select("ticker", *BAR_WIRE.fieldNames())
    bad = classified.where(F.col("reason").isNotNull()).select("ticker", "reason", "record")
    return good, bad, decode_envelopes(texts, col)


def decode_bar_responses(texts: DataFrame, col: str = "value") -> DataFrame:
    """Good bars only (see `split_bar_responses` for the dead letters)."""
    return split_bar_responses(texts, col)[0]


def envelope_counts(envelopes: DataFrame) -> DataFrame:
    """Declared vs actual results per response (input for the A5 report)."""
    return envelopes.select("ticker", "status", "resultsCount", element_count("results").alias("n_results"))
