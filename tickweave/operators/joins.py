"""Dependent fetches re-aimed as joins.

No join here hints a strategy: the planner takes a broadcast from measured sizes under the
session's threshold, and sort-merge with AQE splitting skewed partitions (a hot ticker on the
big side) beyond it. Nothing but `segmented_documents` runs a job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import bar_id
from ..functions.timefns import utc_ntz_from_millis
from .ranking import ordinal_within


def skew_safe_left_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Same rows as `left.join(right, key, "left")`, built as inner join + anti join.

    In an outer join AQE may only split the preserved (left) side; when the other side holds a
    hot key (a ticker with very many rows) that key would sit in one task. An inner join can be
    split on either side; left rows without a match come from the anti join with nulls.
    """
    matched = left.join(right, key, "inner")
    extra = [c for c in right.columns if c != key]
    unmatched = left.join(right.select(key).distinct(), key, "left_anti").select(
        "*", *[F.lit(None).cast(right.schema[c].dataType).alias(c) for c in extra])
    return matched.unionByName(unmatched)


def universe_contracts(universe: DataFrame, contracts: DataFrame) -> DataFrame:
    """Contracts of each listed underlying (symbols with none disappear, like explode).

    A symbol listed twice must not double its contracts, so the universe is de-duplicated.
    """
    symbols = universe.select("underlying_ticker").where(F.col("underlying_ticker").isNotNull()).distinct()
    return contracts.join(symbols, "underlying_ticker", "inner")


def contract_bars(contracts: DataFrame, bars: DataFrame) -> DataFrame:
    """One row per (contract, bar), flat; contracts without bars drop out."""
    return contracts.join(bars, "ticker", "inner")


def document_part(timespan: str) -> Column:
    """The calendar period (UTC, of `t`) that one document holds: a day (yyyymmdd) of minute bars, a month
    (yyyymm) of hour bars, else a year."""
    at = utc_ntz_from_millis("t")
    if timespan not in ("minute", "hour"):
        return F.year(at)
    month = F.year(at) * 100 + F.month(at)
    return month * 100 + F.day(at) if timespan == "minute" else month


def contract_documents(contracts: DataFrame, bars: DataFrame, multiplier: int = 1, timespan: str = "day",
                       tiebreak: list[str] = ("n", "c", "o", "h", "l", "v", "vw")) -> DataFrame:
    """Nested documents, contract fields + `aggs: array<struct<timestamp, agg_id>>` in time order.

    A contract has a document per calendar `part` of its bars, whose length follows the bars'
    timespan, so a document's size depends on the data's time and not on its volume, and a long
    history is many groups. Contracts with no bars keep one document with an empty array and a null
    part. Where one ticker may repeat its times without bound, see `segmented_documents`.

    An element follows from ticker and time, so only the times move: ids are made after the join, and
    bars of one time give equal elements in whichever order `tiebreak` would put them.
    """
    docs = (bars.select("ticker", document_part(timespan).alias("part"), F.struct("t").alias("_e"))
            .groupBy("ticker", "part").agg(F.array_sort(F.collect_list("_e")).alias("_es")))
    return _with_documents(contracts, docs, ["part"], multiplier, timespan)


def segmented_documents(contracts: DataFrame, bars: DataFrame, multiplier: int = 1, timespan: str = "day",
                        tiebreak: list[str] = ("n", "c", "o", "h", "l", "v", "vw"), rows: int = 10_000) -> DataFrame:
    """J3 for parts of any size: documents of at most `rows` elements, `segment` 0, 1, .. of a part, each a
    contiguous stretch of it in time order. The numbering is `ordinal_within`'s: ranges cut a hot part
    across tasks, so no group holds more than `rows` bars. Writes the numbered bars when called."""
    keyed = bars.withColumn("part", document_part(timespan))
    numbered = ordinal_within(keyed.select("ticker", "part", "t", *tiebreak), ["ticker", "part"],
                              ["t", *tiebreak], "_n")
    docs = numbered.select("ticker", "part", F.floor(F.col("_n") / rows).cast("int").alias("segment"),
                           F.struct("_n", "t").alias("_e")) \
        .groupBy("ticker", "part", "segment").agg(F.array_sort(F.collect_list("_e")).alias("_es"))
    return _with_documents(contracts, docs, ["part", "segment"], multiplier, timespan)


def _with_documents(contracts: DataFrame, docs: DataFrame, place: list[str], multiplier: int,
                    timespan: str) -> DataFrame:
    """Contracts with their documents (ticker, `place`, _es: elements in order, with their time `t`)."""
    docs = docs.select("ticker", *place, F.col("_es.t").alias("_ts"))
    fields = ["underlying_ticker", "ticker", "contract_type", "expiration_date", "strike_price"]
    # one row per document, not per bar: a join that is small beside the grouping above
    return contracts.select(*fields).join(docs, "ticker", "left").select(*fields, *place, F.transform(
        F.coalesce("_ts", F.array().cast(docs.schema["_ts"].dataType)), lambda t: F.struct(
            t.alias("timestamp"), bar_id("ticker", t, multiplier, timespan).alias("agg_id"))).alias("aggs"))


def not_yet_loaded(candidates: DataFrame, landed: DataFrame, key: str = "ticker") -> DataFrame:
    """Keys still to load = candidates with no landed row for the key (left anti join)."""
    return candidates.join(landed.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")


def idempotent_append(batch: DataFrame, stored: DataFrame, id_col: str | list[str] = "row_id",
                      buckets: int | None = None) -> DataFrame:
    """Rows of `batch` whose id is not stored yet, duplicates inside the batch removed. The id is a
    column, or several together.

    Appending the result and running again with the same batch appends nothing. Rows without
    an id cannot be told apart, so none is appended here: see `without_id`. With `buckets`, the number
    that `stored` is bucketed in by id, or its first column (`sinks.runs.Run.stored_ids`), the batch is
    dealt like it and only the batch moves.
    """
    ids = [id_col] if isinstance(id_col, str) else id_col
    known = batch
    for c in ids:
        known = known.where(F.col(c).isNotNull())
    if buckets:
        known = known.repartition(buckets, ids[0])
    known, stored = known.dropDuplicates(ids), stored.select(*ids)
    if len(ids) == 1:
        return known.join(stored, ids, "left_anti")
    same = F.col(f"_b.{ids[0]}") == F.col(f"_s.{ids[0]}")
    for c in ids[1:]:  # no equality: Spark would deal both sides by all columns anew
        same = same & F.col(f"_b.{c}").between(F.col(f"_s.{c}"), F.col(f"_s.{c}"))
    return known.alias("_b").join(stored.alias("_s"), same, "left_anti")


def without_id(batch: DataFrame, id_col: str = "row_id") -> DataFrame:
    """The rows of a batch that J5 cannot place, as dead letters: all columns plus `reason`."""
    return batch.where(F.col(id_col).isNull()).withColumn("reason", F.lit("missing_id"))
