"""The corpus pipeline: quality rules, SimHash near-duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. All but the
last return the columns of `docs`; `run` writes every result as Parquet in the shared folder and
gives it, read again, to the next stage. What a stage does with nulls, empty texts, repeated rows
and empty tables is what its operator does; columns of `docs` other than doc_id and text may have
any names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickweave.llm import packing, quality, simhash, suffix_dedup
from tickweave.llm.common import land, table
from tickweave.llm.queries import END_OF_DOCUMENT, MAX_DISTANCE, SHINGLE, WINDOW

ORACLE_SQL = None  # expectation-maximisation, components and token ids are beyond SQL


def _aside(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """doc_id, text and the other columns under names no operator uses, and their own names."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    names = {f"_carried_{i}": c for i, c in enumerate(rest)}
    return docs.select("doc_id", "text", *[F.col(f"`{c}`").alias(n) for n, c in names.items()]), names


def _back(rows: DataFrame, names: dict[str, str], columns: list[str]) -> DataFrame:
    own = {c: n for n, c in names.items()}
    return rows.select(*[F.col(own.get(c, c)).alias(c) for c in columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the base rules and the weakly supervised rules keep."""
    rows, names = _aside(docs)
    return _back(quality.quality(rows).where("kept"), names, docs.columns)


def simhash_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, that of its smallest doc_id."""
    rows, names = _aside(docs)
    return _back(simhash.one_of_each(rows, SHINGLE, MAX_DISTANCE), names, docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that a smaller doc_id has. One of which nothing is left goes; a
    null or empty text stays as it is. A column n_chars follows a text that was cut."""
    rows, names = _aside(docs)
    rows = rows.withColumn("_null", F.col("text").isNull())
    cut = suffix_dedup.remove_repeats(rows, carry=["_null", *names], as_text=True)
    cut = cut.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_bytes"))) \
        .withColumn("text", F.when(~F.col("_null"), F.col("kept"))) \
        .withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))
    for n, c in names.items():
        if c == "n_chars":
            chars = F.length("text").cast(docs.schema[c].dataType)
            cut = cut.withColumn(n, F.when(F.col("n_removed") > 0, chars).otherwise(F.col(n)))
    return _back(cut, names, docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    return packing.pack(docs, WINDOW, end_id=END_OF_DOCUMENT)


STAGES = [("quality_rules", quality_rules), ("simhash_near_duplicates", simhash_near_duplicates),
          ("repeated_passages", repeated_passages), ("packing", pack_sequences)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = land(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
