"""The registered queries op1 .. op13: each applies its operator with production parameters to
its whole table and derives the digest columns of its result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import quality as quality_rules
from . import (bpe, conversations, e8_lattice, html_extract, packing, sharding, simhash, spelling,
               substring_dedup, suffix_dedup, token_files, url_filters)
from .common import table

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}

SHARDS = 8
# (host, path prefix, verdict)
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"),
             ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


WINDOW = 1024
END_OF_DOCUMENT = 0


@query
def op1_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return packing.pack(docs, WINDOW, end_id=END_OF_DOCUMENT).drop("source")


@query
def op2_hash_tree_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents").select("doc_id", "text"), SHARDS)


@query
def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, url_filters.RULE_SCHEMA)
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filters.judge(pages, rules).select("page_id", "host", "path", "rule", "verdict")


ORACLE_SQL["op3_url_filters"] = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0
                       THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), parts AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
), rules(rule_host, rule_path, rule_verdict) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
         ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), fits AS (
  SELECT p.*, r.rule_host || r.rule_path AS rule, r.rule_verdict,
         row_number() OVER (PARTITION BY p.page_id
                            ORDER BY length(r.rule_host || r.rule_path) DESC NULLS LAST) AS place
  FROM parts p LEFT JOIN rules r
    ON (p.host = r.rule_host OR ends_with(p.host, '.' || r.rule_host))
   AND starts_with(p.path, r.rule_path)
)
SELECT page_id, host, path, rule, coalesce(rule_verdict, 'allow') AS verdict
FROM fits WHERE place = 1
"""


@query
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality_rules.quality(docs, keep=["doc_id"])
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", "base_failed", "kept", "posterior")


END_ID = 2


@query
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_files.read_token_files(token_files.write_token_files(docs, END_ID))


@query
def op8_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = bpe.encode(docs, decoded=True)
    return both.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op9_template_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_extract.extract(pages)


SHINGLE = 3
MAX_DISTANCE = 3


@query
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs, SHINGLE, MAX_DISTANCE)


LINK_COSINE = 0.9


@query
def op10_e8_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return e8_lattice.near_duplicates(vectors, LINK_COSINE)


@query
def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.remove_repeats(docs).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return conversations.audit(turns, conversations.damage(turns))


@query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return spelling.variants(docs).select("word", "form", "root", "n", "n_near", "form_n")


@query
def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.remove_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
