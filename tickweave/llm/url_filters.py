"""URL rules by a sort-merge range join.

A rule (host, path prefix) fits its host and all subdomains. With the host's labels reversed,
`org.example` + `/` + path is a canonical key (no host holds a `/`, so that the key of a rule without
a path is that of its host alone), and a rule covers the interval of keys that start with its own.
A url probes once for each suffix of its host. Probes and the two ends of every
interval are sorted together by ranges of the key; the sweep over a sorted run carries the
stack of rules that are open there, and a probe reads the top of the stack. Ranges go by key and then by host, since all hosts of
one domain share a key where their paths are the same, as home pages do. Runs that begin inside
an interval get the stack left open by the runs before.

Only DataFrame functions are used. Urls are reduced to distinct (host, path) before they are
exploded, so a url that repeats in a third of all rows is one probe."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.sql.window import Window

from .common import land, shuffle_partitions

RULE_SCHEMA = StructType([StructField("rule_host", StringType()),
                          StructField("rule_path", StringType()),
                          StructField("verdict", StringType())])
STACK = "array<struct<rule:string,verdict:string>>"
_LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: str = "url"):
    """Host and path columns of a url; both empty for null or a url without `://`."""
    after = F.when(F.instr(url, "://") > 0,
                   F.expr(f"substring({url}, instr({url}, '://') + 3)")).otherwise(F.lit(""))
    after = F.coalesce(after, F.lit(""))
    host = F.translate(F.regexp_extract(after, r"^([^/?#]*)", 1), *_LOWER)
    path = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def _reversed_host(labels):
    return F.concat_ws(".", F.reverse(labels))


def _key(reversed_host, path):
    return F.concat(reversed_host, F.lit("/"), path).cast("binary")


def _rule_events(rules: DataFrame) -> DataFrame:
    """Two events per rule: its start with the stack from there on, and its end with the stack
    beneath it. A rule's stack is itself and the rules of its host whose paths are prefixes of
    its own; they are found by an equality join on every prefix of the path."""
    rules = (rules.where(F.col("rule_host").isNotNull() & F.col("verdict").isNotNull())
             .withColumn("rule_path", F.coalesce("rule_path", F.lit("")))
             .withColumn("rule_host", F.translate("rule_host", *_LOWER))
             # one rule given twice with two verdicts blocks: 'block' sorts last
             .groupBy("rule_host", "rule_path").agg(F.max("verdict").alias("verdict")))
    prefixes = rules.select(
        "rule_host", F.col("rule_path").alias("of"),
        F.explode(F.sequence(F.lit(0), F.length("rule_path"))).alias("n")) \
        .withColumn("rule_path", F.expr("substring(of, 1, n)"))
    stacks = (prefixes.join(rules, ["rule_host", "rule_path"])
              .groupBy("rule_host", "of")
              .agg(F.sort_array(F.collect_list(F.struct(
                  "n", F.concat("rule_host", "rule_path").alias("rule"), "verdict"))).alias("s"))
              .withColumn("stack", F.transform(
                  "s", lambda x: F.struct(x["rule"].alias("rule"), x["verdict"].alias("verdict")))))
    start = _key(_reversed_host(F.split("rule_host", r"\.")), F.col("of"))
    opened = stacks.select(start.alias("key"), F.lit(1).alias("kind"), "stack")
    closed = stacks.select(F.concat(start, F.lit(b"\xff")).alias("key"),  # no UTF-8 byte is ff
                           F.lit(0).alias("kind"),
                           F.slice("stack", F.lit(1), F.size("stack") - 1).alias("stack"))
    return opened.union(closed)


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow",
          partitions: int | None = None) -> DataFrame:
    """`pages` with host, path, rule and verdict (columns of those names are replaced). The
    longest fitting rule decides, of two equally long the one with the longer host; without one
    the verdict is `default` and the rule null. A null url, or one without `://`, has empty host
    and path and so no rule. Repeated pages are judged alike; an empty table gives an empty
    result; no rules means `default` for all."""
    spark = pages.sparkSession
    n = partitions or 4 * shuffle_partitions(spark)
    host, path = host_and_path(url)
    pages = pages.withColumns({"host": host, "path": path})

    distinct = pages.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    probes = distinct.withColumn(
        "suffix", F.explode(F.transform(
            F.sequence(F.lit(1), F.size(labels)),
            lambda i: _reversed_host(F.slice(labels, i, F.size(labels)))))) \
        .select(_key(F.col("suffix"), F.col("path")).alias("key"), F.lit(2).alias("kind"),
                F.lit(None).cast(STACK).alias("stack"), "host", "path")
    events = _rule_events(rules).withColumns(
        {"host": F.lit(None).cast("string"), "path": F.lit(None).cast("string")})
    dealt = (probes.unionByName(events).repartitionByRange(n, "key", "kind", "host")
             .withColumn("run", F.spark_partition_id()))
    runs = land(dealt, "url-runs")  # both readings below must see the same ranges

    # the stack that is open where a run begins: that of the last event in the runs before
    last = runs.groupBy("run").agg(
        F.max_by("stack", F.when(F.col("stack").isNotNull(), F.struct("key", "kind"))).alias("left"))
    before = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)  # a row per run
    carried = last.select("run", F.last("left", ignorenulls=True).over(before).alias("carried"))

    sweep = Window.partitionBy("run").orderBy("key", "kind") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = runs.withColumn("open", F.last("stack", ignorenulls=True).over(sweep)) \
        .where(F.col("kind") == 2)
    top = F.element_at(F.coalesce("open", "carried"), -1)
    matched = (swept.join(carried, "run")
               .where(F.size(F.coalesce("open", "carried")) > 0)
               .select("host", "path", top["rule"].alias("rule"), top["verdict"].alias("verdict"))
               .groupBy("host", "path")
               .agg(F.max(F.struct(F.length("rule").alias("n"),
                                   F.length(F.substring_index("rule", "/", 1)).alias("h"),
                                   "rule", "verdict")).alias("best"))
               .select("host", "path", "best.rule", "best.verdict"))
    return (pages.drop("rule", "verdict").join(matched, ["host", "path"], "left")
            .withColumn("verdict", F.coalesce("verdict", F.lit(default)))
            .select(*[c for c in pages.columns if c not in ("rule", "verdict")], "rule", "verdict"))
