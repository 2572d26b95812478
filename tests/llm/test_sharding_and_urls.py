import zlib
from collections import Counter, defaultdict

import duckdb
from pyspark.sql import functions as F

from tests.conftest import SF_SMOKE
from tickweave.llm import queries, sharding, url_filters

DOCS = [(1, "x"), (1, "x"), (1, "y"), (2, None), (3, ""), (None, "é" * 10), (7, "z" * 100_000)]


def test_sharding_of_awkward_rows(spark):
    docs = spark.createDataFrame(DOCS, "doc_id bigint, text string").withColumn("shard", F.lit("clash")) \
        .withColumn("pid", F.lit(1))
    rows = sharding.assign_shards(docs, 8).collect()
    assert len(rows) == len(DOCS)
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert r.law == "key" and 0 <= r.shard < 8 and r.grown_shard in (r.shard, 8)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in DOCS)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    assert len({r.shard for r in rows if r.doc_id == 1}) == 1
    assert sharding.assign_shards(docs.limit(0), 8).count() == 0


def moved(spark, before, after, n=20_000):
    df = spark.range(n).select(sharding.shard_of(F.col("id"), before).alias("a"),
                               sharding.shard_of(F.col("id"), after).alias("b"))
    return df.groupBy("a", "b").count().collect()


def test_growth_moves_rows_into_the_new_shard_only(spark):
    for base, n in ((8, 8), (8, 9), (8, 12), (2, 2), (2, 5), (1, 1)):  # from the base layout on
        for r in moved(spark, sharding.Tree.of(n, base), sharding.Tree.of(n + 1, base)):
            assert r.b in (r.a, n)
    share = sum(r["count"] for r in moved(spark, sharding.Tree.of(8), sharding.Tree.of(9)) if r.b == 8) / 20_000
    assert abs(share - 1 / 9) < 0.02


def descended(key, nodes):
    """The weighted descent in plain Python: the least of -ln(u) / weight at every level."""
    import math

    import xxhash

    def weight(node):
        return node[2] if isinstance(node[1], int) else sum(weight(n) for n in node[1])

    def draw(node):
        bits = xxhash.xxh64_intdigest(node[0].encode(), xxhash.xxh64_intdigest(key.encode(), 42)) >> 12
        return -math.log((bits + 1) / 2 ** 52) / weight(node)

    while True:
        node = min((n for n in nodes if weight(n) > 0), key=draw)
        if isinstance(node[1], int):
            return node[1]
        nodes = node[1]


def test_shards_against_a_plain_descent(spark):
    uneven = sharding.Tree((("a", (("r", (("s0", 0, 1.0), ("s1", 1, 5.0))), ("q", (("s2", 2, 0.0), ("s3", 3, 2.0))))),
                            ("b", (("r", (("s4", 4, 0.5),)),))))
    keys = [str(i) for i in range(3000)] + ["é", "", "long " * 50]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    for tree in (sharding.Tree.of(8), sharding.Tree.of(9), uneven):
        got = {r.k: r.s for r in df.select("k", sharding.shard_of(F.col("k"), tree).alias("s")).collect()}
        assert got == {k: descended(k, tree.regions) for k in keys}
    rows = queries.QUERIES["op2_hash_tree_sharding"](spark, SF_SMOKE).collect()
    small, large = sharding.Tree.of(8).regions, sharding.Tree.of(9).regions
    assert all((r.shard, r.grown_shard) == (descended(str(r.doc_id), small), descended(str(r.doc_id), large)) for r in rows)


def test_a_changed_weight_moves_rows_between_its_path_and_the_rest(spark):
    def tree(weight):
        (name, racks), *rest = sharding.Tree.of(8).regions
        (rack, (leaf, *others)), *more = racks
        return sharding.Tree(((name, ((rack, ((*leaf[:2], weight), *others)), *more)), *rest))

    inside = {0, 1, 2, 3}  # region 0, whose subtree holds the changed shard 0
    for r in moved(spark, tree(1.0), tree(3.0)):
        if r.a != r.b:
            assert r.b in inside  # into the heavier region, or within it
        if r.a in (2, 3) and r.a != r.b:
            assert r.b in (0, 1)  # within the region only into the heavier rack
    assert all(r.b != 0 for r in moved(spark, tree(1.0), tree(0.0)))


URLS = [("http://a.example.org/en/123", "example.org/en/1"), ("https://EXAMPLE.org/es/", "example.org/es/"),
        ("http://xexample.org/es/q", "org/"), ("http://org/", "org/"), ("http://org", None), ("http://org?x=/", None),
        ("http://b.com/de/1#f", "com/de/"), ("http://com/fr", None), ("http://b.net/fr/", None), ("no scheme", None),
        (None, None), ("", None), ("http:///de/x", None), ("http://example.org/en/", "org/"),
        ("http://a.b.c.example.org/en/1/en/1", "example.org/en/1"), ("x" * 70_000, None)]


def test_urls_against_a_linear_scan(spark):
    pages = spark.createDataFrame([(i % 7, u, "own", "own") for i, (u, _) in enumerate(URLS * 2)],
                                  "page_id bigint, url string, rule string, key string")
    rules = spark.createDataFrame(queries.URL_RULES, url_filters.RULE_SCHEMA)
    rows = url_filters.judge(pages, rules).collect()
    verdict = {h + p: v for h, p, v in queries.URL_RULES}
    assert Counter((r.url, r.rule, r.verdict) for r in rows) == Counter(
        (u, rule, verdict.get(rule, "allow")) for u, rule in URLS * 2)
    assert {r.key for r in rows} == {"own"}
    assert url_filters.judge(pages.limit(0), rules).count() == 0
    assert {r.verdict for r in url_filters.judge(pages, rules.limit(0), default="block").collect()} == {"block"}


def test_nested_rules_many_runs(spark):
    rules = [("com", "/", "block"), ("com", "/a", "allow"), ("com", "/a/b", "block"), ("x.com", "/a", "block"),
             ("com", "/a/b/c", "allow"), ("com", "/z", "allow"), ("com", "/z", "block"), ("com", None, "allow")]
    paths = ["/", "/a", "/ab", "/a/", "/a/b", "/a/b/c/d", "/a/c", "/zz", "", "/b", "/a\U0010ffffz"]
    pages = spark.createDataFrame([(f"http://{h}com{p}",) for h in ("", "x.", "y.x.") for p in paths], "url string")
    got = {r.url: (r.rule, r.verdict) for r in url_filters.judge(
        pages, spark.createDataFrame(rules, url_filters.RULE_SCHEMA), partitions=9).collect()}
    table = {}
    for h, p, v in rules:
        table[h, p or ""] = max(v, table.get((h, p or ""), ""))
    for url, (rule, v) in got.items():
        host, _, path = url.removeprefix("http://").partition("/")
        path = "/" + path if "/" in url[7:] else ""
        fits = [(len(h + p), len(h), h + p, w) for (h, p), w in table.items()
                if (host == h or host.endswith("." + h)) and path.startswith(p)]
        assert (rule, v) == max(fits)[2:], url


def test_url_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF_SMOKE}/pages.parquet'")
    want = Counter(con.execute(queries.ORACLE_SQL["op3_url_filters"]).fetchall())
    assert Counter(map(tuple, queries.QUERIES["op3_url_filters"](spark, SF_SMOKE).collect())) == want


def test_url_plan_has_no_python(spark):
    plan = queries.QUERIES["op3_url_filters"](spark, SF_SMOKE)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan and "Cartesian" not in plan


def test_rules_without_a_path_fit_whole_labels_only(spark):
    rules = [("example.org", "", "block"), ("com", "", "block"), ("b.com", None, "allow"), ("net", "/x", "block")]
    urls = {"http://example2.org/x": None, "http://example.org": "example.org", "http://a.example.org/x": "example.org",
            "http://zoo.com/p": "com", "http://zoo.com": "com", "http://a.b.com/": "b.com", "http://bcom/": None,
            "http://c.net/xy": "net/x", "http://c.net": None, "http://com/": "com", "http://com.evil/": None}
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string")
    got = url_filters.judge(pages, spark.createDataFrame(rules, url_filters.RULE_SCHEMA), partitions=3).collect()
    assert {r.url: r.rule for r in got} == urls


def test_hosts_of_one_key_are_split_among_the_runs(spark, monkeypatch):
    from pyspark.sql import functions as F
    landed = {}
    land = url_filters.land
    monkeypatch.setattr(url_filters, "land", lambda df, label: landed.setdefault(label, land(df, label)))
    pages = spark.range(40_000).select(F.col("id").alias("page_id"), F.format_string("http://h%d.com/", "id").alias("url"))
    rules = spark.createDataFrame([("com", "/", "block"), ("h7.com", "/", "allow")], url_filters.RULE_SCHEMA)
    got = url_filters.judge(pages, rules, partitions=16).groupBy("rule", "verdict").count().collect()
    assert {(r["rule"], r["verdict"]): r["count"] for r in got} == {("com/", "block"): 39_999, ("h7.com/", "allow"): 1}
    sizes = [r["count"] for r in landed["url-runs"].groupBy("run").count().collect()]
    assert max(sizes) <= 2 * sum(sizes) / 16
