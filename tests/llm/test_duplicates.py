import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMOKE
from tests.llm import brute
from tickweave.llm import components, e8_lattice, queries, simhash, suffix_dedup

DOC = "doc_id bigint, text string, fp string, label int"


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(5)
    pairs = [(i, i + 1) for i in range(100, 160)] + [(500, k) for k in range(501, 700)] + [(7, 7), (9, 8), (8, 9)]
    pairs += [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(90)]
    nodes = sorted({x for p in pairs for x in p} | {1, 2, 3})
    linked = {frozenset(p) for p in pairs}
    want = brute.components(nodes, lambda i, j: frozenset((nodes[i], nodes[j])) in linked)
    got = components.connected_components(spark.createDataFrame([(n, n) for n in nodes], "node bigint, label bigint"),
                                          spark.createDataFrame(pairs, "a bigint, b bigint")).collect()
    assert {r.node: r.label for r in got} == want == {r.node: r.root for r in got}
    assert components.stars(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_fingerprints_and_groups_of_the_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMOKE}/documents.parquet").select("doc_id", "text").collect()]
    rows = {r.doc_id: r for r in queries.QUERIES["op5_simhash"](spark, SF_SMOKE).collect()}
    fp = {d: brute.simhash(t) for d, t in docs}
    assert {d: int(r.fingerprint, 16) for d, r in rows.items()} == fp
    ids = sorted(fp)
    want = brute.components(ids, lambda i, j: (fp[ids[i]] ^ fp[ids[j]]).bit_count() <= 3)
    assert {d: r.component_id for d, r in rows.items()} == want


def test_simhash_of_awkward_rows(spark):
    rows = [(5, None, "x", 1), (6, "", "x", 1), (4, " \n ", "x", 1), (1, "One two", "x", 1), (1, "One two", "x", 1),
            (0, "one TWO", "x", 1), (None, "one two", "x", 1), (9, "É a b c " * 9000, "x", 1)]
    docs = spark.createDataFrame(rows, DOC)
    got = simhash.near_duplicates(docs).collect()
    assert Counter((r.doc_id, r.component_id) for r in got) == Counter(
        [(5, 4), (6, 4), (4, 4), (1, 0), (1, 0), (0, 0), (None, 0), (9, 9)])
    assert {r.fingerprint for r in got if r.component_id == 4} == {"0" * 16}
    assert sorted(r.doc_id for r in simhash.one_of_each(docs).collect()) == [0, 4, 9]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0 == simhash.one_of_each(docs.limit(0)).count()


@pytest.mark.parametrize("distance", [0, 1, 2, 3, 5])
def test_links_find_every_near_pair(spark, distance):
    rng = random.Random(distance)
    fps = {0, (1 << 64) - 1, 1 << 63}
    for _ in range(60):
        f = rng.getrandbits(64)
        fps.add(f)
        for _ in range(4):
            fps.add(f ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 6))))
    fps = sorted(fps)
    signed = lambda f: f - (1 << 64) if f >> 63 else f
    want = {frozenset((signed(a), signed(b))) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= distance}
    got = simhash.links(spark.createDataFrame([(signed(f),) for f in fps], "fp bigint"), distance).collect()
    assert {frozenset((r.a, r.b)) for r in got} == want


@pytest.mark.parametrize("distance", [0, 1, 2, 3, 5])
def test_links_through_crowded_segments(spark, distance):
    rng = random.Random(40 + distance)
    centre = rng.getrandbits(64)
    fps = {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for _ in range(250)}
    fps |= {(centre >> 32 << 32) | rng.getrandbits(32) for _ in range(100)}
    fps = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    mask = (1 << 64) - 1
    want = {frozenset((a, b)) for a in fps for b in fps if a < b and ((a ^ b) & mask).bit_count() <= distance}
    got = simhash.links(spark.createDataFrame([(f,) for f in fps], "fp bigint"), distance, crowd=1).collect()
    assert {frozenset((r.a, r.b)) for r in got} == want


def test_a_dense_group_makes_no_pairs(spark):
    """4,000 fingerprints around one centre, with a chain of its own three bits on and far ones."""
    rng = random.Random(8)
    signed = lambda f: f - (1 << 64) if f >> 63 else f
    centre = rng.getrandbits(64)
    fps = {centre ^ sum(1 << b for b in rng.sample(range(64), 3)) for _ in range(4000)}
    fps |= {centre ^ 0b111 << 9 ^ 0b111 << 20, centre ^ 0b111 << 9 ^ 0b111 << 20 ^ 0b111 << 40}
    fps |= {rng.getrandbits(64) for _ in range(50)}
    fps = sorted(fps)
    frame = spark.createDataFrame([(signed(f), i) for i, f in enumerate(fps)], "fp bigint, doc_id bigint")
    want = brute.components(list(range(len(fps))), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 3)
    got = {r.fp: r.label for r in simhash._components(frame, 3, "doc_id").collect()}
    assert {i: got[signed(f)] for i, f in enumerate(fps)} == want
    crowded = simhash._crowded(frame, 3, simhash.CROWD)
    grouped = simhash.dense_groups(frame, 3, crowded)
    assert simhash.links(grouped, 3, group="node", crowded=crowded).count() < 4 * len(fps)


def test_suffix_array_and_common_prefixes():
    rng = random.Random(6)
    for _ in range(60):
        alphabet = rng.choice([b"a", b"ab", b"abc\x00\xff"])
        t = bytes(rng.choice(alphabet) for _ in range(rng.randint(1, 250)))
        a, n = np.frombuffer(t, np.uint8), len(t)
        sa = suffix_dedup.suffix_order(a)
        want = sorted(range(n), key=lambda i: t[i:])
        assert sa.tolist() == want
        cuts = sorted({0, *(rng.randrange(n) for _ in range(3))})
        lcp = suffix_dedup.common_prefixes(a, sa, np.array(cuts), np.diff([*cuts, n]), 50)

        def shared(i, j):
            k = 0
            while k < 50 and max(i, j) + k < n and t[i + k] == t[j + k]:
                k += 1
            return k

        assert lcp.tolist() == [0] + [shared(want[i - 1], want[i]) for i in range(1, n)]


def planted(seed, n):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("etaoinshé") for _ in range(rng.randint(1, 7)))
    passages = [" ".join(word() for _ in range(rng.choice([8, 11, 14, 60]))) for _ in range(12)]
    texts = []
    for _ in range(n):
        parts = [" ".join(word() for _ in range(rng.randint(0, 40)))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            parts += [p[rng.randint(0, 9):len(p) - rng.randint(0, 9)], " ".join(word() for _ in range(rng.randint(0, 9)))]
        texts.append("".join(parts))
    return texts + texts[:5] + ["a" * 200, "b" + "a" * 120, "a" * 49, "a" * 50, None, "", "xy" * 40, "yx" * 40]


@pytest.mark.parametrize("seed,shard", [(1, 1 << 21), (2, 3000), (3, 500)])
def test_repeats_against_brute_force(spark, monkeypatch, seed, shard):
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", shard)
    texts = planted(seed, 70)
    random.Random(seed).shuffle(texts)
    docs = [(i // 2 if i > 60 else i, t) for i, t in enumerate(texts)]  # some ids twice
    df = spark.createDataFrame([(d, t, "own", 9) for d, t in docs],
                               "doc_id bigint, text string, kept string, shard int").repartition(3)
    got = suffix_dedup.remove_repeats(df, carry=["shard"], bucket_bytes=2000).collect()
    want = brute.repeats_removed([(d, (t or "").encode()) for d, t in docs])
    assert Counter((r.doc_id, bytes(r.kept), r.n_removed, r.n_spans) for r in got) == Counter(want)
    assert {r.shard for r in got} == {9}


def test_repeats_null_ids_long_texts_and_empty_tables(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK", 10_000)
    rng = random.Random(9)
    long = "".join(rng.choice("abcdefgh") for _ in range(60_000))
    passage = long[9_970:10_060]  # across the work of two chunks
    docs = [(3, long), (None, passage), (None, passage), (4, "q" + passage), (2, "é" * 40), (5, "zé" + "é" * 39)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = suffix_dedup.remove_repeats(df, as_text=True).collect()
    byte_docs = [(d if d is not None else 99, t.encode()) for d, t in docs]
    want = Counter((d, n, s) for d, _, n, s in brute.repeats_removed(byte_docs))
    assert Counter((r.doc_id if r.doc_id is not None else 99, r.n_removed, r.n_spans) for r in got) == want
    assert {r.kept for r in got if r.doc_id == 4} == {"q"} and {r.kept for r in got if r.doc_id == 5} == {"z"}
    assert suffix_dedup.remove_repeats(df.limit(0)).count() == 0


def test_repeats_query(spark):
    docs = [(r.doc_id, (r.text or "").encode()) for r in spark.read.parquet(f"{SF_SMOKE}/documents.parquet").collect()]
    want = Counter((d, len(dict(docs)[d]), n, s, hashlib.sha256(k).hexdigest())
                   for d, k, n, s in brute.repeats_removed(docs))
    assert Counter(map(tuple, queries.QUERIES["op7_suffix_dedup"](spark, SF_SMOKE).collect())) == want


def test_e8_decoding_is_nearest():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((200, 8)) * 3
    p = e8_lattice.decode(x)
    roots = e8_lattice._shortest()
    assert len(roots) == 240 and np.allclose((roots ** 2).sum(1), 2)
    d = ((x - p) ** 2).sum(1)
    assert (d <= 1 + 1e-9).all()  # the covering radius of E8 is 1
    assert all((((x - (p + r)) ** 2).sum(1) >= d - 1e-9).all() for r in roots)


def grouped_vectors(seed):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((150, 64))
    near = [base]
    for k, spread in ((0, 0.10), (1, 0.25), (2, 0.40)):  # dense, looser, near the threshold
        near.append(base[k] + spread * rng.standard_normal((60, 64)))
    return np.concatenate(near).astype(np.float32)


def test_e8_recall_and_links_against_all_pairs(spark):
    x = grouped_vectors(3)
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    s = unit @ unit.T >= 0.9
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<float>")
    got = {r.vec_id: r for r in e8_lattice.near_duplicates(df).collect()}
    true = s.sum(1) - 1
    assert all(got[i].n_links <= n for i, n in enumerate(true))  # none below the threshold
    assert sum(r.n_links for r in got.values()) >= 0.9 * true.sum()
    want = brute.components(list(range(len(x))), lambda i, j: s[i, j])
    assert sum(got[i].component_id == want[i] for i in want) >= 0.98 * len(want)


def test_e8_dense_group_without_pairs(spark, monkeypatch):
    """1,500 vectors at mutual cosines around 0.93, too far apart for balls."""
    rng = np.random.default_rng(7)
    centre = rng.standard_normal(64)
    x = np.concatenate([centre + 0.275 * rng.standard_normal((1500, 64)), rng.standard_normal((300, 64))])
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = unit @ unit.T >= 0.9
    true = s.sum(1) - 1
    assert true[:1500].mean() > 1000
    landed = {}
    plain = e8_lattice.land

    def counted(df, label, **options):
        out = plain(df, label, **options)
        landed[label] = max(landed.get(label, 0), out.count())
        return out

    monkeypatch.setattr(e8_lattice, "land", counted)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    got = {r.vec_id: r for r in e8_lattice.near_duplicates(df).collect()}
    assert all(got[i].n_links <= n for i, n in enumerate(true))
    assert sum(r.n_links for r in got.values()) >= 0.99 * true.sum()
    assert max(landed.values()) < 20 * len(x)
    want = brute.components(list(range(len(x))), lambda i, j: s[i, j])
    assert all(got[i].component_id == c for i, c in want.items())


def test_e8_awkward_rows(spark):
    one = [1.0, 2.0, 0.0, 0.0]
    nan, inf = float("nan"), float("inf")
    rows = [(1, one), (2, [2.0, 4.0, 0.0, 0.0]), (3, one), (3, one), (4, None), (5, []), (6, [0.0] * 4), (7, [1.0, None, 0.0, 0.0]),
            (8, [nan, 1.0, 0.0, 0.0]), (9, [inf, 1.0, 0.0, 0.0]), (10, [1.0, 2.0]), (11, [1e300, 2e300, 0.0, 0.0]),
            (12, [1e-300, 2e-300, 0.0, 0.0]), (None, one)]
    df = spark.createDataFrame([(i, v, 0, 1.5) for i, v in rows], "vec_id bigint, embedding array<double>, row int, x double")
    got = Counter(map(tuple, e8_lattice.near_duplicates(df).collect()))
    alone = [(4, 0, 4, True), (5, 0, 5, True), (6, 0, 6, True), (7, 0, 7, True), (8, 0, 8, True), (9, 0, 9, True), (10, 0, 10, True)]
    together = [(1, 6, 1, True), (2, 6, 1, False), (3, 6, 1, False), (3, 6, 1, False), (11, 6, 1, False), (12, 6, 1, False),
                (None, 6, 1, False)]
    assert got == Counter(alone + together)
    assert e8_lattice.near_duplicates(df.limit(0)).count() == 0


def test_e8_query_returns_every_vector(spark):
    rows = queries.QUERIES["op10_e8_lattice"](spark, SF_SMOKE)
    n = spark.read.parquet(f"{SF_SMOKE}/embeddings.parquet").count()
    assert rows.count() == n == rows.agg(F.countDistinct("vec_id")).first()[0]
