import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_CHECK, SF_SMOKE
from tickweave.llm import queries, substring_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOC = "doc_id bigint, text string, rid string, kept int"


def brute(docs, window=50):
    least: dict = {}
    split = [(i, WORD.findall(t or "")) for i, t in docs]
    for i, words in split:
        for k in range(len(words) - window + 1):
            w = tuple(words[k:k + window])
            if i is not None and (w not in least or i < least[w]):
                least[w] = i
    out = []
    for i, words in split:
        gone = set()
        for k in range(len(words) - window + 1):
            first = least.get(tuple(words[k:k + window]))
            if first is not None and (i is None or first < i):
                gone.update(range(k, k + window))
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((i, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return Counter(out)


def told(df):
    return Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect())


@pytest.mark.parametrize("sf", [SF_SMOKE, SF_CHECK])
def test_query_on_given_table(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = told(queries.QUERIES["op13_substring_dedup"](spark, sf))
    assert got == brute(docs)
    assert any(r[2] for r in got)


def digest(df):
    return told(substring_dedup.remove_repeats(df).withColumn("kept_sha256", F.sha2("kept", 256)))


def made_up(seed):
    rng = random.Random(seed)
    fresh = [f"w{k}" for k in range(300)]

    def some(n):
        return [rng.choice(fresh) for _ in range(n)]

    passages = [some(rng.randint(49, 140)) for _ in range(6)]
    docs = []
    for i in range(120):
        words = some(rng.randint(0, 60))
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            cut = rng.randint(0, 20)
            words += p[cut:cut + rng.choice([50, 51, 60, 200])] + some(rng.choice([0, 1, 3, 40]))
        docs.append((rng.choice([i, i, i, 7, None]), rng.choice([" ", "\n", "\t \r"]).join(words)))
    docs += rng.sample(docs, 10)
    docs += [(rng.randint(0, 200), " ".join(["same"] * n)) for n in (49, 50, 51, 200, 333)]
    docs += [(rng.randint(0, 200), " ".join(["a", "b"] * 60)), (500, " ".join(["b", "a"] * 70)), (501, None), (501, ""),
             (None, " \n"), (502, "é ö x " * 40)]
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize("seed, block, shard, part", [(1, 14, 1 << 16, 1 << 18), (2, 3, 40, 30), (3, 0, 10 ** 6, 7)])
def test_awkward_documents_in_shards_of_any_size(spark, monkeypatch, seed, block, shard, part):
    monkeypatch.setattr(substring_dedup, "BLOCK_BITS", block)
    monkeypatch.setattr(substring_dedup, "SHARD_WORDS", shard)
    monkeypatch.setattr(substring_dedup, "PART_WORDS", part)
    docs = made_up(seed)
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], DOC)
    assert digest(df.repartition(5)) == brute(docs)


def test_empty_table(spark):
    assert substring_dedup.remove_repeats(spark.createDataFrame([], DOC)).count() == 0


def test_a_long_text_in_pieces(monkeypatch):
    rng = random.Random(4)
    words = [f"é{rng.randrange(50)}" for _ in range(3000)]
    text = "\t".join(words)
    whole = list(substring_dedup._parts(1, text))
    monkeypatch.setattr(substring_dedup, "PIECE", 200)
    parts = list(substring_dedup._parts(1, text))
    assert len(whole) == 1 and len(parts) > 20
    assert [w for p in substring_dedup.word_pieces(text) for w in p] == [w.encode() for w in words]
    seen = {}
    for _, at, h in parts:
        for k in range(len(h) - 49):
            assert at + k not in seen
            seen[at + k] = h[k:k + 50].tobytes()
    assert seen == {k: whole[0][2][k:k + 50].tobytes() for k in range(2951)}
    units = [{"start": s, "windows": n, "shard": s % 2, "reference": False} for s, n in ((5, 100), (90, 300), (700, 2000), (2950, 1))]
    import pyarrow as pa
    row = pa.RecordBatch.from_pylist([{"rid": 1, "doc": 1, "text": text, "units": units}])
    for r in [r for b in substring_dedup._words_of([row]) for r in b.to_pylist()]:
        n = len(r["words"].split(b" "))
        assert r["words"].decode().split(" ") == words[r["start"]:r["start"] + n] and n >= 50
    cut = pa.RecordBatch.from_pylist([{"doc_id": 1, "text": text, "spans": [{"start": 100, "end": 900}, {"start": 850, "end": 951}]}])
    (rest,) = [r for b in substring_dedup._cut([cut]) for r in b.to_pylist()]
    assert rest["n_removed"] == 851 and rest["kept"].split(" ") == words[:100] + words[951:]


def test_automaton_gives_the_least_document():
    rng = random.Random(9)
    texts = [(rng.randrange(9), [b"%d" % rng.randrange(3) for _ in range(rng.randint(1, 30))]) for _ in range(25)]
    made = substring_dedup.Automaton()
    for doc, words in texts:
        made.add(words, doc)
    matcher = substring_dedup.Matcher(made.packed())
    least = {}
    for doc, words in texts:
        for k in range(len(words) - 3):
            w = tuple(words[k:k + 4])
            least[w] = min(least.get(w, 99), doc)
    for doc in range(10):
        words = [b"%d" % rng.randrange(4) for _ in range(400)]
        gone = {i for k in range(397) if least.get(tuple(words[k:k + 4]), 99) < doc for i in range(k, k + 4)}
        assert {i for s, e in matcher.repeated(words, doc, 4) for i in range(s, e)} == gone
