import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.conftest import SF_SMOKE
from tickweave.llm import queries, spelling

DOC = "doc_id bigint, text string, word string, n int"


def counted(docs):
    found = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def one_edit(word, alphabet):
    """Every string one insertion, deletion or replacement away."""
    cuts = [(word[:k], word[k:]) for k in range(len(word) + 1)]
    out = {a + b[1:] for a, b in cuts if b} | {a + c + b for a, b in cuts for c in alphabet}
    out |= {a + c + b[1:] for a, b in cuts if b for c in alphabet}
    return out - {word}


def brute(words):
    alphabet = sorted({c for w in words for c in w})
    near = {w: [x for x in one_edit(w, alphabet) if x in words] if len(w) < 200 else
            [x for x in words if x != w and abs(len(x) - len(w)) <= 1 and slow_near(w, x)] for w in words}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 10 * words[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w
    return {w: (form[w], root(w), n, len(near[w]), words[form[w]] if form[w] else None) for w, n in words.items()}


def slow_near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def told(df):
    rows = df.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def test_query_on_given_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMOKE}/documents.parquet").select("doc_id", "text").collect()]
    got = told(queries.QUERIES["op12_spelling_variants"](spark, SF_SMOKE))
    assert got == brute(counted(docs)) and len(got) > 100


@pytest.mark.parametrize("chunk", [1024, 3, 1])
def test_variants_chains_and_ties_in_chunks_of_any_size(spark, monkeypatch, chunk):
    monkeypatch.setattr(spelling, "CHUNK", chunk)
    rng = random.Random(chunk)
    letters = "abcétzÿ"
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(7, 9))): rng.choice([2, 3, 30, 300, 2500])
             for _ in range(150)}
    for w in list(words)[:60]:
        words.setdefault(rng.choice(sorted(x for x in one_edit(w, letters) if len(x) >= 7)), rng.choice([2, 20, 250]))
    words |= {"chained": 2, "chainee": 25, "chainef": 250, "chaineg": 250, "chainegh": 3000}
    got = told(spelling.variants_of(spark.createDataFrame(list(words.items()), "word string, n bigint")))
    assert got == brute(words)
    assert got["chained"][1] == "chainegh" or got["chained"][0] in ("chainef", "chaineg")


def test_awkward_texts(spark):
    long = "q" * 5000
    docs = [(None, "Someword someword", "x", 1), (1, None, "x", 1), (2, "", "x", 1), (3, f"{long} {long}r {long} {long}r", "x", 1),
            (4, "short ones one two", "x", 1), (4, "Étrange étrange Étrange ×÷×÷×÷× ×÷×÷×÷×", "x", 1),
            (4, "Étrange étrange Étrange ×÷×÷×÷× ×÷×÷×÷×", "x", 1), (5, "SOMEWORD somewird_somewird" * 30, "x", 1)]
    df = spark.createDataFrame(docs, DOC)
    got = told(spelling.variants(df))
    assert got == brute(counted([d[:2] for d in docs]))
    assert spelling.variants(df.limit(0)).count() == 0


def test_pieces_of_a_text_cut_no_run(monkeypatch):
    monkeypatch.setattr(spelling, "PIECE", 10)
    text = " ".join("abcdefgh"[:k % 8 + 1] * (k % 5 + 1) for k in range(80))
    assert "".join(spelling._pieces(text)) == text
    assert [r for p in spelling._pieces(text) for r in spelling.RUN.findall(p)] == spelling.RUN.findall(text)


def test_gram_distances_keep_every_near_pair():
    rng = random.Random(2)
    for n, m in ((7, 7), (7, 8)):
        left = sorted({"".join(rng.choice("abc") for _ in range(n)) for _ in range(200)})
        right = left if n == m else sorted({"".join(rng.choice("abc") for _ in range(m)) for _ in range(200)})
        i, j = spelling.near_pairs([w.encode() for w in left], [w.encode() for w in right], n == m)
        want = {(a, b) for a in range(len(left)) for b in range(len(right))
                if (n != m or a < b) and slow_near(left[a], right[b])}
        assert set(zip(i.tolist(), j.tolist())) == want
    assert isinstance(i, np.ndarray)
