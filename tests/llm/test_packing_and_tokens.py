import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMOKE
from tickweave.llm import packing, queries, token_files
from tickweave.llm.tokens import bpe_json_path, worker_encoder

SCHEMA = "doc_id bigint, text string, source string, length int, pid string, base double"
ROWS = [(1, "Some words here.", "a", 1, "x", 0.5), (1, "Some words here.", "a", 1, "x", 0.5),
        (2, None, "b", 2, None, None), (3, "", None, 3, "y", 1.0), (None, "no id  at all", "a", 4, "z", 2.0),
        (5, "long " * 40_000, "b", 5, "x", 0.0), (6, "Ünï ‘q’ 中文 \x00 tail", "c", 6, "", 0.0)]


def library_ids(text):
    return np.frombuffer(worker_encoder(bpe_json_path()).whole(text or ""), "<u2").astype("<u4")


def test_chunked_encoding_is_that_of_the_whole_text():
    enc = worker_encoder(bpe_json_path())
    parts = ["a", "the", " ", "  ", "\n", "\t", "'s", "it's", "12", "3,4", "é", "中", "\xa0", "###", "don't", "x.y",
             "<|endoftext|>", "ª", "\x1c", "word,", "…"]
    rng = random.Random(3)
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert enc.encode(text) == enc.whole(text), repr(text)


def test_added_tokens_are_those_of_a_fresh_library(spark):
    from tokenizers import Tokenizer
    fresh = Tokenizer.from_file(bpe_json_path())
    rng = random.Random(5)
    parts = ["a", " ", "the", "<|endoftext|>", "<|endoftext|", "<|", "\n", "é", "it's", "word,", "<|ENDOFTEXT|>"]
    texts = ["hello <|endoftext|>world", "<|endoftext|>", "a<|endoftext|> <|endoftext|>b c"]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(2000)]
    enc = worker_encoder(bpe_json_path())
    want = [fresh.encode(t, add_special_tokens=False).ids for t in texts]
    assert [enc.ids(t).tolist() for t in texts] == want and 50256 in want[0]
    docs = spark.createDataFrame([(i, t, "a") for i, t in enumerate(texts)], "doc_id bigint, text string, source string")
    crc = {i: (len(w) + 1, zlib.crc32(np.array([*w, 2], "<u4").tobytes())) for i, w in enumerate(want)}
    back = token_files.read_token_files(token_files.write_token_files(docs)).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_crc32) for r in back} == crc
    assert {r.doc_id: r.doc_tokens for r in packing.pack(docs).collect()} == {i: n for i, (n, _) in crc.items()}


@pytest.mark.parametrize("targets", [False, True])
def test_schedule_is_monotone_and_complete(targets):
    rng = np.random.default_rng(4)
    for _ in range(20):
        totals = rng.integers(0, 4000, rng.integers(1, 12))
        if not totals.sum():
            continue
        s = packing.Schedule(totals.tolist(), list(rng.random(len(totals)) + 0.01) if targets else None)
        h = np.minimum(np.arange(0, totals.sum() + 32, 32), totals.sum())
        c = s.served(h)
        assert (c.sum(1) == h).all() and (np.diff(c, axis=0) >= 0).all() and (c[-1] == totals).all()


def test_windows_hold_the_target_mixture():
    s = packing.Schedule([10_000, 30_000, 2_000], [0.5, 0.3, 0.2])
    c = np.diff(s.served(np.arange(0, 9 * 1024, 1024)), axis=0)  # before any queue runs dry
    assert (abs(c - 1024 * np.array([0.5, 0.3, 0.2])) <= 2).all()


def check_pieces(rows, docs):
    by_doc, by_window = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id, r.doc_tokens].append(r)
        by_window[r.sequence_id].append((r.offset, r.length))
    for pieces in by_window.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024
    full = sum(sum(n for _, n in p) == 1024 for p in by_window.values())
    assert full >= len(by_window) - 1 and sorted(by_window) == list(range(len(by_window)))
    want = defaultdict(int)
    for doc_id, text in docs:
        want[doc_id, len(library_ids(text)) + 1] += 1
    assert set(want) == set(by_doc)
    texts = {(d, len(library_ids(t)) + 1): t for d, t in docs}
    for k, pieces in by_doc.items():
        ids = np.append(library_ids(texts[k]), 0).astype("<u4")
        assert sum(p.length for p in pieces) == want[k] * len(ids)
        for p in pieces:
            assert p.ids_crc32 == zlib.crc32(ids[p.start:p.start + p.length].tobytes())


def test_packing_of_awkward_rows(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    rows = packing.pack(docs, 1024).collect()
    check_pieces(rows, [(r[0], r[1]) for r in ROWS])
    assert {r.source for r in rows} == {"", "a", "b", "c"}
    assert packing.pack(docs.limit(0), 1024).count() == 0
    with pytest.raises(ValueError):
        packing.pack(docs, 1024, targets={"a": 1.0})


def test_packing_query(spark):
    docs = spark.read.parquet(f"{SF_SMOKE}/documents.parquet").select("doc_id", "text").collect()
    check_pieces(queries.QUERIES["op1_mixture_packing"](spark, SF_SMOKE).collect(), [tuple(r) for r in docs])


def expected_files(docs):
    out, start = [], 0
    for doc_id, text in docs:
        ids = np.append(library_ids(text), 2).astype("<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_token_files_round_trip(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    back = token_files.read_token_files(token_files.write_token_files(docs), with_ids=True).collect()
    want = expected_files(sorted(((r[0], r[1]) for r in ROWS), key=lambda r: (r[0] is not None, r[0] or 0)))
    assert sorted((tuple(r)[:4] for r in back), key=lambda r: r[1]) == want
    for r in back:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.n_tokens
    assert token_files.read_token_files(token_files.write_token_files(docs.limit(0))).count() == 0


def test_token_files_query_keeps_every_row(spark):
    docs = spark.read.parquet(f"{SF_SMOKE}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    for name in ("op6_token_files", "op6_token_files"):  # twice: no run may lose rows
        rows = queries.QUERIES[name](spark, SF_SMOKE).collect()
        assert sorted(map(tuple, rows)) == expected_files([tuple(r) for r in docs])


def test_lost_attempt_files_are_not_read(spark, tmp_path):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    manifest = token_files.write_token_files(docs, directory=f"file://{tmp_path}")
    (tmp_path / "part-000000-999.ids").write_bytes(b"left by a lost attempt")
    assert token_files.read_token_files(manifest).count() == len(ROWS)
    assert manifest.agg(F.sum("n_docs")).first()[0] == len(ROWS)
