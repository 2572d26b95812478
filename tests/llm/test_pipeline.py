from collections import Counter

import corpus_pipeline
from tests.conftest import SF_SMOKE
from tests.llm import brute
from tests.llm.test_packing_and_tokens import check_pieces
from tickweave.llm import quality


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMOKE}/documents.parquet")
    columns, out = docs.columns, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_SMOKE)
        assert docs.columns == columns
        out.append(docs.collect())
        docs = spark.createDataFrame(out[-1], docs.schema)
    kept, distinct, cut = out

    judged = quality.quality(spark.read.parquet(f"{SF_SMOKE}/documents.parquet")).where("kept").collect()
    assert Counter(r.doc_id for r in kept) == Counter(r.doc_id for r in judged)

    fp = {r.doc_id: brute.simhash(r.text) for r in kept}
    ids = sorted(fp)
    groups = brute.components(ids, lambda i, j: (fp[ids[i]] ^ fp[ids[j]]).bit_count() <= 3)
    assert sorted(r.doc_id for r in distinct) == sorted(d for d, g in groups.items() if d == g)

    want = {d: (k.decode("utf-8", "ignore"), n) for d, k, n, _ in
            brute.repeats_removed([(r.doc_id, r.text.encode()) for r in distinct])}
    size = {r.doc_id: len(r.text.encode()) for r in distinct}
    assert {r.doc_id: r.text for r in cut} == {d: t for d, (t, n) in want.items() if not n or n < size[d]}
    assert all(r.n_chars == len(r.text) for r in cut if want[r.doc_id][1])

    check_pieces(corpus_pipeline.run(spark, SF_SMOKE).collect(), [(r.doc_id, r.text) for r in cut])


def test_stages_on_awkward_tables(spark):
    clean = "The house is in the north of the town and it was built by a man with two sons. " \
            + " ".join(f"Then came the {w}ing of a {w}er in {w}land." for w in "abcdefghijklmnop")
    rows = [(1, clean, "own", 3, "a"), (1, clean, "own", 3, "a"), (None, clean + " More of it.", None, 4, None),
            (2, None, "own", 5, "b"), (3, "", None, 6, "b"), (4, "x " * 90_000, "own", 7, "c")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, fp int, kept string")
    for table in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, table, SF_SMOKE)
            got = out.collect()
            assert name == "packing" or out.columns == docs.columns
            if table is not docs:
                assert got == []
            elif name == "quality_rules":
                assert {r.doc_id for r in got} == {1, None} and {r.kept for r in got} == {"a", None}
            elif name == "simhash_near_duplicates":
                assert Counter(r.doc_id for r in got)[1] == 1
            elif name == "repeated_passages":
                assert Counter(r.doc_id for r in got)[1] == 2  # rows of one id do not remove from each other
