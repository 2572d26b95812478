"""Groups of spelling variants by blocked Gram matrices.

One insertion, deletion or replacement changes the letter counts of a word by a squared distance of
1 or 2. Words are dealt into blocks of one length and one profile, the sums of their letter counts
over CLASSES classes of letters: an insertion adds one to one sum, a replacement moves one between
two classes or none, so only a few adjacent blocks can hold near words. A block is cut into chunks
of bounded bytes. For each pair of chunks of adjacent blocks, NumPy multiplies the letter counts (a
Gram matrix; with the squared norms it gives all squared distances); pairs at 1 or 2 are verified
letter by letter. A task emits, for each word and chunk pair, how many near words it has there and
the best of them, never the pairs.

Every block meets the same few blocks whatever its size, and a chunk is shipped once for each of its
partners, so what is shipped grows with the vocabulary and with the number of chunks of its largest
blocks.

Defined results: a null text has no words; a null doc_id reads as empty text before the colon. Very
long runs are words like any other; a chunk holds one of them at least. Rows repeat as often as they
are there. Columns but doc_id and text are not looked at. An empty table gives an empty result."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import land, ship_package, slices

SHORTEST = 7
OFTEN = 2
RATIO = 10
ODD = 31
RUN = re.compile("[A-Za-zÀ-ÿ]{7,}")      # maximal: a match begins where a run of 7 begins
LOWER = {c: c + 32 for c in range(65, 91)}
PIECE = 1 << 20           # characters of a text looked at together
HELD = 200_000            # words counted before they are handed on
CLASSES = 6               # of letters, in profiles
CHUNK = 1024              # words of a chunk at most
CHUNK_BYTES = 1 << 20     # of its letters
LETTERS = 26 + 64


def _pieces(text: str):
    """A text in pieces that end between runs."""
    at = 0
    while len(text) - at > PIECE:
        cut = re.compile("[^A-Za-zÀ-ÿ]").search(text, at + PIECE)
        end = cut.end() if cut else len(text)
        yield text[at:end]
        at = end
    yield text[at:] if at else text


def _counts(batches):
    found: Counter = Counter()

    def out():
        words = list(found)
        table = pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(list(found.values()), pa.int64())],
                                           ["word", "n"])
        found.clear()
        return table

    for b in slices(batches, 64):
        for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
            if text is None:
                continue
            prefix = zlib.crc32(f"{'' if doc is None else doc}:".encode())
            for piece in _pieces(text):
                for run, n in Counter(RUN.findall(piece)).items():
                    run = run.lower() if run.isascii() else run.translate(LOWER)
                    h = zlib.crc32(run.encode(), prefix)
                    if h % ODD == 0:
                        k = h % len(run)
                        run = run[:k] + run[k + 1:]
                        if len(run) < SHORTEST:
                            continue
                    found[run] += n
                if len(found) > HELD:
                    yield out()
    if found:
        yield out()


def word_counts(docs: DataFrame) -> DataFrame:
    """word, n of every word that occurs OFTEN times or more over all of `docs`."""
    ship_package(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(_counts, "word string, n bigint") \
        .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= OFTEN)


def _matrix(words: list[bytes]) -> np.ndarray:
    """Latin-1 bytes of words of one length, a row each."""
    return np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1)


def _letter(byte: np.ndarray) -> np.ndarray:
    return np.where(byte < 128, byte - 97, byte.astype(np.int16) - 0xC0 + 26)


def _gram_counts(m: np.ndarray) -> np.ndarray:
    flat = _letter(m).astype(np.int64) + np.arange(len(m))[:, None] * LETTERS
    counts = np.bincount(flat.ravel(), minlength=len(m) * LETTERS).reshape(len(m), LETTERS)
    return counts.astype(np.float32 if m.shape[1] < 2000 else np.float64)   # exact sums of squares


def _near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether row k of `a` and of `b` (as long or one longer) differ by exactly one edit."""
    n = a.shape[1]
    if n == b.shape[1]:
        return (a != b).sum(1) == 1
    head = (a == b[:, :n]).cumprod(1, dtype=np.uint8).sum(1, dtype=np.int64)
    tail = (a == b[:, 1:])[:, ::-1].cumprod(1, dtype=np.uint8).sum(1, dtype=np.int64)
    return head + tail >= n


def near_pairs(left: list[bytes], right: list[bytes], same: bool):
    """Positions (i, j) of the near pairs of two chunks; `same`: a chunk with itself, i < j."""
    a, b = _matrix(left), _matrix(right)
    ca, cb = _gram_counts(a), _gram_counts(b)
    distance = (ca * ca).sum(1)[:, None] + (cb * cb).sum(1)[None] - 2 * (ca @ cb.T)
    close = (distance <= 2) & (distance >= 1)          # anagrams are never one edit apart
    i, j = np.nonzero(np.triu(close, 1) if same else close)
    step = max(1, (1 << 24) // b.shape[1])
    keep = [_near(a[i[k:k + step]], b[j[k:k + step]]) for k in range(0, len(i), step)]
    keep = np.concatenate(keep) if keep else np.zeros(0, bool)
    return i[keep], j[keep]


def _profiles(words: list[str]) -> list[list[int]]:
    letters = [w.encode("latin-1") for w in words]
    row = np.repeat(np.arange(len(words)), [len(x) for x in letters])
    at = row * CLASSES + _letter(np.frombuffer(b"".join(letters), np.uint8)) % CLASSES
    return np.bincount(at, minlength=len(words) * CLASSES).reshape(-1, CLASSES).tolist()


def _partners(profile: list[int]) -> list[list[int]]:
    """The blocks that a block is multiplied with, each pair of blocks from one of its sides: itself,
    one more in a class (an insertion), one moved from a class to a later one (a replacement)."""
    out = [profile]
    for i in range(CLASSES):
        out.append([p + (k == i) for k, p in enumerate(profile)])
        if profile[i]:
            out += [[p - (k == i) + (k == j) for k, p in enumerate(profile)] for j in range(i + 1, CLASSES)]
    return out


def _blocks(batches):
    """Words with the key of their block."""
    for b in slices(batches, 8192):
        words = b.column("word").to_pylist()
        keys = [",".join(map(str, p)) for p in _profiles(words)]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), b.column("word"), b.column("n")],
                                         ["block", "word", "n"])


def _adjacent(batches):
    """block -> the blocks it is multiplied with."""
    for b in batches:
        mine, other = [], []
        for block in b.column("block").to_pylist():
            for p in _partners([int(x) for x in block.split(",")]):
                mine.append(block)
                other.append(",".join(map(str, p)))
        yield pa.RecordBatch.from_arrays([pa.array(mine, pa.string()), pa.array(other, pa.string())], ["block", "partner"])


def _best(words, ns, i, j, told: dict) -> None:
    """Add the near words j of i to `told`: word -> [how many, n of the best, the best]."""
    for a, b in zip(i, j):
        t = told.get(a)
        n, w = ns[1][b], words[1][b]
        if t is None:
            told[a] = [1, n, w]
        else:
            t[0] += 1
            if n > t[1] or n == t[1] and w < t[2]:
                t[1], t[2] = n, w


def _multiply(batches):
    """Pairs of chunks -> word, n_near, best_n, best of the words of either side."""
    for b in slices(batches, 1):
        row = {c: b.column(c)[0].as_py() for c in ("words", "ns", "others", "other_ns", "same")}
        left = [w.encode("latin-1") for w in row["words"]]
        right = left if row["same"] else [w.encode("latin-1") for w in row["others"]]
        i, j = (x.tolist() for x in near_pairs(left, right, row["same"]))
        if not i:
            continue
        words, ns = (row["words"], row["others"]), (row["ns"], row["other_ns"])
        mine: dict = {}
        theirs = mine if row["same"] else {}
        _best(words, ns, i, j, mine)
        _best(words[::-1], ns[::-1], j, i, theirs)
        out = [(words[0][a], *t) for a, t in mine.items()]
        if not row["same"]:
            out += [(words[1][a], *t) for a, t in theirs.items()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _NEAR.types)], schema=_NEAR)


_NEAR = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])


def near_words(counted: DataFrame) -> DataFrame:
    """word, n_near, best_n, best (near word of the largest n, of equal ones the least) of the words of
    `counted` (word, n; a word once) that have near words."""
    spark = counted.sparkSession
    ship_package(spark)
    keyed = land(counted.select("word", "n").mapInArrow(_blocks, "block string, word string, n bigint"), "blocks")
    sizes = keyed.groupBy("block").agg(F.count(F.lit(1)).alias("size"), F.max(F.length("word")).alias("length"))
    room = F.greatest(F.lit(1), F.least(F.lit(CHUNK), F.floor(F.lit(CHUNK_BYTES) / F.col("length"))))
    sizes = land(sizes.select("block", F.ceil(F.col("size") / room).cast("long").alias("chunks")), "block-sizes")
    dealt = keyed.join(sizes, "block").withColumn("chunk", F.pmod(F.xxhash64("word"), F.col("chunks")))
    chunks = land(dealt.groupBy("block", "chunk").agg(F.array_sort(F.collect_list(F.struct("word", "n"))).alias("w"))
                  .select("block", "chunk", F.col("w.word").alias("words"), F.col("w.n").alias("ns")), "chunks")
    partner = sizes.select("block").mapInArrow(_adjacent, "block string, partner string")
    other = chunks.select(F.col("block").alias("partner"), F.col("chunk").alias("other"),
                          F.col("words").alias("others"), F.col("ns").alias("other_ns"))
    names = chunks.select("block", "chunk")
    # Spark takes `partner` to be as small as `sizes`, of which it has many rows for each: no broadcast
    meet = names.join(partner.hint("merge"), "block").join(names.toDF("partner", "other"), "partner") \
        .where((F.col("block") != F.col("partner")) | (F.col("chunk") <= F.col("other"))) \
        .withColumn("same", (F.col("block") == F.col("partner")) & (F.col("chunk") == F.col("other")))
    pairs = meet.join(chunks, ["block", "chunk"]).join(other, ["partner", "other"]) \
        .select("words", "ns", "others", "other_ns", "same")
    found = pairs.mapInArrow(_multiply, "word string, n_near bigint, best_n bigint, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("minus"), "best")).alias("b")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best) \
        .select("word", "n_near", (-F.col("b.minus")).alias("best_n"), F.col("b.best").alias("best"))


def variants(docs: DataFrame) -> DataFrame:
    """`variants_of` the words of `docs`."""
    return variants_of(land(word_counts(docs), "words"))


def variants_of(counted: DataFrame) -> DataFrame:
    """One row for each row of `counted` (word, n): word, n, n_near, form (its near word of the largest n,
    if that is at least RATIO times its own; else null), form_n, root (from word, follow forms to the
    last)."""
    near = near_words(counted)
    fits = F.col("best_n") >= RATIO * F.col("n")
    rows = land(counted.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(fits, F.col("best")).alias("form"),
        F.when(fits, F.col("best_n")).alias("form_n")), "variants")
    roots = land(rows.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    # n grows RATIO-fold from form to form and is below 2^63, so a chain has at most 18 of them
    for _ in range(5):
        step = roots.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        longer = land(roots.join(step, "root", "left").select("word", F.coalesce("_next", "root").alias("root"),
                                                              F.col("_next").isNotNull().alias("_moved")), "roots")
        moved = not longer.where("_moved").isEmpty()
        roots = longer.drop("_moved")
        if not moved:
            break
    return rows.join(roots, "word", "left").select("word", "n", "n_near", "form", "form_n",
                                                   F.coalesce("root", "word").alias("root"))
