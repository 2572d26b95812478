"""Removal of long repeated word passages by suffix automata.

Every word goes that lies in a window of WINDOW words which also starts in a document of a smaller
id. What may repeat is found first, so that only that is streamed:

1. Each window has an anchor, the least hash of its GRAM-word strings; windows in a row with the same
   anchor are a run. Equal windows have equal anchors, so only runs whose anchor two documents have
   matter. Of these, runs of equal text (a class) belong to the least document of their class.
2. The documents that come first in their class are compared window by window where an anchor has
   several classes, for instance at both ends of a passage whose surroundings differ: a window
   belongs to the least document that has it.
3. The text that others repeat is the reference, cut into shards of about SHARD_WORDS words by the
   document and place it belongs to. A task builds a shard's suffix automaton once; every state
   knows the least document among its occurrences. The automaton is packed and broadcast to the
   tasks that need it: as many copies of its row as the text to be held against it needs tasks, so
   a passage that very many documents share is many tasks' work.
4. Documents stream their repeated stretches through the automata for matching statistics, cut off
   at WINDOW: where the match is that long and its state has a smaller document, the window goes.
   Hashes choose what is compared; what goes is decided by the automata, word by word.

The documents are written once as a bucketed table, and meet what is known about them without being
shuffled again. Everything shuffled besides is runs, windows at the edges of repeats, and repeated text.

Defined results: a null text has no words and an empty rest; a null doc_id comes after all others and
is smaller than none; documents of equal id remove nothing from each other; repeated rows are each
treated; texts of any length go in pieces of PIECE bytes. Columns but doc_id and text are not looked
at. An empty table gives an empty result."""

from __future__ import annotations

import math
import re
import struct
import uuid

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from .common import land, shared_dir, ship_package, shuffle_partitions, slices

WINDOW = 50
GRAM = 12
PIECE = 1 << 20            # bytes of a text that are split into words together
BATCH_WORDS = 1 << 18      # hashed together
BLOCK_BITS = 14            # of the places in a document that belong to one shard
SHARD_WORDS = 1 << 16      # of a reference shard, about
PART_WORDS = 1 << 18       # of repeated text streamed by one task, about
CUT = 1 << 15              # windows of a stretch at most
NO_ID = (1 << 63) - 1
CACHE = 1 << 19            # distinct words whose hashes a worker keeps
SPACE = re.compile(rb"[\x20\x09-\x0D]")

BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
SECOND = 0xC2B2AE3D27D4EB4F
SECOND_INVERSE = pow(SECOND, -1, 1 << 64)


def word_pieces(text: str | None):
    """The words of a text, in lists. bytes.split() splits at exactly the six white-space bytes."""
    data = (text or "").encode()
    at = 0
    while len(data) - at > PIECE:
        cut = SPACE.search(data, at + PIECE)
        end = cut.start() if cut else len(data)
        yield data[at:end].split()
        at = end
    yield (data[at:] if at else data).split()


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHE:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_HASH = _Hashes()


def hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_HASH.__getitem__, words), np.uint64, len(words))


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 2 * BATCH_WORDS), base, np.uint64)
        have[0] = 1
        _POWERS[base] = have = np.multiply.accumulate(have)
    return have[:n]


def _prefix(h: np.ndarray, inverse: int) -> np.ndarray:
    """Prefix sums by which a string's hash is taken in one step (arithmetic modulo 2^64)."""
    out = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * _powers(inverse, len(h)), out=out[1:])
    return out


def _string(prefix: np.ndarray, start: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    return (prefix[end] - prefix[start]) * _powers(base, len(prefix))[start]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while 2 * have <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[:len(x) - (width - have)], x[width - have:]) if have < width else x


def _parts(owner, text: str | None):
    """(owner, place of the first word, hashes) of a text, in parts that share WINDOW - 1 words."""
    at, carried = 0, np.zeros(0, np.uint64)
    for words in word_pieces(text):
        h = np.concatenate([carried, hashes(words)])
        if len(h) >= WINDOW:
            yield owner, at, h
            at += len(h) - (WINDOW - 1)
            h = h[len(h) - (WINDOW - 1):]
        carried = h


def _grouped(parts):
    """Lists of parts, of BATCH_WORDS words or one part."""
    held, size = [], 0
    for p in parts:
        held.append(p)
        size += len(p[-1])
        if size >= BATCH_WORDS:
            yield held
            held, size = [], 0
    if held:
        yield held


def _runs(parts: list) -> tuple:
    """Of the runs of `parts`: number of the part, start, windows, anchor, span (hash of the text)."""
    h = np.concatenate([p[2] for p in parts])
    sizes = np.array([len(p[2]) for p in parts])
    part = np.repeat(np.arange(len(parts)), sizes)
    first = np.repeat(np.cumsum(sizes) - sizes, sizes)
    prefix = _prefix(h, INVERSE)
    at = np.arange(len(h) - GRAM + 1)
    anchor = _sliding_least(_mixed(_string(prefix, at, at + GRAM, BASE)), WINDOW - GRAM + 1)
    n = len(anchor)
    here, there = part[:n], part[WINDOW - 1:]
    new = np.ones(n, bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (here[1:] != here[:-1]) | (there[1:] != there[:-1])
    start = np.flatnonzero(new)
    windows = np.diff(np.append(start, n))
    whole = here[start] == there[start]
    start, windows = start[whole], windows[whole]
    span = _mixed(_string(prefix, start, start + windows + (WINDOW - 1), BASE) + windows.astype(np.uint64))
    owner = here[start]
    return owner, np.array([p[1] for p in parts])[owner] + start - first[start], windows, anchor[start], span


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _find_runs(batches):
    def parts():
        for b in slices(batches, 64):
            for rid, doc, text in zip(*[b.column(c).to_pylist() for c in ("rid", "doc", "text")]):
                yield from _parts((rid, doc), text)

    for group in _grouped(parts()):
        part, start, windows, anchor, span = _runs(group)
        if len(part):
            owner = np.array([p[0] for p in group], np.int64)[part]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ascontiguousarray(owner[:, 0])), pa.array(np.ascontiguousarray(owner[:, 1])),
                 pa.array(start), pa.array(windows), _signed(anchor), _signed(span)],
                ["rid", "doc", "start", "windows", "anchor", "span"])


def _window_hashes(batches):
    """Rows rid, doc, text, runs -> rid, doc, start, w1, w2 of every window of the runs."""
    for b in slices(batches, 64):
        for rid, doc, text, runs in zip(*[b.column(c).to_pylist() for c in ("rid", "doc", "text", "runs")]):
            wanted = np.concatenate([np.arange(r["start"], r["start"] + r["windows"]) for r in runs])
            wanted.sort()
            for _, at, h in _parts(rid, text):
                lo, hi = np.searchsorted(wanted, [at, at + len(h) - WINDOW + 1])
                if lo < hi:
                    s = wanted[lo:hi] - at
                    w1 = _string(_prefix(h, INVERSE), s, s + WINDOW, BASE)
                    w2 = _string(_prefix(h, SECOND_INVERSE), s, s + WINDOW, SECOND)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(s), rid)), pa.array(np.full(len(s), doc)), pa.array(wanted[lo:hi]),
                         _signed(_mixed(w1)), _signed(_mixed(w2))], ["rid", "doc", "start", "w1", "w2"])


def _stretches(units: list) -> list[tuple]:
    """(start, end, shard, reference) in words, of a document's units, merged where they touch and
    belong to the same shard; CUT windows at most."""
    out = []
    for u in sorted(units, key=lambda u: (u["reference"], u["shard"], u["start"])):
        last = out[-1] if out else None
        end = u["start"] + u["windows"]
        if last and last[2:] == [u["shard"], u["reference"]] and u["start"] <= last[1]:
            last[1] = max(last[1], end)
        else:
            out.append([u["start"], end, u["shard"], u["reference"]])
    return sorted((s, min(s + CUT, end) + WINDOW - 1, shard, ref)
                  for start, end, shard, ref in out for s in range(start, end, CUT))


def _words_of(batches):
    """Rows rid, doc, text, units -> the words of their stretches."""
    made: list = []
    for b in slices(batches, 64):
        for rid, doc, text, units in zip(*[b.column(c).to_pylist() for c in ("rid", "doc", "text", "units")]):
            pieces, have, at = word_pieces(text), [], 0
            for start, end, shard, ref in _stretches(units):
                if start > at:
                    drop = min(start - at, len(have))
                    have, at = have[drop:], at + drop
                while at + len(have) < end:
                    have += next(pieces)
                    if start > at:
                        drop = min(start - at, len(have))
                        have, at = have[drop:], at + drop
                made.append((shard, ref, rid, doc, start, b" ".join(have[start - at:end - at])))
                if len(made) == 64:
                    yield _batch(made, _WORDS)
                    made = []
    if made:
        yield _batch(made, _WORDS)


_WORDS = pa.schema([("shard", pa.int64()), ("reference", pa.bool_()), ("rid", pa.int64()), ("doc", pa.int64()),
                    ("start", pa.int64()), ("words", pa.binary())])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


class Automaton:
    """Suffix automaton over the words of several texts; a state knows the least document in which
    its strings end."""

    def __init__(self):
        self.symbol: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.doc = [-1], [0], [NO_ID]

    def _state(self, length: int, follow: dict, link: int) -> int:
        self.next.append(follow)
        self.link.append(link)
        self.length.append(length)
        self.doc.append(NO_ID)
        return len(self.next) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        """The state of the strings of q that p and c make, apart from q's longer ones."""
        if self.length[q] == self.length[p] + 1:
            return q
        own = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = own
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = own
            p = self.link[p]
        return own

    def add(self, words: list[bytes], doc: int) -> None:
        symbol, follow, link = self.symbol, self.next, self.link
        last = 0
        for w in words:
            c = symbol.setdefault(w, len(symbol))
            p, q = last, follow[last].get(c)
            if q is not None:
                last = self._split(p, c, q)
            else:
                last = self._state(self.length[p] + 1, {}, 0)
                while p >= 0 and (q := follow[p].get(c)) is None:
                    follow[p][c] = last
                    p = link[p]
                if p >= 0:
                    own = self._split(p, c, q)
                    link[last] = own
            if doc < self.doc[last]:
                self.doc[last] = doc

    def packed(self) -> bytes:
        """The automaton with the least documents carried down the suffix links."""
        length = np.array(self.length, np.int32)
        doc, link = self.doc, self.link
        for v in np.argsort(-length, kind="stable").tolist():
            if v and doc[v] < doc[link[v]]:
                doc[link[v]] = doc[v]
        state = np.repeat(np.arange(len(self.next), dtype=np.int32), [len(f) for f in self.next])
        symbol = np.array([c for f in self.next for c in f], np.int32)
        target = np.array([t for f in self.next for t in f.values()], np.int32)
        parts = [b" ".join(self.symbol), length.tobytes(), np.array(link, np.int32).tobytes(),
                 np.array(doc, np.int64).tobytes(), state.tobytes(), symbol.tobytes(), target.tobytes()]
        head = struct.pack("<7q", *map(len, parts))
        return zstandard.ZstdCompressor(level=3).compress(head + b"".join(parts))


class Matcher:
    """A packed automaton that texts are streamed through."""

    def __init__(self, packed: bytes):
        data = zstandard.ZstdDecompressor().decompress(packed)
        sizes = struct.unpack_from("<7q", data)
        parts, at = [], 7 * 8
        for n in sizes:
            parts.append(data[at:at + n])
            at += n
        self.symbol = {w: c for c, w in enumerate(parts[0].split(b" "))} if parts[0] else {}
        self.length = np.frombuffer(parts[1], np.int32).tolist()
        self.link = np.frombuffer(parts[2], np.int32).tolist()
        self.doc = np.frombuffer(parts[3], np.int64).tolist()
        key = np.frombuffer(parts[4], np.int32).astype(np.int64) << 32 | np.frombuffer(parts[5], np.int32)
        self.next = dict(zip(key.tolist(), np.frombuffer(parts[6], np.int32).tolist()))

    def repeated(self, words: list[bytes], doc: int, window: int) -> list[list[int]]:
        """[start, end) of the words in windows that a smaller document has, merged."""
        follow, link, length, least, known = self.next.get, self.link, self.length, self.doc, self.symbol.get
        out: list[list[int]] = []
        state = matched = 0
        for at, w in enumerate(words):
            c = known(w)
            if c is None:
                state = matched = 0
                continue
            to = follow(state << 32 | c)
            while to is None and state:
                state = link[state]
                matched = length[state]
                to = follow(state << 32 | c)
            if to is None:
                matched = 0
                continue
            state, matched = to, matched + 1
            if matched >= window:
                matched = window
                while length[link[state]] >= window:
                    state = link[state]
                if least[state] < doc:
                    start = at + 1 - window
                    if out and start <= out[-1][1]:
                        out[-1][1] = at + 1
                    else:
                        out.append([start, at + 1])
        return out


def _rows(batches, *columns):
    for b in slices(batches, 64):
        yield from zip(*[b.column(c).to_pylist() for c in columns])


def _build(batches):
    """Reference stretches, a shard's together -> shard, automaton."""
    now, made = None, None
    for shard, doc, words in _rows(batches, "shard", "doc", "words"):
        if shard != now:
            if made:
                yield _batch([(now, made.packed())], _BUILT)
            now, made = shard, Automaton()
        made.add(words.split(b" "), doc)
    if made:
        yield _batch([(now, made.packed())], _BUILT)


_BUILT = pa.schema([("shard", pa.int64()), ("automaton", pa.binary())])


def _match(batches):
    """A shard's automaton, then the stretches held against it -> rid, start, end of what repeats."""
    matcher = None
    made: list = []
    for automaton, rid, doc, start, words in _rows(batches, "automaton", "rid", "doc", "start", "words"):
        if automaton is not None:
            matcher = Matcher(automaton)
            continue
        made += [(rid, start + s, start + e) for s, e in matcher.repeated(words.split(b" "), doc, WINDOW)]
        if len(made) > 4096:
            yield _batch(made, _FOUND)
            made = []
    if made:
        yield _batch(made, _FOUND)


_FOUND = pa.schema([("rid", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])


def _union(spans) -> list[list[int]]:
    out: list[list[int]] = []
    for s, e in sorted((x["start"], x["end"]) for x in spans or ()):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return out


def _cut(batches):
    """Rows doc_id, text, spans -> doc_id, n_words, n_removed, kept (text)."""
    for b in slices(batches, 64):
        made = []
        for text, spans in zip(b.column("text").to_pylist(), b.column("spans").to_pylist()):
            spans = _union(spans)
            n, k, kept = 0, 0, []
            for words in word_pieces(text):
                end, at = n + len(words), n
                while k < len(spans) and spans[k][0] < end:
                    kept += words[at - n:max(at, spans[k][0]) - n]
                    at = min(end, spans[k][1])
                    if spans[k][1] > end:
                        break
                    k += 1
                kept += words[at - n:]
                n = end
            made.append((n, sum(e - s for s, e in spans), b" ".join(kept).decode()))
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), *[pa.array(c, t) for c, t in zip(zip(*made), (pa.int64(), pa.int64(), pa.string()))]],
            ["doc_id", "n_words", "n_removed", "kept"])


def _bucketed(docs: DataFrame) -> DataFrame:
    """`docs` with a row id, written as a table of as many buckets of it as there are shuffle partitions."""
    spark = docs.sparkSession
    n = shuffle_partitions(spark)
    name = f"texts_{uuid.uuid4().hex}"
    docs.repartition(n, "rid").write.bucketBy(n, "rid").option("compression", "zstd") \
        .option("path", shared_dir(spark, "llm", "texts")).saveAsTable(name)
    return spark.table(name)


def _with_text(texts: DataFrame, about: DataFrame, name: str, columns: list[str], how: str = "inner") -> DataFrame:
    """The documents with the array `name` of what `about` (rid and `columns`) has of them."""
    listed = about.groupBy("rid").agg(F.collect_list(F.struct(*columns)).alias(name))
    return texts.join(listed, "rid", how)


def _units(texts: DataFrame) -> DataFrame:
    """Landed rid, doc, start, windows (stretches that repeat) and first (doc, rid, start), of which each
    is a repeat, or which it is itself."""
    runs = land(texts.select("rid", "doc", "text").mapInArrow(
        _find_runs, "rid bigint, doc bigint, start bigint, windows bigint, anchor bigint, span bigint"), "runs")
    shared = runs.groupBy("anchor").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")).where("lo < hi")
    runs = land(runs.join(shared.select("anchor"), "anchor", "left_semi"), "shared-runs")
    first = F.min(F.struct("doc", "rid", "start")).alias("first")
    # aggregates are landed before they are joined: a join whose exchange is its own is split where a key is hot
    classes = land(runs.groupBy("anchor", "span").agg(first, F.max("doc").alias("hi")), "classes")
    several = land(classes.groupBy("anchor").agg((F.count(F.lit(1)) > 1).alias("several")), "anchors")
    classed = land(runs.join(classes.join(several, "anchor"), ["anchor", "span"])
                   .select("rid", "doc", "start", "windows", "first", "hi", "several"), "classed-runs")
    apart = classed.where((F.col("doc") == F.col("first.doc")) & F.col("several"))
    windows = land(_with_text(texts, apart, "runs", ["start", "windows"]).select("rid", "doc", "text", "runs")
                   .mapInArrow(_window_hashes, "rid bigint, doc bigint, start bigint, w1 bigint, w2 bigint"), "windows")
    belongs = land(windows.groupBy("w1", "w2").agg(first, F.max("doc").alias("hi")).where("hi > first.doc"), "first-windows")
    single = windows.join(belongs, ["w1", "w2"]).withColumn("windows", F.lit(1).cast("long"))
    columns = ["rid", "doc", "start", "windows", "first"]
    return classed.where("hi > first.doc").select(*columns).unionByName(single.select(*columns))


def repeats(texts: DataFrame) -> DataFrame:
    """rid, start, end of the words of `texts` (rid, doc, text) to be removed."""
    spark = texts.sparkSession
    own = (F.col("rid") == F.col("first.rid")) & (F.col("start") == F.col("first.start"))
    units = land(_units(texts).select(
        "rid", "doc", "start", "windows", own.alias("reference"),
        F.xxhash64("first.rid", F.shiftright("first.start", BLOCK_BITS)).alias("place"))
        .where(F.col("reference") | (F.col("doc") > F.col("first.doc"))), "units")
    words = units.where("reference").agg(F.sum("windows")).first()[0] or 0
    shards = max(1, math.ceil(words / SHARD_WORDS))
    units = units.withColumn("shard", F.pmod("place", F.lit(shards)))
    stretch = ["start", "windows", "shard", "reference"]
    text = land(_with_text(texts, units, "units", stretch).select("rid", "doc", "text", "units").mapInArrow(
        _words_of, "shard bigint, reference boolean, rid bigint, doc bigint, start bigint, words binary"), "stretches")
    automata = land(text.where("reference").select("shard", "rid", "start", "doc", "words").repartition("shard")
                    .sortWithinPartitions("shard", "rid", "start")
                    .mapInArrow(_build, "shard bigint, automaton binary"), "automata")
    load = units.where("NOT reference").groupBy("shard").agg(
        F.ceil(F.sum("windows") / PART_WORDS).cast("int").alias("copies"))
    load = land(load, "copies")
    nothing = F.lit(None)
    sent = automata.join(load, "shard").select(
        "shard", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"), "automaton",
        nothing.cast("long").alias("rid"), nothing.cast("long").alias("doc"), nothing.cast("long").alias("start"),
        nothing.cast("binary").alias("words"))
    held = text.where("NOT reference").join(load, "shard").select(
        "shard", F.pmod(F.xxhash64("rid", "start"), F.col("copies")).cast("int").alias("copy"),
        nothing.cast("binary").alias("automaton"), "rid", "doc", "start", "words")
    met = sent.unionByName(held).repartition("shard", "copy") \
        .sortWithinPartitions("shard", "copy", F.col("rid").asc_nulls_first())
    ship_package(spark)
    return met.mapInArrow(_match, "rid bigint, start bigint, end bigint")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the remaining words, joined by a space) of every document of
    `docs` (doc_id, text)."""
    ship_package(docs.sparkSession)
    texts = _bucketed(docs.select(
        F.monotonically_increasing_id().alias("rid"), "doc_id", "text",
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc")))
    found = land(repeats(texts), "repeats")
    return _with_text(texts, found, "spans", ["start", "end"], "left").select("doc_id", "text", "spans") \
        .mapInArrow(_cut, f"doc_id {dict(docs.dtypes)['doc_id']}, n_words bigint, n_removed bigint, kept string")
