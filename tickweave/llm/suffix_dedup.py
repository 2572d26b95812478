"""Removal of long repeated byte strings by suffix arrays.

Every byte goes that lies in a string of LENGTH bytes which also starts in a document of a smaller
id. Documents are packed into text shards. Each window of LENGTH bytes has an anchor, the
leftmost of its GRAM-byte strings with the least hash, so equal windows have equal anchors and
about one position in twenty is an anchor. The text between a run's first window and the end of
its last, the windows that share an anchor, is a span.

1. Shards send the sorted hashes of their anchors to content shards (ranges of hashes), which
   merge them and tell each shard which of its own occur in another.
2. A shard finds those among its anchors by binary search and sends their spans, of equal ones those
   of the least document. Everything else of the text stays where it is.
3. A content shard sorts the suffixes of its distinct spans (Larsson-Sadakane: groups of equal
   prefixes are split by the ranks of the positions behind them, doubling the length), takes the
   common prefixes of neighbours in Kasai's order, and so has the classes of equal windows. A
   window goes where its class has a document smaller than the span's.
4. Shards cut what was found out of their documents.

Both kinds of shard hold a fixed number of bytes, so their number grows with the input. What a
hot passage sends is a span per text shard, not per document."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import land, ship_package, slices

LENGTH = 50
GRAM = 16
SHARD_BYTES = 1 << 21
CHUNK = 1 << 19          # window starts that are worked on at a time
POSITION_BITS = 22       # of a packed (hash, position): a chunk with its last window fits
NO_ID = (1 << 63) - 1    # a null id: after all others, and never smaller than another null


def _words(buf: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position on, as big-endian numbers (order is that of the bytes); the
    buffer counts as followed by zeros."""
    n = len(buf)
    padded = np.concatenate([buf, np.zeros(16, np.uint8)])
    out = np.empty(n, np.uint64)
    for k in range(min(8, n)):
        part = out[k::8]
        part[:] = padded[k:k + 8 * len(part)].view(">u8")
    return out


def runs(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """The runs of windows with one anchor, over documents buf[starts[k]:ends[k]]: anchor hash, first
    window's start, number of windows."""
    hashes, firsts, counts = [], [], []
    valid = np.ones(len(buf), bool)
    for s, e in zip(starts.tolist(), ends.tolist(), strict=True):
        valid[max(s, e - LENGTH + 1):e] = False
    grams = LENGTH - GRAM + 1
    for at in range(0, len(buf), CHUNK):
        some = buf[at:at + CHUNK + LENGTH - 1]
        if len(some) < LENGTH:
            break
        w = _words(np.concatenate([some, np.zeros(8, np.uint8)]))
        h = w[:len(some)] * np.uint64(0x9E3779B97F4A7C15) + w[8:] * np.uint64(0xC2B2AE3D27D4EB4F)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
        low = np.uint64((1 << POSITION_BITS) - 1)
        m = (h & ~low) | np.arange(len(h), dtype=np.uint64)
        width = 1
        while 2 * width <= grams:
            m = np.minimum(m[:len(m) - width], m[width:])
            width *= 2
        if width < grams:
            m = np.minimum(m[:len(m) - (grams - width)], m[grams - width:])
        first = np.flatnonzero(valid[at:at + CHUNK][:len(m)])
        if not len(first):
            continue
        anchor = (m[first] & low).astype(np.int64)
        new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (first[1:] != first[:-1] + 1)])
        begin = np.flatnonzero(new)
        hashes.append(h[anchor[begin]])
        firsts.append(first[begin] + at)
        counts.append(np.diff(np.concatenate([begin, [len(first)]])))
    if not hashes:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(hashes), np.concatenate(firsts), np.concatenate(counts)


def suffix_order(text: np.ndarray) -> np.ndarray:
    """The suffix array (of fewer than 2^31 positions). Larsson-Sadakane: positions are grouped by their first 8 bytes; groups that
    are not yet single are split by the groups of the positions `h` on, and `h` doubles."""
    n = len(text)
    key = _words(text)
    sa = np.argsort(key, kind="stable").astype(np.int32)
    key = key[sa]
    head = np.concatenate([[True], key[1:] != key[:-1]])  # the first of a group
    del key
    rank = np.empty(n + 1, np.int32)
    rank[n] = -1  # the end, before everything
    starts = np.flatnonzero(head)
    rank[sa] = np.repeat(starts, np.diff(np.append(starts, n)))
    open_ = np.flatnonzero(~head | np.append(~head[1:], False))
    h = 8
    while len(open_):
        at = sa[open_]
        behind = at + np.int64(h)
        past = np.clip(behind - n, 0, 8)  # in the first round: of such equals the shorter comes first
        packed = rank[at] * np.int64(n + 16) + rank[np.minimum(behind, n)] + 9 - past
        del behind, past
        order = np.argsort(packed, kind="stable")
        at, packed = at[order], packed[order]
        sa[open_] = at
        new = np.concatenate([[True], packed[1:] != packed[:-1]])
        head[open_] = new
        first = np.flatnonzero(new)
        rank[at] = np.repeat(open_[first], np.diff(np.append(first, len(at))))
        single = new & np.append(new[1:], True)
        open_ = open_[~single]
        h *= 2
    return sa


def common_prefixes(text: np.ndarray, sa: np.ndarray, starts: np.ndarray, lengths: np.ndarray,
                    most: int) -> np.ndarray:
    """The common prefix, up to `most`, of each suffix with the one before it in order. Kasai: in text
    order a suffix shares at most one byte less than the suffix one position before; the spans
    (starts, lengths) of the text go side by side."""
    n = len(text)
    before = np.empty(n, np.int32)
    before[sa[1:]] = sa[:-1]
    before[sa[0]] = -1
    lcp = np.zeros(n, np.int8 if most < 128 else np.int32)
    # past the end two different bytes, so that nothing is shared there
    padded = np.concatenate([text.astype(np.int16), np.full(most + 1, -1, np.int16)])
    shared = np.zeros(len(starts), np.int64)
    by_length = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[by_length], lengths[by_length]
    for k in range(int(lengths.max(initial=0))):
        live = int(np.searchsorted(-lengths, -k, "left"))  # spans longer than k
        at = starts[:live] + k
        other = before[at]
        have = np.maximum(shared[:live] - 1, 0)
        have[other < 0] = 0
        going = np.flatnonzero((other >= 0) & (have < most))
        while len(going):
            c = have[going]
            a, b = padded[at[going] + c], padded[other[going] + c]
            going = going[(a == b) & (a >= 0)]
            have[going] += 1
            going = going[have[going] < most]
        shared[:live] = have
        lcp[at] = have
    return lcp[sa]


def classes(text: np.ndarray, starts: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The window starts of all spans (span k has `windows[k]` of them from starts[k] on) and the
    number of each one's class: equal if the LENGTH bytes are."""
    at = np.repeat(starts - np.cumsum(windows) + windows, windows) + np.arange(int(windows.sum()))
    sa = suffix_order(text)
    lcp = common_prefixes(text, sa, starts, windows + LENGTH - 1, LENGTH)
    listed = np.zeros(len(text), bool)
    listed[at] = True
    places = np.flatnonzero(listed[sa])
    # between two listed suffixes the least common prefix on the way counts
    least = np.minimum.reduceat(lcp, np.append(0, places[:-1] + 1)) if len(places) else lcp[:0]
    new = least < LENGTH
    if len(new):
        new[0] = True
    number = np.empty(len(text), np.int64)
    number[sa[places]] = np.cumsum(new) - 1
    return at, number[at]


def _intervals(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of consecutive numbers in sorted ranges, merged: begin and end (exclusive)."""
    if not len(first):
        return first, last
    order = np.argsort(first, kind="stable")
    first, last = first[order], np.maximum.accumulate(last[order])
    new = np.concatenate([[True], first[1:] > last[:-1]])
    begin = np.flatnonzero(new)
    return first[begin], last[np.append(begin[1:], len(first)) - 1]


def _groups(values: np.ndarray) -> list[tuple[int, int]]:
    """Begin and end of each run of equal values."""
    if not len(values):
        return []
    begin = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    return list(zip(begin.tolist(), [*begin[1:].tolist(), len(values)], strict=True))


def _ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All positions of the ranges, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - ends + lengths, lengths)


def _blob(a: np.ndarray, dtype: str) -> bytes:
    return a.astype(dtype).tobytes()


class Shard:
    """A text shard as a task sees it."""

    def __init__(self, row: dict):
        import zstandard
        self.ids = np.frombuffer(row["ids"], "<i8")
        self.lengths = np.frombuffer(row["lengths"], "<i8")
        self.ends = np.cumsum(self.lengths)
        self.starts = self.ends - self.lengths
        self.raw = zstandard.decompress(row["text"])
        self.buf = np.frombuffer(self.raw, np.uint8)

    def runs(self):
        return runs(self.buf, self.starts, self.ends)

    def doc_of(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, positions, "right")


def _text_shards(docs: DataFrame, key: str, text: str, carry: list[str]) -> DataFrame:
    """Rows shard, ids, lengths, text (zstd), carried (an Arrow stream of other columns)."""
    own = docs.select(F.col(key).cast("long").alias("_id"), F.col(text).cast("string").alias("_text"),
                      *[F.col(c) for c in carry])

    def work(batches):
        import zstandard
        packer = zstandard.ZstdCompressor(level=3)
        number, held, size = TaskContext.get().partitionId() << 32, [], 0

        def row():
            ids = np.concatenate([h[0] for h in held])
            texts = [t for h in held for t in h[1]]
            sink = pa.BufferOutputStream()
            if carry:
                with pa.ipc.new_stream(sink, held[0][2].schema) as w:
                    for h in held:
                        w.write_batch(h[2])
            return pa.record_batch(
                [pa.array([number], pa.int64()), pa.array([_blob(ids, "<i8")], pa.binary()),
                 pa.array([_blob(np.array(list(map(len, texts)), np.int64), "<i8")], pa.binary()),
                 pa.array([packer.compress(b"".join(texts))], pa.binary()),
                 pa.array([packer.compress(sink.getvalue().to_pybytes())], pa.binary())],
                ["shard", "ids", "lengths", "text", "carried"])

        for b in slices(batches, 1000):
            ids = b["_id"].fill_null(NO_ID).to_numpy()
            texts = [(t or "").encode("utf-8", "surrogatepass") for t in b["_text"].to_pylist()]
            rest = b.select(carry) if carry else None
            begin = 0
            for i, t in enumerate(texts):
                size += len(t) + 64
                if size >= SHARD_BYTES or i + 1 == len(texts):
                    held.append((ids[begin:i + 1], texts[begin:i + 1],
                                 rest.slice(begin, i + 1 - begin) if carry else None))
                    begin = i + 1
                if size >= SHARD_BYTES:
                    yield row()
                    number, held, size = number + 1, [], 0
        if held:
            yield row()

    return own.mapInArrow(work, "shard bigint, ids binary, lengths binary, text binary, carried binary")


def _anchors(shards: DataFrame, buckets: int) -> DataFrame:
    """Rows bucket, shard, keys: the sorted hashes of a shard's anchors in a content shard, in 6 bytes
    (equal keys of different hashes only make a span be sent for nothing)."""
    def work(batches):
        for b in batches:
            for row in b.to_pylist():
                h = np.unique(Shard(row).runs()[0])
                yield _by_bucket(row["shard"], h % np.uint64(buckets), _keys(h, buckets))

    def _by_bucket(shard, bucket, keys):
        order = np.lexsort((keys, bucket))
        bucket, keys = bucket[order], keys[order]
        groups = _groups(bucket)
        return pa.record_batch(
            [pa.array([int(bucket[x]) for x, _ in groups], pa.int64()), pa.array([shard] * len(groups), pa.int64()),
             pa.array([_six(keys[x:y]) for x, y in groups], pa.binary())],
            ["bucket", "shard", "keys"])

    return shards.select("shard", "ids", "lengths", "text").mapInArrow(work, "bucket bigint, shard bigint, keys binary")


def _keys(h: np.ndarray, buckets: int) -> np.ndarray:
    return (h // np.uint64(buckets)) & np.uint64((1 << 48) - 1)


def _six(keys: np.ndarray) -> bytes:
    return keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _from_six(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def _shared(anchors: DataFrame) -> DataFrame:
    """Rows shard, bucket, keys: the anchors that another shard has too."""
    def work(table: pa.Table) -> pa.Table:
        bucket = table["bucket"][0].as_py()
        lists = [_from_six(k) for k in table["keys"].to_pylist()]
        keys = np.concatenate(lists)
        order = np.argsort(keys, kind="stable")
        same = keys[order[1:]] == keys[order[:-1]]  # a shard has a key once
        again = np.zeros(len(keys), bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        ends = np.cumsum([len(k) for k in lists]).tolist()
        rows = [(s, _six(keys[z - len(k):z][again[z - len(k):z]]))
                for s, k, z in zip(table["shard"].to_pylist(), lists, ends, strict=True)]
        rows = [r for r in rows if r[1]]
        return pa.table([pa.array([r[0] for r in rows], pa.int64()), pa.array([bucket] * len(rows), pa.int64()),
                         pa.array([r[1] for r in rows], pa.binary())], ["shard", "bucket", "keys"])

    return anchors.groupBy("bucket").applyInArrow(work, "shard bigint, bucket bigint, keys binary")


SPANS = ("shard bigint, bucket bigint, starts binary, windows binary, docs binary, text binary, "
         "first binary, last binary")


def _spans(shards: DataFrame, shared: DataFrame, buckets: int) -> DataFrame:
    """Per shard, a row for each content shard: the spans at shared anchors (start in the shard, windows,
    document, bytes as zstd), of equal ones those of the least document. One more row, for any
    content shard, has the byte ranges that a smaller document of the same shard decides."""
    def work(key, left: pa.Table, right: pa.Table) -> pa.Table:
        import zstandard
        if not left.num_rows:
            return pa.table([pa.array([], t) for t in (pa.int64(), pa.int64(), *[pa.binary()] * 6)],
                            ["shard", "bucket", "starts", "windows", "docs", "text", "first", "last"])
        shard, number = Shard(left.to_pylist()[0]), left["shard"][0].as_py()
        h, first, count = shard.runs()
        bucket, keys = (h % np.uint64(buckets)).astype(np.int64), _keys(h, buckets)
        # in a document of another shard: binary search in the merged lists
        wanted = np.zeros(len(h), bool)
        merged = {b: _from_six(k) for b, k in zip(right["bucket"].to_pylist(), right["keys"].to_pylist(), strict=True)}
        order = np.argsort(bucket, kind="stable")
        for x, y in _groups(bucket[order]):
            mine, theirs = order[x:y], merged.get(int(bucket[order[x]]))
            if theirs is not None and len(theirs):
                place = np.minimum(np.searchsorted(theirs, keys[mine]), len(theirs) - 1)
                wanted[mine] = theirs[place] == keys[mine]
        # in another document of this shard
        doc = shard.doc_of(first)
        order = np.lexsort((doc, h))
        same = h[order][1:] == h[order][:-1]
        wanted[order[1:][same]] = True
        wanted[order[:-1][same]] = True

        pick = np.flatnonzero(wanted)
        h, first, count, doc, bucket = h[pick], first[pick], count[pick], doc[pick], bucket[pick]
        ids, raw, size = shard.ids[doc], shard.raw, (count + LENGTH - 1)
        # one of each distinct span, that of the least document
        order = np.argsort(ids, kind="stable")
        known: dict[bytes, int] = {}
        owner = np.empty(len(pick), np.int64)
        for i, a, z in zip(order.tolist(), first[order].tolist(), (first + size)[order].tolist(), strict=True):
            owner[i] = known.setdefault(raw[a:z], i)
        del known
        later = ids > ids[owner]  # goes: the same span is in a smaller document here
        begin_, end_ = _intervals(first[later], (first + size)[later])
        rep = np.flatnonzero(~later)  # the least document's, each time it has it
        rep = rep[np.argsort(bucket[rep], kind="stable")]
        packer = zstandard.ZstdCompressor(level=3)
        cols = [[number], [number % buckets], [b""], [b""], [b""], [b""], [_blob(begin_, "<i8")], [_blob(end_, "<i8")]]
        for x, y in _groups(bucket[rep]):
            part = rep[x:y]
            for col, v in zip(cols, (number, int(bucket[part[0]]), _blob(first[part], "<u4") if len(raw) < 1 << 32
                                     else _blob(first[part], "<u8"), _blob(count[part], "u1"),
                                     _blob(ids[part], "<i8"),
                                     packer.compress(shard.buf[_ragged(first[part], size[part])].tobytes()),
                                     b"", b""), strict=True):
                col.append(v)
        return pa.table([pa.array(c, pa.int64() if k < 2 else pa.binary()) for k, c in enumerate(cols)],
                        ["shard", "bucket", "starts", "windows", "docs", "text", "first", "last"])

    return shards.groupBy("shard").cogroup(shared.groupBy("shard")).applyInArrow(work, SPANS)


RANGES = "shard bigint, first binary, last binary"


def _verdicts(spans: DataFrame) -> DataFrame:
    """Per content shard: the byte ranges of each text shard's spans that lie in a window which a
    smaller document has, and the ranges that were decided before."""
    def work(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        out = [(r["shard"], r["first"], r["last"]) for r in rows if not r["windows"]]
        out += _found([r for r in rows if r["windows"]])
        return pa.table([pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.binary()),
                         pa.array([r[2] for r in out], pa.binary())], ["shard", "first", "last"])

    def _found(rows: list[dict]) -> list[tuple]:
        import zstandard
        if not rows:
            return []
        names = [r["shard"] for r in rows]
        count = np.concatenate([np.frombuffer(r["windows"], np.uint8) for r in rows]).astype(np.int64)
        docs = np.concatenate([np.frombuffer(r["docs"], "<i8") for r in rows])
        starts = np.concatenate([np.frombuffer(r["starts"], f"<u{len(r['starts']) // len(r['windows'])}")
                                 .astype(np.int64) for r in rows])
        shard = np.repeat(np.arange(len(rows)), [len(r["windows"]) for r in rows])
        raw = b"".join(zstandard.decompress(r["text"]) for r in rows)
        del rows
        size = count + LENGTH - 1
        at = np.cumsum(size) - size
        known: dict[bytes, int] = {}
        owner = np.array([known.setdefault(raw[a:a + n], i) for i, (a, n) in
                          enumerate(zip(at.tolist(), size.tolist(), strict=True))], np.int64)
        del known
        rep = np.flatnonzero(owner == np.arange(len(owner)))
        least = np.full(len(owner), NO_ID, np.int64)
        np.minimum.at(least, owner, docs)
        text = np.frombuffer(raw, np.uint8)[_ragged(at[rep], size[rep])]
        begin = np.cumsum(size[rep]) - size[rep]
        _, number = classes(text, begin, count[rep])
        of_class = np.full(int(number.max(initial=-1)) + 1, NO_ID, np.int64)
        np.minimum.at(of_class, number, np.repeat(least[rep], count[rep]))
        # every span again, its own windows one after the other
        place = np.empty(len(owner), np.int64)
        place[rep] = np.cumsum(count[rep]) - count[rep]
        window = _ragged(place[owner], count)
        goes = of_class[number[window]] < np.repeat(docs, count)
        start = _ragged(starts, count)[goes]
        of_shard = np.repeat(shard, count)[goes]
        out = []
        for x, y in _groups(of_shard):  # in order of the rows
            begin_, end_ = _intervals(start[x:y], start[x:y] + LENGTH)
            out.append((names[of_shard[x]], _blob(begin_, "<i8"), _blob(end_, "<i8")))
        return out

    return spans.groupBy("bucket").applyInArrow(work, RANGES)


def _cut(shards: DataFrame, ranges: DataFrame, key: str, carried: list, as_text: bool) -> DataFrame:
    """One row per document: key, carried columns, n_bytes, n_removed, n_spans, kept."""
    names = [f.name for f in carried]
    schema = ", ".join([f"`{key}` bigint", *[f"`{f.name}` {f.dataType.simpleString()}" for f in carried],
                        "n_bytes bigint", "n_removed bigint", "n_spans bigint",
                        "kept string" if as_text else "kept binary"])

    def work(group, left: pa.Table, right: pa.Table) -> pa.Table:
        import zstandard
        rows = left.to_pylist()
        shard = Shard(rows[0])
        change = np.zeros(len(shard.buf) + 1, np.int32)
        for r in right.to_pylist():
            np.add.at(change, np.frombuffer(r["first"], "<i8"), 1)
            np.add.at(change, np.frombuffer(r["last"], "<i8"), -1)
        gone = np.cumsum(change[:-1], dtype=np.int32) > 0
        del change
        before = np.concatenate([[0], np.cumsum(gone)])
        rises = gone.copy()
        rises[1:] &= ~gone[:-1]
        inner = shard.starts[shard.starts < len(gone)]
        rises[inner] = gone[inner]
        rise = np.concatenate([[0], np.cumsum(rises)])
        removed = before[shard.ends] - before[shard.starts]
        kept = []
        for a, z, n in zip(shard.starts.tolist(), shard.ends.tolist(), removed.tolist(), strict=True):
            kept.append(shard.raw[a:z] if not n else shard.buf[a:z][~gone[a:z]].tobytes())
        columns = [pa.array(shard.ids, pa.int64(), mask=shard.ids == NO_ID)]
        if names:
            rest = pa.ipc.open_stream(zstandard.decompress(rows[0]["carried"])).read_all()
            columns += [rest[c].combine_chunks() for c in names]
        columns += [pa.array(shard.lengths), pa.array(removed), pa.array(rise[shard.ends] - rise[shard.starts]),
                    pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string()) if as_text else pa.array(kept, pa.binary())]
        return pa.table(columns, [key, *names, "n_bytes", "n_removed", "n_spans", "kept"])

    return shards.groupBy("shard").cogroup(ranges.groupBy("shard")).applyInArrow(work, schema)


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text",
                   carry: list[str] | None = None, as_text: bool = False,
                   bucket_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per row of `docs`: the key (as long), the `carry` columns, n_bytes, n_removed, n_spans
    (maximal removed runs) and kept: the remaining bytes, in which characters may be cut, or with
    `as_text` the text without cut characters.

    A null or empty text has no bytes; texts shorter than a window keep all; a null key counts as
    larger than every other; rows of one key do not remove from each other; an empty table gives
    an empty result. A text of any length is one shard's; work on it goes in chunks."""
    ship_package(docs.sparkSession)
    carry = [c for c in carry or [] if c not in (key, "n_bytes", "n_removed", "n_spans", "kept")]
    carried = [docs.schema[c] for c in carry]
    shards = land(_text_shards(docs, key, text, carry), "text-shards")
    total = shards.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, int(2.5 * total / bucket_bytes))
    shared = _shared(_anchors(shards, buckets))
    # both meetings with the shards are by the same exchange of them, which Spark makes once
    ranges = _verdicts(_spans(shards, shared, buckets))
    return _cut(shards, ranges, key, carried, as_text)
