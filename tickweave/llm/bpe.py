"""Byte-level BPE by prefix dynamic programming.

For every prefix of a piece's bytes exactly one token can end the prefix's encoding. It is found
from the shorter prefixes: of the tokens that end there, the one that may follow the last token
of the prefix before it. Two tokens may stand next to each other if merging their joint bytes
from scratch gives those two again; that depends on the pair alone and is remembered. The
encoding is read backwards from the last prefix. Since no prefix's entry depends on what
follows it, appending bytes is exact and costs the appended bytes, and an edit keeps the
entries before it.

Merge order is that of the ranks file: the lowest rank first, of equal ranks the leftmost; a
piece that is itself in the vocabulary is that token."""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import ship_package, slices

CACHE_ENTRIES = 600_000  # per Python worker; what comes later is worked out each time
SLICE = 256              # documents in an output batch
_WORKER: dict[tuple, "Codec"] = {}


def ranks_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def piece_pattern() -> str:
    """The public split pattern; white space by its Unicode property, without the control
    characters that Python adds."""
    import public_tokenizers
    return public_tokenizers.PATTERN.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")


class Vocabulary:
    def __init__(self, path: str):
        with open(path, "rb") as f:
            pairs = [line.split() for line in f if line.strip()]
        self.rank = {base64.b64decode(t): int(r) for t, r in pairs}
        self.bytes_of = {r: t for t, r in self.rank.items()}
        self.longest = max(map(len, self.rank))
        self._spines: dict[int, tuple] = {}
        self._follows: dict[tuple[int, int], bool] = {}

    def _halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes `token`; None for a byte, or for a token that merges
        never reach."""
        raw = self.bytes_of[token]
        parts = [raw[i:i + 1] for i in range(len(raw))]
        while len(parts) > 2:
            best = min(((self.rank.get(a + b, 1 << 40), i) for i, (a, b) in
                        enumerate(zip(parts, parts[1:], strict=False))))
            if best[0] == 1 << 40:
                return None
            i = best[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        if len(parts) < 2:
            return None
        return self.rank[parts[0]], self.rank[parts[1]]

    def spines(self, token: int) -> tuple[tuple, tuple, bool]:
        """The tokens at the left and at the right edge while `token` is built, last first, and
        whether merging reaches it."""
        known = self._spines.get(token)
        if known is None:
            halves = self._halves(token)
            if halves is None:
                known = ((token,), (token,), len(self.bytes_of[token]) == 1)
            else:
                left, right = self.spines(halves[0]), self.spines(halves[1])
                known = ((token, *left[0]), (token, *right[1]), left[2] and right[2])
            self._spines[token] = known
        return known

    def reached(self, token: int) -> bool:
        return self.spines(token)[2]

    def follows(self, first: int, second: int) -> bool:
        """Whether `first`, `second` stay apart when their joint bytes are merged from scratch."""
        known = self._follows.get((first, second))
        if known is None:
            known = self.reached(second) and self._apart(first, second)
            if len(self._follows) < CACHE_ENTRIES:
                self._follows[first, second] = known
        return known

    def _apart(self, first: int, second: int) -> bool:
        """Walks back through the states of the boundary. A state's two tokens would merge if the
        merge ranks before the one that replaces the left token (it lies to the left, so it
        also wins a tie) and not after the one that replaces the right token."""
        left, right = self.spines(first)[1], self.spines(second)[0]
        rank, raw = self.rank, self.bytes_of
        a = b = 0
        while True:
            merged = rank.get(raw[left[a]] + raw[right[b]])
            if merged is not None and (a == 0 or merged < left[a - 1]) \
                    and (b == 0 or merged <= right[b - 1]):
                return False
            # the later born of the two is undone first; a byte is never undone
            can_left, can_right = a + 1 < len(left), b + 1 < len(right)
            if can_left and (not can_right or left[a] > right[b]):
                a += 1
            elif can_right:
                b += 1
            else:
                return True


class PrefixTokens:
    """The last token of every prefix of some bytes."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", []
        self.append(data)

    def append(self, data: bytes) -> None:
        """Exact: entries of earlier prefixes stay."""
        v, begin = self.vocabulary, len(self.data)
        self.data += data
        raw, last, get, known = self.data, self.last, v.rank.get, v._follows
        for end in range(begin + 1, len(raw) + 1):
            for start in range(max(0, end - v.longest), end):  # a long one is the likeliest
                token = get(raw[start:end])
                if token is None:
                    continue
                if start == 0:
                    fits = v.reached(token)
                else:
                    pair = last[start - 1], token
                    fits = known[pair] if pair in known else v.follows(*pair)
                if fits:
                    last.append(token)
                    break
            else:
                raise ValueError("the vocabulary lacks a byte")

    def splice(self, start: int, end: int, data: bytes) -> None:
        """Replace bytes start .. end - 1; entries before `start` are kept."""
        rest = data + self.data[end:]
        self.data, self.last = self.data[:start], self.last[:start]
        self.append(rest)

    def ids(self) -> list[int]:
        whole = self.vocabulary.rank.get(self.data)
        if whole is not None:
            return [whole]
        out, end = [], len(self.data)
        while end:
            out.append(self.last[end - 1])
            end -= len(self.vocabulary.bytes_of[out[-1]])
        return out[::-1]


class _Chunks(dict):
    """Ids (little-endian unsigned 32-bit) of a piece."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary

    def __missing__(self, piece: str) -> bytes:
        raw = piece.encode("utf-8", "surrogatepass")
        token = self.vocabulary.rank.get(raw)
        ids = [token] if token is not None else PrefixTokens(self.vocabulary, raw).ids()
        out = np.array(ids, "<u4").tobytes()
        if len(self) < CACHE_ENTRIES:
            self[piece] = out
        return out


class Codec:
    def __init__(self, path: str, pattern: str):
        import regex
        self.vocabulary = Vocabulary(path)
        self.split = regex.compile(pattern).findall
        self.pieces = _Chunks(self.vocabulary)

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.pieces.__getitem__, self.split(text))), "<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.vocabulary.bytes_of.__getitem__, ids.tolist()))

    def reencode(self, text: str, ids: np.ndarray, start: int, end: int, new: str) -> tuple[str, np.ndarray]:
        """The text with characters start .. end - 1 replaced, and its ids: pieces well before and
        after the edit keep their ids, only those between are encoded again."""
        edited = text[:start] + new + text[end:]
        before, after = self.split(text), self.split(edited)
        same = 0
        while same < min(len(before), len(after)) and before[same] == after[same]:
            same += 1
        tail = 0
        while tail < min(len(before), len(after)) - same and before[-1 - tail] == after[-1 - tail]:
            tail += 1
        count = lambda pieces: sum(len(self.pieces[p]) // 4 for p in pieces)
        head_ids = count(before[:same])
        tail_ids = count(before[len(before) - tail:])
        middle = b"".join(self.pieces[p] for p in after[same:len(after) - tail])
        return edited, np.concatenate([ids[:head_ids], np.frombuffer(middle, "<u4"), ids[len(ids) - tail_ids:]])


def worker_codec(path: str, pattern: str) -> Codec:
    if (path, pattern) not in _WORKER:
        _WORKER[path, pattern] = Codec(path, pattern)
    return _WORKER[path, pattern]


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str | None = None,
           pattern: str | None = None, decoded: bool = False) -> DataFrame:
    """One row per document: the key and `ids` (little-endian unsigned 32-bit), and if asked
    `decoded`, the bytes that the ids stand for. A null or empty text has no ids; repeated rows
    are encoded each; an empty table stays empty; other columns are not read."""
    ship_package(docs.sparkSession)
    path, pattern = vocabulary or ranks_path(), pattern or piece_pattern()
    key_type = docs.schema[key].dataType.simpleString()
    names = [key, "ids"] + (["decoded"] if decoded else [])

    def work(batches):
        codec = worker_codec(path, pattern)
        for b in slices(batches, SLICE):
            ids = [codec.encode(t or "") for t in b["text"].to_pylist()]
            columns = [b[0], pa.array([i.tobytes() for i in ids], pa.binary())]
            if decoded:
                columns.append(pa.array(map(codec.decode, ids), pa.binary()))
            yield pa.record_batch(columns, names)

    rows = docs.select(F.col(key), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(work, f"`{key}` {key_type}, ids binary" + (", decoded binary" if decoded else ""))


def decode(encoded: DataFrame, ids: str = "ids", vocabulary: str | None = None,
           pattern: str | None = None, out: str = "decoded") -> DataFrame:
    """`encoded` with the bytes its ids stand for as column `out` (replaced if there); null ids give
    null."""
    ship_package(encoded.sparkSession)
    path, pattern = vocabulary or ranks_path(), pattern or piece_pattern()
    encoded = encoded.drop(out) if out in encoded.columns else encoded
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields)

    def work(batches):
        codec = worker_codec(path, pattern)
        for b in slices(batches, SLICE):
            raw = [None if i is None else codec.decode(np.frombuffer(i, "<u4")) for i in b[ids].to_pylist()]
            yield pa.record_batch([*b.columns, pa.array(raw, pa.binary())], [*b.schema.names, out])

    return encoded.mapInArrow(work, f"{schema}, `{out}` binary")


