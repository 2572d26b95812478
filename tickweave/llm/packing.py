"""Mixture-controlled packing by deficit round-robin over source queues.

Each source is a queue of its documents' tokens. Every round gives each queue credit in
proportion to its target share, and a slot goes to the queue with the largest deficit per share;
a window takes the next `window` slots and so holds the target mixture, with what a queue is
short of carried into the next window. When a queue runs dry the others share its slots.

Which slots a queue has had after h of them is an apportionment of h seats: it needs the queues'
shares and h, not the rounds before. So a task works out the windows of its own documents from
the queue totals alone, and deficits carry across windows and partitions without a pass over
them in order. Texts are tokenised once and landed; a queue's order is that of its partitions,
whose first places are prefix sums of token counts; no token is shuffled.

The driver holds one total per queue (the mixture), never one per document."""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from .common import land, ship_package, slices
from .tokens import bpe_json_path, worker_encoder

PIECES = ("doc_id {key}, source string, start bigint, length bigint, ids_crc32 bigint, "
          "doc_tokens bigint, sequence_id bigint, offset bigint")
SLICE_TOKENS = 1 << 20  # windows are worked out for this many tokens of a queue at a time


@dataclass(frozen=True)
class Phase:
    """From slot `first` on, with `served` tokens of each queue gone, the queues of share > 0
    are served until one of them runs dry."""

    first: int
    served: np.ndarray
    share: np.ndarray


class Schedule:
    """Slots served to each queue. totals: tokens by queue; targets: weights by queue (None: the
    totals, so that all queues end together)."""

    def __init__(self, totals: list[int], targets: list[float] | None = None):
        self.totals = np.array(totals, np.int64)
        weights = np.array(self.totals if targets is None else targets, float)
        if ((weights <= 0) & (self.totals > 0)).any():
            raise ValueError("a source with tokens needs a positive target")
        self.phases: list[Phase] = []
        served, first = np.zeros(len(self.totals), np.int64), 0
        while (left := self.totals - served).any():
            active = left > 0
            share = np.where(active, weights, 0.0)
            share = share / share.sum()
            self.phases.append(Phase(first, served, share))
            end = min(l / s for l, s in zip(left[active], share[active], strict=True))
            done = np.minimum(np.floor(end * share + 0.5).astype(np.int64), left)
            done[active & (left <= end * share * (1 + 1e-12) + 1e-9)] = \
                left[active & (left <= end * share * (1 + 1e-12) + 1e-9)]
            served = served + done
            first = int(served.sum())
        self.slots = first

    def served(self, h: np.ndarray) -> np.ndarray:
        """Tokens of each queue among the first h slots: a row for each h."""
        h = np.asarray(h, np.int64)
        out = np.empty((len(h), len(self.totals)), np.int64)
        at = np.searchsorted([p.first for p in self.phases], h, "right") - 1
        for k in np.unique(at):
            rows = np.flatnonzero(at == k)
            p = self.phases[k]
            out[rows] = p.served + self._seats(h[rows] - p.first, p, self.totals - p.served)
        return out

    def _seats(self, h: np.ndarray, p: Phase, most: np.ndarray) -> np.ndarray:
        """Divisor apportionment: seat c of a queue is due at (c + 1/2) / share, and the first h
        seats in order of (due, queue) are given. Seats given never shrink as h grows."""
        share = p.share
        live = share > 0
        safe = np.where(live, share, 1.0)
        c = np.minimum(np.floor(h[:, None] * share + 0.5).astype(np.int64), most)
        while True:  # a few rounds: the start is off by less than half a seat per queue
            short = h - c.sum(1)
            due_next = np.where(live & (c < most), (c + 0.5) / safe, np.inf)
            due_last = np.where(live & (c > 0), (c - 0.5) / safe, -np.inf)
            nxt = due_next.argmin(1)
            # of equally due seats the last queue's is given last
            last = len(share) - 1 - due_last[:, ::-1].argmax(1)
            r = np.arange(len(h))
            swap = (short == 0) & ((due_next[r, nxt] < due_last[r, last])
                                   | ((due_next[r, nxt] == due_last[r, last]) & (nxt < last)))
            give, take = (short > 0) | swap, (short < 0) | swap
            if not (give | take).any():
                return c
            c[r[give], nxt[give]] += 1
            c[r[take], last[take]] -= 1

    def windows_of(self, queue: int, first: int, end: int, size: int):
        """The windows that hold tokens first .. end - 1 of a queue: their numbers, the queue's
        tokens served before each (and after the last), and the slots that earlier queues have
        in each."""
        lo, hi = self._window(queue, first, size), self._window(queue, end - 1, size)
        w = np.arange(lo, hi + 1)
        bounds, head = [], []
        for at in range(lo, hi + 1, 4096):
            h = np.arange(at, min(at + 4096, hi + 1) + 1) * size
            served = self.served(np.minimum(h, self.slots))
            bounds.append(served[:-1, queue])
            head.append((served[1:, :queue] - served[:-1, :queue]).sum(1))
            after = served[-1:, queue]
        return w, np.concatenate([*bounds, after]), np.concatenate(head)

    def _window(self, queue: int, token: int, size: int) -> int:
        """The window of one token of a queue, by binary search."""
        lo, hi = 0, (self.slots - 1) // size
        while lo < hi:
            probes = np.unique(np.linspace(lo, hi - 1, 33).astype(np.int64))
            reached = self.served(np.minimum((probes + 1) * size, self.slots))[:, queue] > token
            k = int(reached.argmax()) if reached.any() else len(probes)
            if k < len(probes):
                hi = int(probes[k])
            if k:
                lo = int(probes[k - 1]) + 1
        return lo


def _tokenised(docs: DataFrame, key: str, text: str, source: str, path: str,
               end_id: int | None) -> DataFrame:
    """Per document its ids, its task's number and the tokens of its queue before it there."""
    key_type = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("doc_id"),
                       F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"),
                       F.col(text).cast("string").alias("text"))

    def encode(batches):
        enc = worker_encoder(path)
        tail = b"" if end_id is None else end_id.to_bytes(enc.width, "little")
        pid = TaskContext.get().partitionId()
        queued: dict[str, int] = {}
        for b in slices(batches, 512):
            ids = [enc.encode(t or "") + tail for t in b["text"].to_pylist()]
            n = [len(i) // enc.width for i in ids]
            before = []
            for s, k in zip(b["source"].to_pylist(), n, strict=True):
                before.append(queued.get(s, 0))
                queued[s] = before[-1] + k
            yield pa.record_batch(
                [b["doc_id"], b["source"], pa.array([pid] * len(n), pa.int64()),
                 pa.array(before, pa.int64()), pa.array(n, pa.int64()), pa.array(ids, pa.binary())],
                ["doc_id", "source", "pid", "before", "n_tokens", "ids"])

    return rows.mapInArrow(encode, f"doc_id {key_type}, source string, pid bigint, "
                                   "before bigint, n_tokens bigint, ids binary")


def pack(docs: DataFrame, window: int = 1024, targets: dict[str, float] | None = None,
         key: str = "doc_id", text: str = "text", source: str = "source",
         vocabulary: str | None = None, end_id: int | None = 0, with_ids: bool = False) -> DataFrame:
    """Pack all documents into windows of `window` tokens: one row per piece, with doc_id, source,
    start (the document's tokens before it), length, ids_crc32, doc_tokens, sequence_id and
    offset (gapless from 0 in the sequence), and with `with_ids` the ids.

    Every window is full but the last one. A null or empty text is its end token alone (without
    `end_id`, it has no piece); a null source is the queue of the empty name; repeated rows are
    packed each; an empty table gives an empty result; other columns are not read. A target
    must be given for every source or for none."""
    ship_package(docs.sparkSession)
    path = vocabulary or bpe_json_path()
    key_type = docs.schema[key].dataType.simpleString()
    tokens = land(_tokenised(docs, key, text, source, path, end_id).where("n_tokens > 0"), "tokens",
                  **{"compression": "snappy", "parquet.enable.dictionary": "false"})
    per_task = tokens.groupBy("pid", "source").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.partitionBy("source").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    places = land(per_task.withColumn("base", F.coalesce(F.sum("n").over(earlier), F.lit(0))),
                  "token-bases")  # a row per task and queue
    # one row per queue: the mixture itself
    totals = {r["source"]: r["n"] for r in places.groupBy("source").agg(F.sum("n").alias("n")).collect()}
    queues = sorted(totals)
    schedule = Schedule([totals[q] for q in queues],
                        None if targets is None else [targets.get(q, 0.0) for q in queues])
    number = {q: i for i, q in enumerate(queues)}
    schema = PIECES.format(key=key_type) + (", ids binary" if with_ids else "")
    arrow_schema = to_arrow_schema(StructType.fromDDL(schema))

    def cut(queue, run):
        """The pieces of documents that follow each other in a queue, as columns."""
        enc = worker_encoder(path)
        doc, first, n, raws = zip(*run, strict=True)
        begin, n = np.array(first, np.int64), np.array(n, np.int64)
        end = begin + n
        w, bounds, head = schedule.windows_of(number[queue], first[0], int(end[-1]), window)
        lo = np.searchsorted(bounds, begin, "right") - 1
        count = np.searchsorted(bounds, end, "left") - lo
        row = np.repeat(np.arange(len(run)), count)  # a row for each window a document reaches
        k = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(lo, count)
        a, z = np.maximum(begin[row], bounds[k]), np.minimum(end[row], bounds[k + 1])
        some = a < z  # a window may hold nothing of the queue
        row, k, a, z = row[some], k[some], a[some], z[some]
        wide = memoryview(np.frombuffer(b"".join(raws), enc.dtype).astype("<u4").tobytes())
        parts = [wide[x:y] for x, y in zip((4 * (a - first[0])).tolist(), (4 * (z - first[0])).tolist(),
                                           strict=True)]
        columns = [pa.array(doc, arrow_schema[0].type).take(pa.array(row)), pa.repeat(queue, len(row)),
                   a - begin[row], z - a, np.fromiter(map(zlib.crc32, parts), np.int64, len(row)),
                   n[row], w[k], head[k] + a - bounds[k]]
        return columns + ([pa.array(list(map(bytes, parts)), pa.binary())] if with_ids else [])

    def pieces(batches):
        for b in slices(batches, 5000):
            first = (b["base"].to_numpy() + b["before"].to_numpy()).tolist()
            source_, doc, n, ids = (b[c].to_pylist() for c in ("source", "doc_id", "n_tokens", "ids"))
            order = sorted(range(len(doc)), key=lambda i: (source_[i], first[i]))
            runs: list[tuple[str, list]] = []
            for i in order:
                queue, run = runs[-1] if runs else (None, None)
                if queue == source_[i] and run[-1][1] + run[-1][2] == first[i] \
                        and first[i] - run[0][1] < SLICE_TOKENS:
                    run.append((doc[i], first[i], n[i], ids[i]))
                else:
                    runs.append((source_[i], [(doc[i], first[i], n[i], ids[i])]))
            for queue, run in runs:
                yield pa.record_batch([pa.array(c, f.type) if isinstance(c, np.ndarray) else c
                                       for c, f in zip(cut(queue, run), arrow_schema, strict=True)],
                                      schema=arrow_schema)

    return tokens.join(places.drop("n"), ["pid", "source"]).mapInArrow(pieces, schema)
