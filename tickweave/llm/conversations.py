"""Repair of the turn structure of conversations by the auction shortest-path algorithm.

A conversation should read `(s?(ua)+)?` in the initials of its roles. Its rows and the four states
of that pattern make a lattice; arcs are edits with integer costs: Delete 4, Insert 3, Keep 0,
Rerole 3, and 3 more for a truncated row that stays. Blank and repeated rows can only go.

`_auction` finds the distances to the end: every node has a price, at most the cost of any arc and
the price behind it. A path starts at an origin; at its last node it is extended along a tight arc,
or, where no arc is tight, the node's price rises to the cheapest arc's and the path is contracted
by that node. Origins are taken from the last row to the first, and a path ends where it reaches a
node that an earlier one has settled, so the work is linear in the rows. Afterwards an arc is tight
exactly where it lies on a cheapest path, and the least audit follows the tight arc of the
ASCII-least initial from node to node.

Long conversations are cut into segments of at most SEGMENT rows. Those of one that has several
are solved apart: the costs between a segment's four entry and four exit states, from the auction,
are composed backwards along the conversation (sorted, four numbers carried), which gives the
prices at each segment's end; with them each segment is traced from all four states, and a pass
forwards takes the trace of the state in which a segment is entered. No task holds more than a
segment. Only the digest of a whole conversation passes one task, as a stream: SHA-256 is one chain.

Defined results: a null conv_id is a conversation of its own; in the damage's key, role and text a
null reads as one space. Rows of one turn stand in order of role and MD5 of the text; repeated rows
are duplicates; columns but conv_id, turn, role and text are not looked at and may have any names.
A conversation without rows has zeros and an empty audit. An empty table gives empty results."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from .common import land, ship_package

SEGMENT_BITS = 12
SEGMENT = 1 << SEGMENT_BITS
INF = 1 << 60
WHITE = " \t\n\x0b\x0c\r"

# fixed values: states, 0 start, 1 after system, 2 after user, 3 after assistant
NEXT = (2, 2, 3, 2)                                    # of a rerole or an insert
KEEP = ({0: 1, 1: 2}, {1: 2}, {2: 3}, {1: 2})          # state -> initial (s u a other: 0..3) -> state
ROLE = {2: "user", 3: "assistant"}
ACCEPT = (0, INF, INF, 0)
LEGAL = {(0, 1), (1, 2), (2, 1)}
OK, BLANK, DUPLICATE, TRUNCATED = range(4)


def _arcs(initial: int, fault: int, q: int) -> tuple:
    """(label, cost, rows passed, next state) of state q before a row, in order of label."""
    out = [("D", 4, 1, q), ("I", 3, 0, NEXT[q])]
    if fault in (OK, TRUNCATED):
        more = 3 if fault == TRUNCATED else 0
        if initial in KEEP[q]:
            out.append(("K", more, 1, KEEP[q][initial]))
        out.append(("R", 3 + more, 1, NEXT[q]))
    return tuple(out)


ARCS = [[_arcs(c >> 2, c & 3, q) for q in range(4)] for c in range(16)]
LAST = [(("I", 3, 0, NEXT[q]),) for q in range(4)]     # behind the last row of a conversation
NONE = [()] * 4                                        # behind a segment: the next one inserts


def _code(row: str) -> int:
    return ord(row) - 65


def _auction(codes: str, ends, last: bool) -> list[list[int]]:
    """Prices of the lattice, the distances to the end: [row][state], INF where there is no way.
    `ends` are the prices of the four states behind the last row."""
    arcs = [ARCS[_code(c)] for c in codes] + [LAST if last else NONE]
    dead = ends[2] >= INF and ends[3] >= INF           # no way back from 2 and 3 to 0 and 1
    n = len(codes)
    price: list = [None] * (n + 1)
    settled = [[False] * 4 for _ in range(n + 1)]
    floor = min(ends)
    for at in range(n, -1, -1):
        price[at] = [floor] * 4
        if dead:
            price[at][2] = price[at][3] = INF
            settled[at][2] = settled[at][3] = True
        for origin in range(4):
            path = [(at, origin)]
            while not settled[at][origin]:
                i, q = path[-1]
                best, to = (ends[q], None) if i == n else (INF, None)
                for _, cost, step, r in arcs[i][q]:
                    if cost + price[i + step][r] < best:
                        best, to = cost + price[i + step][r], (i + step, r)
                if price[i][q] < best:                 # contract
                    price[i][q] = best
                    if len(path) > 1:
                        path.pop()
                    elif best >= INF:
                        settled[i][q] = True
                elif best >= INF or to is None or settled[to[0]][to[1]]:
                    for i, q in path:
                        settled[i][q] = True
                else:                                  # extend
                    path.append(to)
        floor = min(price[at])
    return price


def _trace(codes: str, price, entry: int, last: bool) -> tuple[str, int]:
    """The ASCII-least string of tight arcs from `entry`, and the state in which it ends. Behind the
    last row an end that is tight comes first: equal strings have equal costs, so there is no choice."""
    out, i, q, n = [], 0, entry, len(codes)
    while True:
        arcs = ARCS[_code(codes[i])][q] if i < n else LAST[q] if last and ACCEPT[q] else ()
        for label, cost, step, r in arcs:
            if cost + price[i + step][r] == price[i][q]:
                out.append(label)
                i, q = i + step, r
                break
        else:
            return "".join(out), q


def _illegal(codes: str) -> int:
    initials = [_code(c) >> 2 for c in codes]
    return sum((x, y) not in LEGAL for x, y in zip(initials, initials[1:]))


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with the planted faults: by crc32(`conv_id:turn`) % 20, 0 drops a
    row, 1 empties its text, 2 takes out `.!?`, 3 repeats it, 4 makes it a user's."""
    def known(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn")).cast("binary")) % 20
    text = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate("_text", ".!?", "")) \
        .otherwise(F.col("_text"))
    role = F.when(F.col("_kind") == 4, "user").otherwise(F.col("_role"))
    copies = F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return conversations.select("conv_id", "turn", known("role").alias("_role"), known("text").alias("_text"),
                                kind.alias("_kind")) \
        .where("_kind <> 0") \
        .select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("_copy")) \
        .drop("_copy")


def ordered_rows(rows: DataFrame) -> DataFrame:
    """Landed rows of conversations with `at`, increasing along every conversation, `seg` (at most
    SEGMENT rows of one conversation have the same) and `same`, the text's MD5. Ranges cut
    conversations of any size; equal rows, which may change places, are dealt by a salt."""
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(1024))
    keyed = rows.withColumn("same", F.unhex(F.md5(F.col("text").cast("binary")))).withColumn("_salt", salt)
    order = ["conv_id", "turn", "role", "same", "_salt"]
    laid = keyed.repartitionByRange(*order).sortWithinPartitions(*order).drop("_salt") \
        .withColumn("at", F.monotonically_increasing_id())
    return land(laid.withColumn("seg", F.shiftright("at", SEGMENT_BITS)), "turns")


def _null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join on keys that may be null, without the right side's keys."""
    other = right.select(*[F.col(c).alias(f"_r_{c}" if c in keys else c) for c in right.columns])
    on = [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in keys]
    return left.join(other, on, how).drop(*[f"_r_{c}" for c in keys])


def _segments(rows: DataFrame) -> DataFrame:
    """conv_id, seg and codes (a letter for each row: initial and fault)."""
    group = ["conv_id", "role", "same"]
    first = rows.groupBy(*group).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")) \
        .where("n > 1").drop("n")
    bare = F.rtrim(F.col("text"), F.lit(WHITE))
    flat = rows.select("conv_id", "seg", "at", "role", "same", (bare == "").alias("blank"),
                       F.right(bare, F.lit(1)).isin(".", "!", "?").alias("closed"))
    fault = F.when(F.col("blank"), BLANK).when(F.col("at") > F.col("first"), DUPLICATE) \
        .when(~F.col("closed"), TRUNCATED).otherwise(OK)
    initial = F.when(F.left("role", F.lit(1)) == "s", 0).when(F.left("role", F.lit(1)) == "u", 1) \
        .when(F.left("role", F.lit(1)) == "a", 2).otherwise(3)
    coded = _null_safe(flat, first, group, "left") \
        .select("conv_id", "seg", F.struct("at", F.char(65 + initial * 4 + fault).alias("code")).alias("c"))
    return coded.groupBy("conv_id", "seg").agg(F.array_sort(F.collect_list("c")).alias("c")) \
        .select("conv_id", "seg", F.array_join(F.col("c.code"), "").alias("codes"))


def _rows_of(batches, *columns):
    for b in batches:
        yield from zip(*[b.column(c).to_pylist() for c in columns])


def _map(df: DataFrame, added: dict[str, str], work, reads: list[str]) -> DataFrame:
    """`df` with columns `added`: `work` takes an iterator of tuples of `reads`, in order, and yields
    a tuple for each of them."""
    ship_package(df.sparkSession)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema]
                       + [f"{c} {t}" for c, t in added.items()])

    def run(batches):
        waiting = []

        def read():
            for b in batches:
                for at in range(0, b.num_rows, 1024):
                    waiting.append(part := b.slice(at, 1024))
                    yield from _rows_of([part], *reads)

        made = []
        for row in work(read()):
            made.append(row)
            if len(made) == waiting[0].num_rows:
                part = waiting.pop(0)
                yield pa.RecordBatch.from_arrays(
                    part.columns + [pa.array(c, _ARROW[t]) for c, t in zip(zip(*made), added.values())],
                    part.schema.names + list(added))
                made = []

    return df.mapInArrow(run, schema)


_ARROW = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "array<bigint>": pa.list_(pa.int64()),
          "array<int>": pa.list_(pa.int32()), "array<string>": pa.list_(pa.string())}


def _solve_whole(rows):
    for (codes,) in rows:
        price = _auction(codes, ACCEPT, True)
        yield _trace(codes, price, 0, True)[0], 0, price[0][0], _illegal(codes)


def _crossings(rows):
    for codes, last in rows:
        costs = []
        for out in range(4):
            if last:
                price = _auction(codes, ACCEPT, True) if out == 0 else None
                costs.append([p for p in price[0]] if price else [INF] * 4)
            else:
                costs.append(_auction(codes, [0 if q == out else INF for q in range(4)], False)[0])
        yield ([min(INF, costs[out][q]) for q in range(4) for out in range(4)],)


def _backwards(rows):
    """Rows of a conversation from its last segment to its first."""
    key, after = object(), None
    for conv, cross, last in rows:
        if conv != key or last:
            key, after = conv, (0, INF, INF, INF)      # the last segment's costs are those to the end
        ends = list(ACCEPT) if last else after
        yield list(ends), min(INF, min(cross[o] + after[o] for o in range(4)))
        after = [min(INF, min(cross[4 * q + o] + after[o] for o in range(4))) for q in range(4)]


def _solve_parts(rows):
    for codes, last, ends in rows:
        price = _auction(codes, ends, last)
        traced = [_trace(codes, price, q, last) if price[0][q] < INF else ("", 0) for q in range(4)]
        yield [t for t, _ in traced], [q for _, q in traced], _illegal(codes)


def _forwards(rows):
    key, state, before = object(), 0, None
    for conv, codes, audits, exits, start in rows:
        if conv != key or start:
            key, state, before = conv, 0, None
        first = _code(codes[0]) >> 2
        yield audits[state], state, int(before is not None and (before, first) not in LEGAL)
        state, before = exits[state], _code(codes[-1]) >> 2


def solve(rows: DataFrame) -> DataFrame:
    """Cheapest edits of `ordered_rows`: a landed row for each segment with conv_id, seg, codes, audit,
    entry (state), cost (of the whole conversation, in its first segment; else 0) and illegal."""
    segs = land(_segments(rows), "segments")
    parts = segs.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), F.min("seg").alias("lo"),
                                        F.max("seg").alias("hi"))
    marked = land(_null_safe(segs, parts, ["conv_id"], "inner"), "marked")
    whole = _map(marked.where("n = 1").drop("n", "lo", "hi"),
                 {"audit": "string", "entry": "int", "cost": "bigint", "illegal": "bigint"}, _solve_whole, ["codes"])

    cut = marked.where("n > 1").select("conv_id", "seg", "codes", (F.col("seg") == F.col("lo")).alias("start"),
                                       (F.col("seg") == F.col("hi")).alias("last"))
    cross = _map(cut, {"cross": "array<bigint>"}, _crossings, ["codes", "last"])
    ends = _map(cross.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("seg")),
                {"ends": "array<bigint>", "total": "bigint"}, _backwards, ["conv_id", "cross", "last"]).drop("cross")
    traced = _map(ends.repartition("conv_id", "seg"),
                  {"audits": "array<string>", "exits": "array<int>", "inner": "bigint"}, _solve_parts,
                  ["codes", "last", "ends"])
    chosen = _map(traced.repartition("conv_id").sortWithinPartitions("conv_id", "seg"),
                  {"audit": "string", "entry": "int", "outer": "bigint"}, _forwards,
                  ["conv_id", "codes", "audits", "exits", "start"])
    joined = chosen.select("conv_id", "seg", "codes", "audit", "entry",
                           F.when(F.col("start"), F.col("total")).otherwise(0).cast("long").alias("cost"),
                           (F.col("inner") + F.col("outer")).alias("illegal"))
    return land(whole.unionByName(joined), "edits")


def report(rows: DataFrame, pieces: DataFrame) -> DataFrame:
    """One row for each conversation with rows: conv_id, gaps, blank, duplicate, truncated, illegal,
    cost, audit."""
    turns = rows.groupBy("conv_id").agg((F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"))
                                        .alias("gaps"))

    def count(fault):
        letters = "".join(chr(65 + 4 * i + fault) for i in range(4))
        return F.sum(F.length("codes") - F.length(F.translate("codes", letters, ""))).alias(
            ("", "blank", "duplicate", "truncated")[fault])

    edits = pieces.groupBy("conv_id").agg(
        count(BLANK), count(DUPLICATE), count(TRUNCATED), F.sum("illegal").alias("illegal"),
        F.sum("cost").alias("cost"), F.array_sort(F.collect_list(F.struct("seg", "audit"))).alias("_a"))
    return _null_safe(edits, turns, ["conv_id"], "inner").select(
        "conv_id", F.coalesce("gaps", F.lit(0)).cast("long").alias("gaps"), "blank", "duplicate", "truncated",
        "illegal", "cost", F.array_join(F.col("_a.audit"), "").alias("audit"))


def _edited(rows):
    """Rows (conv, seg, audit, entry, role, text), a segment's piece before its rows, in order ->
    (conv, seg, role, text, edit) of every line that stays or comes."""
    conv = seg = None
    audit, at, state, initials = "", 0, 0, ""

    def insert():
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            at, state = at + 1, NEXT[state]
            yield conv, seg, ROLE[state], "", "I"

    for c, s, piece, entry, role, text in rows:
        if piece is not None:
            conv, seg, audit, at, state = c, s, piece, 0, entry
            yield from insert()
            continue
        edit = audit[at]
        at += 1
        if edit == "R":
            state = NEXT[state]
            role = ROLE[state]
        elif edit == "K":
            state = KEEP[state]["sua".index(role[0])]
        if edit != "D":
            yield conv, seg, role, text, edit
        yield from insert()


def _together(rows: DataFrame, pieces: DataFrame, keys: list[str], kind: str) -> DataFrame:
    """Pieces and rows dealt by `keys`, a segment's piece before its rows."""
    nothing = F.lit(None)
    both = pieces.select(F.col("conv_id").cast(kind).alias("conv_id"), "seg", F.lit(-1).cast("long").alias("at"),
                         "audit", "entry", nothing.cast("string").alias("role"), nothing.cast("string").alias("text")) \
        .unionByName(rows.select(F.col("conv_id").cast(kind).alias("conv_id"), "seg", "at",
                                 nothing.cast("string").alias("audit"), nothing.cast("int").alias("entry"), "role", "text"))
    return both.repartition(*keys).sortWithinPartitions("conv_id", "seg", "at")


def _read(batches):
    return _rows_of((b.slice(k, 256) for b in batches for k in range(0, b.num_rows, 256)),
                    "conv_id", "seg", "audit", "entry", "role", "text")


def repaired(rows: DataFrame, pieces: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, seg, place (order within a segment), role, text, edit
    (initial). Dealt by segment, so that a conversation of any size is many tasks' work."""
    ship_package(rows.sparkSession)
    kind = dict(rows.dtypes)["conv_id"]

    def run(batches):
        out, last, place = [], object(), 0
        for conv, seg, role, text, edit in _edited(_read(batches)):
            place = place + 1 if (conv, seg) == last else 0
            last = (conv, seg)
            out.append((conv, seg, place, role, text, edit))
            if len(out) == 256:
                yield _batch(out, schema)
                out = []
        if out:
            yield _batch(out, schema)

    schema = _schema([("conv_id", kind), ("seg", "bigint"), ("place", "bigint"), ("role", "string"),
                      ("text", "string"), ("edit", "string")])
    return _together(rows, pieces, ["conv_id", "seg"], kind).mapInArrow(
        run, f"conv_id {kind}, seg bigint, place bigint, role string, text string, edit string")


def _schema(fields: list[tuple[str, str]]) -> pa.Schema:
    return pa.schema([(n, to_arrow_type(DataType.fromDDL(t))) for n, t in fields])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


def digests(rows: DataFrame, pieces: DataFrame) -> DataFrame:
    """conv_id and repaired_sha256, of the repaired `role:text` lines joined by newlines, for each
    conversation with rows. A conversation streams through one task, a line at a time."""
    ship_package(rows.sparkSession)
    kind = dict(rows.dtypes)["conv_id"]

    def run(batches):
        seen: list = []                                # conversations whose rows have begun to come

        def noted():
            for row in _read(batches):
                if not seen or seen[-1][0] != row[0]:
                    seen.append([row[0], hashlib.sha256(), b""])
                yield row

        for _, _, role, text, _ in _edited(noted()):
            now = seen[-1]
            now[1].update(now[2] + f"{role}:{text}".encode())
            now[2] = b"\n"
            if len(seen) > 1024:
                yield _batch([(c, h.hexdigest()) for c, h, _ in seen[:-1]], schema)
                del seen[:-1]
        if seen:
            yield _batch([(c, h.hexdigest()) for c, h, _ in seen], schema)

    schema = _schema([("conv_id", kind), ("repaired_sha256", "string")])
    return _together(rows, pieces, ["conv_id"], kind).mapInArrow(run, f"conv_id {kind}, repaired_sha256 string")


EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def audit(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """Report and digest of every conv_id of `conversations`, whose rows (of any number) are `rows`."""
    laid = ordered_rows(rows)
    pieces = solve(laid)
    told = _null_safe(report(laid, pieces), digests(laid, pieces), ["conv_id"], "inner")
    every = _null_safe(conversations.select("conv_id").distinct(), told, ["conv_id"], "left")
    zeros = [F.coalesce(c, F.lit(0)).cast("long").alias(c)
             for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return every.select("conv_id", *zeros, F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("repaired_sha256", F.lit(EMPTY_SHA256)).alias("repaired_sha256"))
