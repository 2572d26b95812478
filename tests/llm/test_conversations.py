import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from tests.conftest import SF_CHECK
from tickweave.llm import conversations, queries

TURN = "conv_id bigint, turn bigint, role string, text string"
PATTERN = re.compile(r"(s?(ua)+)?\Z")


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def in_order(rows):
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).digest()))


def faults(rows):
    out, seen = [], set()
    for _, _, role, text in rows:
        bare = text.rstrip(" \t\n\x0b\x0c\r")
        out.append("blank" if not bare else "duplicate" if (role, text) in seen
                   else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, marks):
    """(cost, audit, lines) by recursion over what remains and the initials so far, with no lattice."""
    @lru_cache(None)
    def best(i, state):
        found = []
        if i == len(rows) and state in ("", "a"):
            found.append((0, "", ()))
        grow = {"": "us", "s": "u", "u": "a", "a": "u"}[state]
        for c in "ua":
            if c in grow and (state, c) != ("u", "u"):
                found.append(("I", 3, i, c, ("user:" if c == "u" else "assistant:",)))
        if i < len(rows):
            found.append(("D", 4, i + 1, state, ()))
            if marks[i] in ("", "truncated"):
                more = 3 if marks[i] else 0
                role, text = rows[i][2:]
                if role[:1] and role[0] in grow:
                    found.append(("K", more, i + 1, role[0], (f"{role}:{text}",)))
                for c in "ua":
                    if c in grow:
                        found.append(("R", 3 + more, i + 1, c, (f"{'user' if c == 'u' else 'assistant'}:{text}",)))
        return found

    # distances by repeated relaxation, then the least string among the cheapest
    nodes = [(i, s) for i in range(len(rows), -1, -1) for s in ("", "s", "u", "a")]
    value = {n: (10 ** 9, "", ()) for n in nodes}
    changed = True
    while changed:
        changed = False
        for n in nodes:
            for f in best(*n):
                if len(f) == 3:
                    got = f
                else:
                    cost, audit, lines = value[f[2], f[3]]
                    got = (f[1] + cost, f[0] + audit, f[4] + lines)
                if got[:2] < value[n][:2]:
                    value[n], changed = got, True
    return value[0, ""]


def brute(original):
    by = {}
    for r in original:
        by.setdefault(r[0], [])
    for r in damaged(original):
        by[r[0]].append(r)
    out = {}
    for conv, rows in by.items():
        rows = in_order(rows)
        marks = faults(rows)
        cost, audit, lines = cheapest(rows, marks)
        turns = [r[1] for r in rows if r[1] is not None]
        pairs = [a[2][:1] + b[2][:1] for a, b in zip(rows, rows[1:])]
        assert PATTERN.match("".join(x[0] for x in lines))
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
                     *(marks.count(k) for k in ("blank", "duplicate", "truncated")),
                     sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


FIELDS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def told(df):
    return {r.conv_id: tuple(r[f] for f in FIELDS) for r in df.collect()}


def made_up(rng, conversations_, longest):
    rows = []
    for c in range(conversations_):
        for t in range(rng.randint(1, longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rng.choice(["Yes.", "No!", "Why?", "and so", "", " \n", None, "é. ", "x" * 50 + ".", f"{t}."])
            rows.append((c if c else None, rng.choice([t, t, t, t + 2, None, t // 2]), role, text))
    rng.shuffle(rows)
    return rows


def test_query_on_given_table(spark):
    got = told(queries.QUERIES["op11_conversation_repair"](spark, SF_CHECK))
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_CHECK}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    assert got == brute(rows)


@pytest.mark.parametrize("bits", [12, 3, 1, 0])
def test_awkward_conversations_in_segments_of_any_size(spark, monkeypatch, bits):
    monkeypatch.setattr(conversations, "SEGMENT_BITS", bits)
    rows = made_up(random.Random(7), 60, 9) + [(99, t, "user" if t % 3 else "assistant", f"{t}{'.' * (t % 2)}")
                                               for t in range(120)]
    turns = spark.createDataFrame(rows, TURN)
    assert told(conversations.audit(turns, conversations.damage(turns))) == brute(rows)


def test_dropped_repeated_and_empty_tables(spark):
    gone = next(i for i in range(10 ** 4) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows = [(gone, 0, "user", "Hello."), (-1, 5, "user", "Hi.")] + [(-2, 5, "user", "Hi.")] * 40
    turns = spark.createDataFrame(rows, TURN).selectExpr("*", "1 AS seg", "'x' AS audit", "2 AS at")
    got = told(conversations.audit(turns, conversations.damage(turns)))
    assert got == brute(rows)
    assert got[gone] == (0, 0, 0, 0, 0, 0, "", conversations.EMPTY_SHA256)
    assert conversations.audit(turns.limit(0), conversations.damage(turns.limit(0))).count() == 0


def test_repaired_rows_follow_the_audit(spark):
    rows = made_up(random.Random(3), 20, 12)
    laid = conversations.ordered_rows(conversations.damage(spark.createDataFrame(rows, TURN)))
    pieces = conversations.solve(laid)
    audits = {r.conv_id: r.audit for r in conversations.report(laid, pieces).collect()}
    lines = {}
    for r in conversations.repaired(laid, pieces).orderBy("conv_id", "seg", "place").collect():
        lines.setdefault(r.conv_id, []).append((r.role[:1], r.edit))
    for conv, audit in audits.items():
        got = lines.get(conv, [])
        assert "".join(e for _, e in got) == audit.replace("D", "")
        assert PATTERN.match("".join(i for i, _ in got))


def test_prices_are_distances_and_work_is_linear():
    rng = random.Random(1)
    codes = "".join(chr(65 + rng.randrange(16)) for _ in range(20_000))
    price = conversations._auction(codes, conversations.ACCEPT, True)
    audit, state = conversations._trace(codes, price, 0, True)
    assert state in (0, 3) and len(audit.replace("I", "")) == len(codes)
