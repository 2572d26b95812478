"""SimHash near-duplicates by multi-index hashing.

A fingerprint is the bitwise majority of the 64-bit hashes of a text's word shingles. Two
fingerprints at `distance` bits or fewer, cut into segments, agree in some segment up to
distance // segments bits. So every fingerprint enumerates the Hamming ball of that radius
around each of its segments, the table of that segment is looked up for each member, and the
full distance decides. A pair one bit apart in a segment is found from the side that has the
bit, so a ball of radius one needs only the segment itself and it with each set bit cleared.

Equal fingerprints are one entry with its smallest document, so copies cost nothing. Balls and
tables meet in an equality join, which Spark deals by segment value and can split where a value
is frequent. Components come from the links by iterated joins; nothing is collected.

Where more than CROWD fingerprints have one segment value, neither their comparisons nor their
links are made pair by pair. The other bits are cut into segments in turn, of which near ones
agree in one up to the radius, and only these meet. And such fingerprints are first grouped by
the points one bit from them: all at a point are at most two bits apart and are tied to the least
of them, so a dense group is a few dozen ties for each member. Links are then sought between
groups only. Fingerprints of two groups are three bits apart or more, so the groups that one can
be linked to are bounded (672 at three bits: triples of 64 bits that share at most one)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import land, ship_package, slices
from .components import connected_components, stars

_LOWER = bytes(range(256)).lower()  # A-Z only
_SEED = 42
CROWD = 32


def fingerprint(text: str, shingle: int) -> bytes:
    """64 bits, most significant first. Words are runs without ASCII white space, A-Z lower-cased;
    fewer words than a shingle are one; no words give zero."""
    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return bytes(8)
    joined = b" ".join(words)
    digest = xxhash.xxh64_digest
    if len(words) <= shingle:
        return digest(joined, _SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = [0, *ends[:len(words) - shingle].tolist()]
    hashes = b"".join([digest(joined[a:b], _SEED)
                       for a, b in zip(starts, (ends[shingle - 1:] - 1).tolist(), strict=True)])
    rows = np.frombuffer(hashes, np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(rows), 1 << 16):
        ones += np.unpackbits(rows[at:at + (1 << 16)], axis=1).sum(0, dtype=np.int64)
    return np.packbits(2 * ones > len(rows)).tobytes()


def fingerprints(docs: DataFrame, shingle: int = 3, key: str = "doc_id", text: str = "text",
                 keep: list[str] | None = None) -> DataFrame:
    """Key, the columns `keep` and `fp` (signed 64-bit) of every row; a null text has no words."""
    ship_package(docs.sparkSession)
    keep = [key, *(keep or [])]
    kept = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)

    def work(batches):
        for b in slices(batches, 1000):
            raw = b"".join(fingerprint(t or "", shingle) for t in b[len(keep)].to_pylist())
            fp = pa.array(np.frombuffer(raw, ">i8").astype(np.int64))
            yield pa.record_batch([*b.columns[:len(keep)], fp], [*keep, "fp"])

    return docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text).cast("string").alias("_text")) \
        .mapInArrow(work, f"{kept}, fp bigint")


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def _segments(distance: int) -> list[tuple[int, int]]:
    """(shift, bits) of the segments: as few as leave a radius of at most one in each."""
    m = distance // 2 + 1
    edges = [64 * i // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def _flips(v, bits: int, only_set: bool = False):
    """`v` and it with one of its low `bits` changed (or, with `only_set`, cleared)."""
    masks = F.array(*[F.lit(_signed(1 << b)) for b in range(bits)])
    if only_set:
        masks = F.filter(masks, lambda m: v.bitwiseAND(m) != 0)
    return F.concat(F.array(v), F.transform(masks, lambda m: v.bitwiseXOR(m)))


def _low(v, shift: int, bits: int):
    return F.shiftrightunsigned(v, shift).bitwiseAND(_signed((1 << bits) - 1))


def _numbered(values, number: int, *names: str):
    """Each of `values` in a struct behind `number`."""
    return F.transform(values, lambda v: F.struct(F.lit(number).alias(names[0]), v.alias(names[1])))


def _entries(distinct: DataFrame, distance: int) -> DataFrame:
    """The columns of `distinct` with seg and value of each segment of fp."""
    own = [F.struct(F.lit(i).alias("seg"), _low(F.col("fp"), shift, bits).alias("value"))
           for i, (shift, bits) in enumerate(_segments(distance))]
    return distinct.withColumn("_e", F.explode(F.array(*own))).select(*distinct.columns, "_e.seg", "_e.value")


def _crowded(distinct: DataFrame, distance: int, crowd: int) -> DataFrame:
    """seg and value of the segments that more than `crowd` fingerprints have."""
    counts = _entries(distinct.select("fp"), distance).groupBy("seg", "value").count()
    return land(counts.where(F.col("count") > crowd).select("seg", "value"), "crowded-segments")


def _refined(rows: DataFrame, crowded: DataFrame, distance: int, asks: bool) -> DataFrame:
    """`rows` (fp, seg, value) with the key part and rest: where the segment is crowded a row for each
    part of the other bits (with `asks` one for each member of its ball), else one row."""
    segments = _segments(distance)
    plain = F.array(F.struct(F.lit(-1).alias("part"), F.lit(0).cast("long").alias("rest")))
    keys = plain
    if len(segments) > 1:
        for i, (shift, bits) in enumerate(segments):
            end = shift + bits
            others = F.col("fp") if end == 64 else \
                F.shiftrightunsigned("fp", end).bitwiseOR(F.shiftleft("fp", 64 - end))
            edges = [(64 - bits) * k // len(segments) for k in range(len(segments) + 1)]
            parts = []
            for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                v = _low(others, a, b - a)
                members = _flips(v, b - a) if asks and distance // len(segments) else F.array(v)
                parts.append(_numbered(members, k, "part", "rest"))
            keys = F.when(F.col("_crowd") & (F.col("seg") == i), F.concat(*parts)).otherwise(keys)
    marked = rows.join(crowded.withColumn("_crowd", F.lit(True)), ["seg", "value"], "left")
    marked = marked.withColumn("_crowd", F.coalesce("_crowd", F.lit(False)))
    return marked.withColumn("_k", F.explode(keys)).select(*rows.columns, "_k.part", "_k.rest")


def links(distinct: DataFrame, distance: int, crowd: int = CROWD, group: str = "fp",
          crowded: DataFrame | None = None) -> DataFrame:
    """Pairs a, b of different groups (column `group` of `distinct`; each fingerprint its own by default)
    with fingerprints (column fp, each once) at most `distance` bits apart; a pair may come more than once."""
    segments = _segments(distance)
    radius = distance // len(segments)
    if crowded is None:
        crowded = _crowded(distinct, distance, crowd)
    nodes = distinct.select("fp", F.col(group).alias("node"))
    probes = []
    for i, (shift, bits) in enumerate(segments):
        v = _low(F.col("fp"), shift, bits)
        ball = _flips(v, bits, only_set=True) if radius else F.array(v)
        probes.append(_numbered(ball, i, "seg", "value"))
    asked = nodes.withColumn("_e", F.explode(F.concat(*probes))).select("fp", "node", "_e.seg", "_e.value")
    asked = _refined(asked, crowded, distance, True) \
        .select("seg", "value", "part", "rest", F.col("fp").alias("x"), F.col("node").alias("a"))
    table = _refined(_entries(nodes, distance), crowded, distance, False) \
        .select("seg", "value", "part", "rest", F.col("fp").alias("y"), F.col("node").alias("b"))
    near = (F.bit_count(F.col("x").bitwiseXOR(F.col("y"))) <= distance) & (F.col("a") != F.col("b"))
    return asked.join(table, ["seg", "value", "part", "rest"]).where(near).select("a", "b")


def dense_groups(distinct: DataFrame, distance: int, crowded: DataFrame) -> DataFrame:
    """The columns of `distinct` and `node`: the least fingerprint of those it hangs together with, through
    fingerprints in crowded segments at most two bits apart; its own outside of such segments."""
    if distance < 2:
        return distinct.withColumn("node", F.col("fp"))
    dense = _entries(distinct.select("fp"), distance).join(crowded, ["seg", "value"], "left_semi") \
        .select("fp").distinct()
    points = land(dense.select("fp", F.explode(_flips(F.col("fp"), 64)).alias("point")), "points")
    least = points.groupBy("point").agg(F.min("fp").alias("least"))
    tied = stars(points.join(least, "point").select(F.col("least").alias("a"), F.col("fp").alias("b")))
    return distinct.join(tied.select(F.col("b").alias("fp"), "a"), "fp", "left") \
        .select(*distinct.columns, F.coalesce("a", "fp").alias("node"))


def _components(marked: DataFrame, distance: int, key: str) -> DataFrame:
    """fp, root and label (the least fingerprint and key of its component) of all fingerprints. Landed:
    a join with two plain inputs is one that Spark splits where a fingerprint is frequent."""
    distinct = land(marked.groupBy("fp").agg(F.min(key).alias("first")), "distinct-fingerprints")
    crowded = _crowded(distinct, distance, CROWD)
    grouped = land(dense_groups(distinct, distance, crowded), "dense-groups")
    pairs = links(grouped, distance, group="node", crowded=crowded)
    nodes = grouped.groupBy("node").agg(F.min("first").alias("label"))
    found = land(connected_components(nodes, pairs), "group-components")
    return land(grouped.select("fp", "node").join(found, "node").drop("node"), "components")


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 3, key: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """One row per row of `docs`: the key, fingerprint (16 lower-case hex digits) and component_id,
    the smallest key reachable over links of at most `distance` differing bits.

    Null and empty texts have fingerprint zero and are linked like any other; repeated rows each
    get a row; a null key is reachable but never the smallest unless there is no other; an empty
    table gives an empty result; other columns are not read."""
    marked = land(fingerprints(docs, shingle, key, text), "fingerprints")
    return (marked.join(_components(marked, distance, key), "fp")
            .select(key, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    F.col("label").alias("component_id")))


def one_of_each(docs: DataFrame, shingle: int = 3, distance: int = 3, key: str = "doc_id",
                text: str = "text") -> DataFrame:
    """The rows of `docs` that stand for their component: one for each, of its smallest key (a null
    key only where there is no other), and of several rows with that key the one whose text has
    the smallest hash. Nulls, repeats and empty tables as in `near_duplicates`."""
    hashed = docs.withColumn("_text_hash", F.xxhash64(F.col(text)))
    marked = land(fingerprints(hashed, shingle, key, text, ["_text_hash"]), "fingerprints")
    first = F.min(F.struct(F.col(key).isNull().alias("last"), F.col(key).alias("_key"), "_text_hash"))
    chosen = marked.join(_components(marked, distance, key), "fp") \
        .groupBy("root").agg(first.alias("w")).select("w._key", F.col("w._text_hash").alias("_hash"))
    return (hashed.join(chosen, F.col(key).eqNullSafe(F.col("_key"))
                        & (F.col("_text_hash") == F.col("_hash")), "left_semi")
            .dropDuplicates([key, "_text_hash"]).select(*docs.columns))
