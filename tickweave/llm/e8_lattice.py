"""Embedding near-duplicates by E8 lattice hashing.

A table projects a vector to a few groups of eight random coordinates and decodes each to the
nearest point of the E8 lattice; the points together are the vector's cell. Each vector is
entered in its cell of every table and asks for that cell and the nearest neighbouring ones
(lattice points a shortest vector away). Candidates are verified by cosine in double precision.

Dense groups are not compared pair by pair. Equal vectors are one entry. A vector within half
the linking angle of a cell's first vector joins that centre's ball: two members of a ball are
linked whatever their positions (angles add up at most), so the ball's size gives those links.
Small balls whose centres are within the linking angle of a hub, as those of a looser dense group are,
go into packs of about BLOCK members. Candidates are pairs of packs (a ball with no hub is one by
itself) that meet in a cell, so a dense group gives one for each pair of blocks; those too far apart by
their radii to allow a link go. The rest are compared in blocks by one matrix product each; a block pair
yields a count and the least ball reached for each member, never pairs, and a pair of vectors is in one
block pair only. Links counted this way are true; those between vectors that share no cell and no ball are
missed, and the tests measure how many."""

from __future__ import annotations

import math
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import land, ship_package
from .components import connected_components

BLOCK = 512
SMALL = 64     # most members of a ball that goes into a pack with others
SCALE = 1.75   # edge of the lattice, in units of a coordinate's spread
GROUPS = 2     # lattices in a cell: more for more vectors
TABLES = 12
NEIGHBOURS = 9
SEED = 8


def _shortest() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    out = []
    for i, j in combinations(range(8), 2):
        for s, t in product((1, -1), repeat=2):
            v = [0.0] * 8
            v[i], v[j] = s, t
            out.append(v)
    out += [list(v) for v in product((0.5, -0.5), repeat=8) if sum(x < 0 for x in v) % 2 == 0]
    return np.array(out)


def _nearest_even(x: np.ndarray) -> np.ndarray:
    """The nearest integer points of even coordinate sum: round, and where the sum is odd round the
    coordinate with the largest error the other way."""
    r = np.rint(x)
    err = x - r
    rows = np.flatnonzero(r.sum(1) % 2)
    worst = np.abs(err[rows]).argmax(1)
    r[rows, worst] += np.where(err[rows, worst] >= 0, 1.0, -1.0)
    return r


def decode(x: np.ndarray) -> np.ndarray:
    """The nearest E8 points: of the even integer points and the same moved by a half."""
    a, b = _nearest_even(x), _nearest_even(x - 0.5) + 0.5
    closer = ((x - a) ** 2).sum(1) <= ((x - b) ** 2).sum(1)
    return np.where(closer[:, None], a, b)


def _mixed(h: np.ndarray, values: np.ndarray) -> np.ndarray:
    """A 64-bit hash of `h` and integer columns."""
    for c in values.T:
        h = (h ^ c.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


def cells(x: np.ndarray, tables: int = TABLES, groups: int = GROUPS, scale: float = SCALE,
          neighbours: int = NEIGHBOURS, seed: int = SEED) -> np.ndarray:
    """Hashes of cells, rows x tables x (1 + neighbours): each vector's own cell first, then the
    neighbouring ones in order of distance."""
    n, dim = x.shape
    roots = _shortest()
    out = np.empty((n, tables, 1 + neighbours), np.uint64)
    top = 6  # alternatives of one lattice that are combined with those of the others
    for t in range(tables):
        axes = np.random.default_rng([seed, t, dim]).standard_normal((dim, 8 * groups))
        y = x @ axes / scale
        hashes, costs = None, None
        for g in range(groups):
            part = y[:, 8 * g:8 * g + 8]
            point = decode(part)
            extra = 2.0 - 2.0 * ((part - point) @ roots.T)  # added squared distance
            order = np.argsort(extra, 1, kind="stable")[:, :top]
            cost = np.concatenate([np.zeros((n, 1)), np.take_along_axis(extra, order, 1)], 1)
            points = np.concatenate([point[:, None], point[:, None] + roots[order]], 1)
            one = _mixed(np.full(n * (top + 1), 1 + g, np.uint64),
                         np.rint(2 * points).astype(np.int64).reshape(-1, 8)).reshape(n, top + 1)
            if hashes is None:
                hashes, costs = one, cost
            else:
                hashes = ((hashes * np.uint64(0xC2B2AE3D27D4EB4F))[:, :, None] ^ one[:, None]).reshape(n, -1)
                costs = (costs[:, :, None] + cost[:, None]).reshape(n, -1)
        best = np.argsort(costs, 1, kind="stable")[:, :1 + neighbours]
        picked = np.take_along_axis(hashes, best, 1)
        label = np.full(picked.size, t + 1, np.uint64) * np.uint64(0x165667B19E3779F9)
        out[:, t] = _mixed(label ^ np.uint64(dim), picked.reshape(-1, 1)).reshape(picked.shape)
    return out


def _rows(column: pa.Array) -> np.ndarray:
    """A list column whose lists have one length as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _by_length(p: pa.RecordBatch, column: str) -> list[pa.RecordBatch]:
    """The rows of a batch apart by the length of a list column."""
    lengths = np.diff(p[column].offsets.to_numpy())
    return [p.take(pa.array(np.flatnonzero(lengths == d))) for d in np.unique(lengths)]


def _with_cells(vectors: DataFrame, **how) -> DataFrame:
    """vid, x, mult with `own` (a cell per table) and `asks` (own and neighbouring cells)."""
    def work(batches):
        for b in batches:
            for rows in _by_length(b, "x"):
                x = _rows(rows["x"])
                for at in range(0, len(x), 1024):
                    some = rows.slice(at, 1024)
                    c = cells(x[at:at + 1024], **how).astype(np.int64)
                    own = pa.array(list(c[:, :, 0]), pa.list_(pa.int64()))
                    asks = pa.array(list(c.reshape(len(c), -1)), pa.list_(pa.int64()))
                    yield pa.record_batch([*some.columns, own, asks], [*some.schema.names, "own", "asks"])

    return vectors.mapInArrow(work, "vid bigint, x array<double>, mult bigint, label bigint, "
                                    "own array<bigint>, asks array<bigint>")


def _close(pairs: DataFrame, vectors: DataFrame, a: str, b: str, least: float) -> DataFrame:
    """Pairs of vector ids whose cosine is at least `least`."""
    left = vectors.select(F.col("vid").alias(a), F.col("x").alias("xa"))
    right = vectors.select(F.col("vid").alias(b), F.col("x").alias("xb"))
    schema = f"{a} bigint, {b} bigint"

    def work(batches):
        for batch in batches:
            for p in _by_length(batch, "xa"):
                near = (_rows(p["xa"]) * _rows(p["xb"])).sum(1) >= least
                yield p.select([a, b]).filter(pa.array(near))

    met = pairs.join(left, a).join(right, b).where(F.size("xa") == F.size("xb"))
    return met.select(a, b, "xa", "xb").mapInArrow(work, schema)


def _balls(vectors: DataFrame, angle: float) -> DataFrame:
    """vid, ball: a centre within `angle`, the vector itself if none was met."""
    least = math.cos(angle) + 1e-12
    entered = vectors.select("vid", F.explode("own").alias("cell"))
    first = entered.groupBy("cell").agg(F.min("vid").alias("centre"), F.count(F.lit(1)).alias("n")) \
        .where("n > 1").drop("n")
    met = entered.join(first, "cell").where("vid <> centre").select("vid", "centre").distinct()
    joined = land(_close(met, vectors, "vid", "centre", least).groupBy("vid")
                  .agg(F.min("centre").alias("ball")), "balls")
    for _ in range(2):  # a centre that joined another may bring its members along
        upper = joined.select(F.col("vid").alias("ball"), F.col("ball").alias("centre"))
        moved = _close(joined.join(upper, "ball").select("vid", "centre").where("vid <> centre"),
                       vectors, "vid", "centre", least)
        joined = land(joined.join(moved, "vid", "left")
                      .select("vid", F.coalesce("centre", "ball").alias("ball")), "balls")
    return vectors.select("vid").join(joined, "vid", "left") \
        .select("vid", F.coalesce("ball", "vid").alias("ball"))


def _packs(sizes: DataFrame, vectors: DataFrame, angle: float) -> DataFrame:
    """ball, hub, pack: small balls whose centres are within `angle` of a hub, dealt to packs of about
    BLOCK members; any other ball is its own hub and pack. A pack is named by its least ball."""
    small = sizes.where(F.col("members") <= SMALL).select("ball", "members")
    centres = vectors.join(small.select(F.col("ball").alias("vid")), "vid", "left_semi")
    hubs = _balls(centres, angle).select(F.col("ball").alias("hub"), F.col("vid").alias("ball"))
    dealt = land(hubs.join(small, "ball"), "hubs")
    chunks = dealt.groupBy("hub").agg(F.ceil(F.sum("members") / BLOCK).alias("chunks"))
    dealt = land(dealt.join(chunks, "hub").select(
        "ball", "hub", F.pmod(F.xxhash64("ball"), "chunks").alias("chunk")), "dealt")
    named = dealt.groupBy("hub", "chunk").agg(F.min("ball").alias("pack"))
    packed = dealt.join(named, ["hub", "chunk"]).select("ball", "hub", "pack")
    return sizes.select("ball").join(packed, "ball", "left") \
        .select("ball", F.coalesce("hub", "ball").alias("hub"), F.coalesce("pack", "ball").alias("pack"))


def _spread(full: DataFrame, vectors: DataFrame) -> DataFrame:
    """pack, x of its hub, and the largest angle between the hub and a member."""
    hub = vectors.select(F.col("vid").alias("hub"), F.col("x").alias("xh"))

    def work(batches):
        for batch in batches:
            for p in _by_length(batch, "xh"):
                dots = (_rows(p["x"]) * _rows(p["xh"])).sum(1)
                yield pa.record_batch([p["pack"], pa.array(np.arccos(np.clip(dots, -1, 1)))], ["pack", "r"])

    radius = full.where("vid <> hub").join(hub, "hub").select("pack", "x", "xh") \
        .mapInArrow(work, "pack bigint, r double").groupBy("pack").agg(F.max("r").alias("r"))
    packs = full.select("pack", "hub").distinct()
    return packs.join(radius, "pack", "left").join(hub, "hub") \
        .select("pack", F.coalesce("r", F.lit(0.0)).alias("r"), F.col("xh").alias("x"))


def _reachable(met: DataFrame, spread: DataFrame, angle: float) -> DataFrame:
    """Pairs of packs whose hubs are no farther apart than their radii and the linking angle together."""
    side = lambda s: spread.select(F.col("pack").alias(s), F.col("r").alias(f"r{s}"),
                                   F.col("x").alias(f"x{s}"))

    def work(batches):
        for batch in batches:
            for p in _by_length(batch, "xa"):
                dots = (_rows(p["xa"]) * _rows(p["xb"])).sum(1)
                most = np.minimum(p["ra"].to_numpy() + p["rb"].to_numpy() + (angle + 1e-6), math.pi)
                yield p.select(["a", "b"]).filter(pa.array(dots >= np.cos(most) - 1e-12))

    return (met.join(side("a"), "a").join(side("b"), "b").where(F.size("xa") == F.size("xb"))
            .select("a", "b", "ra", "rb", "xa", "xb").mapInArrow(work, "a bigint, b bigint"))


def _reached(linked: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least ball that each row and column of a link matrix reaches over its links."""
    far = np.iinfo(np.int64).max
    while True:
        to_a = np.minimum(a, np.where(linked, b[None, :], far).min(1))
        to_b = np.minimum(b, np.where(linked, to_a[:, None], far).min(0))
        if (to_a == a).all() and (to_b == b).all():
            return a, b
        a, b = to_a, to_b


def _block_links(near: DataFrame, blocks: DataFrame, cosine: float) -> DataFrame:
    """vid, n, a, b: for each block pair of the pack pairs (a, b), with how many vectors of other balls
    each vector is linked there, its ball, and the least ball it reaches over these links."""
    side = lambda s: blocks.select(F.col("pack").alias(s), *(
        F.col(c).alias(f"{c}_{s}") for c in ("block", "vids", "balls", "mults", "xs")))
    met = near.join(side("a"), "a").join(side("b"), "b").where("a <> b or block_a <= block_b") \
        .withColumn("same", F.expr("a = b and block_a = block_b"))

    def work(batches):
        for p in batches:
            out = ([], [], [], [])
            for r in range(p.num_rows):
                xa, xb = (_rows(p[f"xs_{s}"][r].values) for s in "ab")
                if xa.shape[1] != xb.shape[1]:
                    continue
                ba, bb = (p[f"balls_{s}"][r].values.to_numpy() for s in "ab")
                linked = (xa @ xb.T >= cosine) & (ba[:, None] != bb[None, :])
                if not linked.any():
                    continue
                va, vb = (p[f"vids_{s}"][r].values.to_numpy() for s in "ab")
                ma, mb = (p[f"mults_{s}"][r].values.to_numpy() for s in "ab")
                ra, rb = _reached(linked, ba, bb)
                sides = [(va, linked @ mb, ba, ra)]
                if not p["same"][r].as_py():
                    sides.append((vb, ma @ linked, bb, rb))
                for v, n, own, least in sides:
                    some = np.flatnonzero(n)
                    for column, values in zip(out, (v, n, own, least), strict=True):
                        column.append(values[some])
            if out[0]:
                yield pa.record_batch([pa.array(np.concatenate(c).astype(np.int64)) for c in out],
                                      ["vid", "n", "a", "b"])

    columns = [f"{c}_{s}" for s in "ab" for c in ("vids", "balls", "mults", "xs")]
    return met.select(*columns, "same").mapInArrow(work, "vid bigint, n bigint, a bigint, b bigint")


def near_duplicates(rows: DataFrame, cosine: float = 0.9, key: str = "vec_id",
                    vector: str = "embedding", **how) -> DataFrame:
    """One row per row of `rows`: the key, n_links (other rows at that cosine or more), component_id
    (the smallest key reachable) and kept (the key is that). `how`: tables, groups, scale,
    neighbours and seed of the index, which holds every row.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing
    and are their own component; vectors of different lengths are not linked; equal vectors and
    repeated rows link with each other; an empty table gives an empty result; other columns are
    not read."""
    ship_package(rows.sparkSession)
    angle = math.acos(cosine)
    mid = F.monotonically_increasing_id()
    base = land(rows.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("v"))
                .withColumn("row", mid), "vectors")
    finite = F.forall("v", lambda c: c.isNotNull() & (F.abs(c) < float("inf")) & ~F.isnan(c))
    # by the largest component first, so that squares neither overflow nor vanish
    most = F.array_max(F.transform("v", lambda c: F.abs(c)))
    sound = base.where(F.col("v").isNotNull() & (F.size("v") > 0) & finite).withColumn("most", most) \
        .where("most > 0").withColumn("v", F.transform("v", lambda c: c / F.col("most")))
    same = land(sound.groupBy("v").agg(F.min("row").alias("vid"), F.count(F.lit(1)).alias("mult"),
                                       F.min("key").alias("label")), "distinct-vectors")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, c: s + c * c))
    unit = same.withColumn("_n", norm).select(
        "vid", F.transform("v", lambda c: c / F.col("_n")).alias("x"), "mult", "label")
    vectors = land(_with_cells(unit, **how), "cells")

    member = land(_balls(vectors, angle / 2), "ball-members")
    full = vectors.join(member, "vid")
    sizes = full.groupBy("ball").agg(F.count(F.lit(1)).alias("members"), F.sum("mult").alias("total"),
                                     F.min("label").alias("label"))
    sizes = land(sizes, "ball-sizes")
    packs = land(_packs(sizes, vectors, angle), "packs")
    of_pack = land(packs.join(sizes, "ball").groupBy("pack").agg(
        F.count(F.lit(1)).alias("balls"), F.sum("members").alias("members")), "pack-sizes")
    full = full.join(packs, "ball")
    blocks = land(full.join(of_pack.select("pack", "members"), "pack")
                  .withColumn("block", F.pmod(F.xxhash64("vid"), F.ceil(F.col("members") / BLOCK)))
                  .groupBy("pack", "block", F.size("x").alias("_dim"))
                  .agg(F.collect_list(F.struct("vid", "ball", "mult", "x")).alias("m"))
                  .select("pack", F.struct("block", "_dim").alias("block"), F.col("m.vid").alias("vids"),
                          F.col("m.ball").alias("balls"), F.col("m.mult").alias("mults"),
                          F.col("m.x").alias("xs")), "blocks")

    entered = full.select("pack", F.explode("own").alias("cell")).distinct()
    asked = full.select(F.col("pack").alias("asker"), F.explode("asks").alias("cell")).distinct()
    met = asked.join(entered, "cell").where("asker <> pack") \
        .select(F.least("asker", "pack").alias("a"), F.greatest("asker", "pack").alias("b")).distinct()
    spread = land(_spread(full, vectors), "spread")
    many = of_pack.where("balls > 1").select(F.col("pack").alias("a"), F.col("pack").alias("b"))
    near = land(_reachable(met, spread, angle).union(many), "near-packs")
    crossing = land(_block_links(near, blocks, cosine), "cross-links")

    parts = connected_components(sizes.select(F.col("ball").alias("node"), "label"), crossing.select("a", "b"))
    cross = crossing.groupBy("vid").agg(F.sum("n").alias("cross"))
    known = (member.join(sizes.select("ball", "total"), "ball")
             .join(parts.select(F.col("node").alias("ball"), "label"), "ball").join(cross, "vid", "left")
             .select("vid", (F.col("total") - 1 + F.coalesce("cross", F.lit(0))).alias("n_links"),
                     F.col("label").alias("component_id")))
    of_row = sound.select("row", "v").join(same.select("v", "vid"), "v").join(known, "vid") \
        .select("row", "n_links", "component_id")
    return (base.select("key", "row").join(of_row, "row", "left")
            .select(F.col("key").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component_id", "key").alias("component_id"))
            .withColumn("kept", F.col(key).eqNullSafe(F.col("component_id"))))
