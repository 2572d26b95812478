"""Sharding by a hierarchical weighted hash tree.

A `Tree` holds regions, their racks and the racks' shards; each shard has a weight and an inner
node weighs the sum of what it holds. A row descends the tree from its key alone: at each level
every child draws -ln(u) / weight with u a hash of (key, child's name), and the least draw
wins. A node's draw depends on its own name and weight only, so a changed weight moves rows
into or out of the subtrees on that node's path and leaves the choice among all others as it
was. `Tree.grown` adds a shard as a region of its own, so all movement is into that shard.

Everything is a projection: no shuffle decides the shard. Only the slot numbers shuffle, and
then by ranges of (shard, key), so a shard spans as many tasks as its rows need."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .common import bases, land, shuffle_partitions, task_ordinals

LEAF = tuple[str, int, float]  # name, shard number, weight


@dataclass(frozen=True)
class Tree:
    """regions: ((region name, ((rack name, (leaf, ...)), ...)), ...)"""

    regions: tuple

    @staticmethod
    def of(shards: int, base: int = 8, per_rack: int = 2, racks: int = 2) -> "Tree":
        """Equal shards 0 .. shards - 1. The first `base` fill regions of `racks` racks of
        `per_rack` shards; each further shard joined later and is a region of its own. So one
        more shard takes rows only into itself from `base` shards on; a smaller number is a
        layout of its own, as is another `base`."""
        base = min(shards, base)
        nested: dict[int, dict[int, list]] = {}
        for s in range(base):
            rack = s // per_rack
            nested.setdefault(rack // racks, {}).setdefault(rack, []).append((f"shard-{s}", s, 1.0))
        tree = Tree(tuple((f"region-{g}", tuple((f"rack-{r}", tuple(leaves))
                                                for r, leaves in inner.items()))
                          for g, inner in nested.items()))
        for s in range(base, shards):
            tree = tree.grown(s)
        return tree

    def grown(self, shard: int, weight: float = 1.0) -> "Tree":
        """With one more shard, as a region of its own."""
        leaf = (f"shard-{shard}", shard, weight)
        return Tree((*self.regions, (f"region-of-{shard}", ((f"rack-of-{shard}", (leaf,)),))))


def _weight(node) -> float:
    return node[2] if isinstance(node[1], int) else sum(map(_weight, node[1]))


def _draw(key: Column, name: str, weight: float) -> Column:
    """Exponential draw of a child: -ln(u) / weight, u in (0, 1] from 52 hash bits."""
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(name)), 12)
    u = (bits.cast("double") + 1.0) / float(1 << 52)
    return -F.log(u) / F.lit(float(weight))


def _descend(key: Column, nodes) -> Column:
    """The shard number below the child with the least draw; children of no weight take none."""
    nodes = [n for n in nodes if _weight(n) > 0]
    below = [F.lit(n[1]) if isinstance(n[1], int) else _descend(key, n[1]) for n in nodes]
    if len(nodes) == 1:
        return below[0]
    draws = [_draw(key, n[0], _weight(n)) for n in nodes]
    least = F.least(*draws)
    choice = below[-1]
    for draw, shard in list(zip(draws, below, strict=True))[-2::-1]:
        choice = F.when(draw == least, shard).otherwise(choice)
    return choice


def shard_of(key: Column, tree: Tree) -> Column:
    """The shard number (int) of a key; a null key is a key like any other."""
    key = F.coalesce(key.cast("string"), F.lit("\0null"))
    return _descend(key, tree.regions).cast("int")


def gapless_slots(df: DataFrame, group: str, order: list[str], name: str = "slot",
                  partitions: int | None = None) -> DataFrame:
    """Number the rows of each `group` 0, 1, ... in `order`. Rows are dealt by ranges of
    (group, order) and numbered within their task; the prefix sums that place a task see one
    row per task and group. Equal rows take different numbers."""
    n = partitions or shuffle_partitions(df.sparkSession)
    dealt = df.repartitionByRange(n, group, *order).sortWithinPartitions(group, *order)
    fixed = land(task_ordinals(dealt), "slots")
    at = bases(fixed, [group], F.lit(1)).withColumnRenamed(group, "_group") \
        .withColumnRenamed("pid", "_pid").drop("amount_sum")
    out = fixed.join(at, (F.col("pid") == F.col("_pid")) & F.col(group).eqNullSafe(F.col("_group")))
    return (out.withColumn(name, F.col("base") + F.col("lid") - F.col("first_lid"))
            .drop("pid", "lid", "_pid", "_group", "base", "first_lid"))


def assign_shards(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text",
                  tree: Tree | None = None) -> DataFrame:
    """One row per row of `docs`: key, size (UTF-8 bytes of the text plus 1; null text: 1),
    text_crc32, law, shard, slot (gapless from 0 within the shard, by key) and grown_shard (the
    shard if one more joined).

    The law is `key`: only the key and the shard count decide. Rows with a null key share a
    shard; repeated rows share a shard and take slots of their own; an empty table gives an
    empty result; other columns of `docs` are not read."""
    tree = tree or Tree.of(shards)
    raw = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(key), (F.octet_length(raw) + 1).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"), F.lit("key").alias("law"),
        shard_of(F.col(key), tree).alias("shard"),
        shard_of(F.col(key), tree.grown(shards)).alias("grown_shard"))
    out = gapless_slots(rows, "shard", [key, "text_crc32"])
    return out.select(key, "size", "text_crc32", "law", "shard", "slot", "grown_shard")
