"""Sharding by a hierarchical weighted hash tree (operator 1).

A cluster is a tree of regions, racks and shards.  A key descends it: at each
level it enters the child with the smallest weighted hash draw.

A leaf of weight w draws ``-ln(u(key, leaf)) / w``, an exponential of rate w.
An inner node's draw is the smallest draw of its leaves, which is again an
exponential whose rate is the node's summed weight, so every level splits keys
by weight.  Composing the draws this way, rather than hashing each level on its
own, keeps movement where weights change: a new or heavier leaf can only win
keys for itself, and keys of untouched subtrees compare the same draws as
before.  (With independent draws per level, keys drawn into a grown region
would also land on that region's old shards.)

Law kept by this operator: ``key``.  Nothing but the key and the tree decides,
so no shuffle is needed to place a row.

Null keys all take one defined path; repeated keys share a shard.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from scoutlab.llm.common import numbered, settle

RACKS_PER_REGION = 2
SHARDS_PER_RACK = 2


@dataclass(frozen=True)
class Leaf:
    region: int
    rack: int
    shard: int
    weight: float = 1.0


def topology(shards: int, per_rack: int = SHARDS_PER_RACK, racks: int = RACKS_PER_REGION) -> list[Leaf]:
    """A tree of equal shards, filled rack by rack and region by region."""
    return [Leaf(s // (per_rack * racks), s // per_rack % racks, s) for s in range(shards)]


def _draw(key: Column, leaf: Leaf) -> Column:
    u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(leaf.shard)), 11).cast("double") + 1.0) * F.lit(2.0 ** -53)
    return -F.log(u) / F.lit(float(leaf.weight))


def _smallest(options: list[tuple[Column, Column]]) -> Column:
    """The value whose draw is smallest, the lower value on a tie."""
    if len(options) == 1:
        return options[0][1]
    return F.array_min(F.array(*[F.struct(d.alias("d"), v.alias("v")) for d, v in options]))["v"]


def descend(key: Column, tree: list[Leaf]) -> Column:
    """Struct (region, rack, shard) that ``key`` reaches in ``tree``."""
    regions = sorted({x.region for x in tree})
    draws = {x.shard: _draw(key, x) for x in tree}

    def node(leaves: list[Leaf]) -> Column:
        return F.least(*[draws[x.shard] for x in leaves]) if len(leaves) > 1 else draws[leaves[0].shard]

    region = _smallest([(node([x for x in tree if x.region == r]), F.lit(r)) for r in regions])
    rack = shard = None
    for r in regions:
        in_region = [x for x in tree if x.region == r]
        ids = sorted({x.rack for x in in_region})
        pick = _smallest([(node([x for x in in_region if x.rack == k]), F.lit(k)) for k in ids])
        leaf = None
        for k in ids:
            best = _smallest([(draws[x.shard], F.lit(x.shard)) for x in in_region if x.rack == k])
            leaf = F.when(pick == k, best) if leaf is None else leaf.when(pick == k, best)
        rack = F.when(region == r, pick) if rack is None else rack.when(region == r, pick)
        shard = F.when(region == r, leaf) if shard is None else shard.when(region == r, leaf)
    return F.struct(region.alias("region"), rack.alias("rack"), shard.alias("shard"))


def place(docs: DataFrame, key: str, tree: list[Leaf], grown: list[Leaf] | None = None) -> DataFrame:
    """Narrow map: add region, rack, shard and, for a second tree, grown_shard."""
    placed = docs.withColumn("_at", descend(F.col(key), tree))
    placed = placed.select(*[F.col(c) for c in docs.columns], "_at.region", "_at.rack", "_at.shard")
    grown_shard = descend(F.col(key), grown)["shard"] if grown else F.lit(None).cast("int")
    return placed.withColumn("grown_shard", grown_shard)


def shard_documents(docs: DataFrame, shards: int = 8) -> DataFrame:
    """Place ``docs`` (doc_id, text, ...) into ``shards`` equal shards.

    Returns doc_id, size (UTF-8 bytes + 1), text_crc32, law, region, rack,
    shard, slot (gapless from 0 in each shard) and grown_shard (the shard with
    one more in the cluster).  The text is read once, in a map without a
    shuffle; only the narrow rows are written and numbered.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        F.lit("key").alias("law"),
        F.monotonically_increasing_id().alias("_rid"),
    )
    placed = settle(place(narrow, "doc_id", topology(shards), topology(shards + 1)), "shards")
    return numbered(placed, ["shard"], "_rid", "slot").drop("_rid")
