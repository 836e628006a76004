import math
import struct
import zlib
from collections import Counter, defaultdict

import xxhash

from scoutlab.llm.sharding import Leaf, descend, shard_documents, topology
from pyspark.sql import functions as F


def draw(key, leaf):
    seed = xxhash.xxh64_intdigest(struct.pack("<q", key), seed=42) if key is not None else 42
    h = xxhash.xxh64_intdigest(struct.pack("<i", leaf.shard), seed=seed)
    return -math.log(((h >> 11) + 1) * 2.0 ** -53) / leaf.weight


def brute(key, tree):
    node = tree
    for level in ("region", "rack", "shard"):
        best = min({getattr(x, level) for x in node}, key=lambda v: (min(draw(key, x) for x in node if getattr(x, level) == v), v))
        node = [x for x in node if getattr(x, level) == best]
    return node[0]


def test_matches_brute_force_descent(docs, rows):
    got = shard_documents(docs).collect()
    assert len(got) == len(rows)
    tree, grown = topology(8), topology(9)
    want = Counter()
    for d, text, _, _ in rows:
        raw = (text or "").encode()
        leaf = brute(d, tree)
        want[d, len(raw) + 1, zlib.crc32(raw), leaf.region, leaf.rack, leaf.shard, brute(d, grown).shard] += 1
    assert want == Counter((r.doc_id, r["size"], r.text_crc32, r.region, r.rack, r.shard, r.grown_shard) for r in got)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 8)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_every_growth_moves_rows_only_into_the_new_shard(spark):
    keys = spark.range(3000)
    for n in range(1, 14):
        both = keys.select(descend(F.col("id"), topology(n))["shard"].alias("a"), descend(F.col("id"), topology(n + 1))["shard"].alias("b"))
        assert both.filter(f"a <> b and b <> {n}").isEmpty()


def test_weights_hold_at_every_level_and_confine_movement(spark):
    tree = [Leaf(0, 0, 0, 1), Leaf(0, 0, 1, 3), Leaf(0, 1, 2, 2), Leaf(1, 0, 3, 6)]
    heavier = [Leaf(0, 0, 0, 1), Leaf(0, 0, 1, 3), Leaf(0, 1, 2, 4), Leaf(1, 0, 3, 6)]
    at = spark.range(12000).select(descend(F.col("id"), tree).alias("a"), descend(F.col("id"), heavier).alias("b")).collect()
    shares = Counter(r.a.shard for r in at)
    assert all(abs(shares[x.shard] / 12000 - x.weight / 12) < 0.02 for x in tree)
    assert all(r.b.shard == 2 for r in at if r.a.shard != r.b.shard)


def test_empty(no_docs):
    assert shard_documents(no_docs).count() == 0
