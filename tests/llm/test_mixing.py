import hashlib
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from scoutlab.llm.mixing import mix, mixed_documents, schedule, with_targets

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes):
    """Repeated resharing, source by source."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, stopped = sum(sizes.values()), set()
    while True:
        open_ = [s for s in order if s not in stopped]
        left = total - sum(3 * sizes[s] for s in stopped)
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        more = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not more:
            return {s: share.get(s, 3.0 * sizes[s]) for s in order}
        stopped |= more


def check(got, rows):
    sizes, ids = Counter(), defaultdict(list)
    for d, t, _, s in rows:
        n = len(WORD.findall(t or ""))
        sizes[s] += n
        ids[s].append((hashlib.md5(("42:" + str(d) if d is not None else "42").encode()).hexdigest(), n))
    targets = brute_targets(dict(sizes))
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source])
        assert 0 <= r.taken <= 3 * r["size"]
        taken[r.source] += r.taken
    for s, target in targets.items():
        assert abs(taken[s] - target) <= 0.5 + 1e-6


def test_targets_and_takes(docs, rows):
    got = mix(docs.withColumn("source2", F.col("source")), carry=("source2",)).collect()
    assert len(got) == len(rows)
    got = [type("R", (dict,), {"__getattr__": dict.__getitem__})(r.asDict() | {"source": r.source2}) for r in got]
    check(got, rows)


@pytest.mark.parametrize("block", [1, 7, 64, 100000])
def test_any_block_size_meets_the_targets(docs, rows, block):
    got = [r.asDict() for r in mix(docs, block=block).collect()]
    want = {(r["doc_id"], r["size"], r["source_size"]): r["taken"] for r in (x.asDict() for x in mix(docs).collect())}
    assert {(r["doc_id"], r["size"], r["source_size"]) for r in got} == set(want)
    assert sum(r["taken"] for r in got) == pytest.approx(sum(want.values()), abs=5)


def test_schedule_spreads_sources(spark):
    sources = with_targets(spark.createDataFrame([("a", 500_000), ("b", 400_000), ("c", 300_000), (None, 10)], "source string, source_size long"))
    total = 1_200_010
    slots = sorted((r.slot, r.source, r["rank"], r["take"]) for r in schedule(spark, sources, total, 1000).collect())
    quota = {r.source: r.quota for r in sources.collect()}
    ranks, words = defaultdict(list), Counter()
    for _, s, rank, take in slots:
        ranks[s].append(rank)
        words[s] += take
    assert all(r == list(range(len(r))) for r in ranks.values())
    assert words == quota
    for upto in (100, 400, 800):
        part = Counter(s for _, s, _, _ in slots[:upto])
        assert all(abs(part[s] - upto * quota[s] / total) <= 4 for s in "abc")


def test_mixed_documents_repeat_whole_rows(docs):
    mixed = mixed_documents(docs)
    assert mixed.columns == docs.columns
    times = Counter(r.doc_id for r in mixed.collect() if r.doc_id not in (20, None))
    for r in mix(docs).collect():
        if r.doc_id not in (20, None) and r["size"]:
            assert times[r.doc_id] == int(r.taken / r["size"] + 0.5)


def test_reruns_agree_and_empty(docs, no_docs):
    assert Counter(mix(docs).collect()) == Counter(mix(docs.repartition(7)).collect())
    assert mix(no_docs).count() == 0 and mixed_documents(no_docs).count() == 0
