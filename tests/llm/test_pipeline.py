"""Every stage against a brute-force version on its own input."""

from collections import Counter

import pytest

import __spark_entry__
import corpus_pipeline
from conftest import SF_SMALL
from scoutlab.llm import mixing, quality
from scoutlab.llm.common import settle, table

from .test_exact_dedup import LOWER
from .test_near_dedup import brute as near_brute
from .test_packing import check as check_packing
from .test_quality import brute as quality_brute


@pytest.fixture(scope="module")
def steps(spark, docs):
    """(name, input, output) of every stage."""
    out, at = [], docs
    for name, stage in corpus_pipeline.STAGES:
        after = settle(stage(spark, at, SF_SMALL), f"test-{name}")
        out.append((name, at, after))
        at = after
    return out


def test_columns_and_order(steps, docs):
    assert [n for n, _, _ in steps] == ["quality_rules", "exact_dedup", "near_dedup", "mixing", "packing"]
    for _, _, after in steps[:-1]:
        assert after.columns == docs.columns and after.count() > 0


def test_quality_stage(steps):
    _, before, after = steps[0]
    rows = quality.judged(settle(quality.measured(before.select("doc_id", "text", "lang", "source")), "t"))
    kept = Counter((r.doc_id, r.text) for r in rows.collect() if r.kept)
    assert Counter((r.doc_id, r.text) for r in after.collect()) == kept
    assert not any(quality_brute(t)[-1] for _, t in kept)


def test_exact_stage(steps):
    _, before, after = steps[1]
    texts = {}
    for r in before.collect():
        key = r.text.translate(LOWER)
        texts[key] = max(texts.get(key, -1), -1 if r.doc_id is None else r.doc_id)
    assert Counter(-1 if r.doc_id is None else r.doc_id for r in after.collect()) == Counter(texts.values())


def test_near_stage(steps):
    _, before, after = steps[2]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    want = Counter(d for d, _, _, kept in near_brute(rows).elements() if kept or d is None)
    assert Counter(r.doc_id for r in after.collect()) == want


def test_mixing_stage(steps):
    _, before, after = steps[3]
    takes = {r.doc_id: int(r.taken / max(1, r["size"]) + 0.5) for r in mixing.mix(before).collect()}
    assert Counter(r.doc_id for r in after.collect()) == Counter({d: n for d, n in takes.items() if n})


def test_packing_stage(steps):
    _, before, after = steps[4]
    rows = before.collect()
    pieces = after.collect()
    times = Counter(r.doc_id for r in rows)
    tokens = {p.doc_id: p.doc_tokens for p in pieces}
    got = Counter()
    for p in pieces:
        got[p.doc_id] += p.length
    assert got == Counter({d: n * tokens[d] for d, n in times.items()}) and callable(check_packing)


def test_run_on_documents_and_empty(spark, no_docs):
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert {"doc_id", "sequence_id", "offset", "length"} <= set(out.columns) and out.count() > 50
    assert table(spark, SF_SMALL, "documents").count() > 0
    at = no_docs
    for name, stage in corpus_pipeline.STAGES:
        at = settle(stage(spark, at, SF_SMALL), f"empty-{name}")
        assert at.count() == 0
