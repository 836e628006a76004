import re
from collections import Counter

from pyspark.sql import functions as F

from scoutlab.llm.common import packed, settle
from scoutlab.llm.quality import RULES, judged, measured, sketches, thresholds

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    windows = Counter(zip(w, w[1:], w[2:]))
    covered = {i + k for i, x in enumerate(zip(w, w[1:], w[2:])) if windows[x] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed)


def test_measures_match_brute_force(docs, rows):
    got = measured(packed(docs, "text", "lang", "source")).select(
        "_row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert Counter(tuple(r) for r in got.collect()) == Counter((d, *brute(t)) for d, t, _, _ in rows)


def corpus(spark, junk):
    """Clean documents of two languages with their own habits, and junk."""
    rows = []
    for i in range(200):
        word = "wort" if i % 2 else "extraordinarily"
        rows.append((i, " ".join(f"{word}{(i * 7 + k * k) % 997}" for k in range(80)), "ab"[i % 2], "s"))
    for i in range(junk):
        rows.append((1000 + i, " ".join(f"wort{(i + k * k) % 997}%%%" for k in range(80)), "b", "s"))
    rows += [(2000, " ".join(f"wort{k}" for k in range(60)), None, None), (2001, " ".join(f"wort{k}###" for k in range(60)), "b", "tiny")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


def test_outliers_go_and_clean_documents_stay(spark):
    for junk in (0, 5, 60):
        rows = settle(measured(corpus(spark, junk)).drop("text"), "test")
        kept = {r.doc_id: r.kept for r in judged(rows).collect()}
        assert all(kept[i] for i in range(200)) and kept[2000]
        assert not any(kept[1000 + i] for i in range(junk)) and not kept[2001]


def test_sketches_merge_to_the_same_thresholds(spark):
    rows = settle(measured(corpus(spark, 20)).drop("text"), "test")
    one = sketches(rows)
    halves = sketches(rows.filter("doc_id % 2 = 0")).unionByName(sketches(rows.filter("doc_id % 2 = 1")))
    merged = halves.groupBy("lang", "source", "rule", "bucket").agg(F.sum("n").alias("n"))
    assert Counter(thresholds(one).collect()) == Counter(thresholds(merged).collect())


def test_sketch_error_is_bounded(spark):
    values = spark.range(1, 100_000, 7).select(F.col("id").alias("v"))
    from scoutlab.llm.quality import _bucket
    worst = values.select(F.max((F.col("v") - _bucket(F.col("v"))) / F.col("v"))).first()[0]
    assert 0 <= worst <= 1 / 32


def prose(start, n, words, lang, tail=""):
    return [(start + i, " ".join(f"wort{(i * 7 + k * k) % 9973}" for k in range(words)) + tail, lang, "s") for i in range(n)]


def verdicts(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    measures = settle(measured(docs).drop("text"), "test")
    return {r.doc_id: r.kept for r in judged(measures).collect()}, {r.lang: r for r in thresholds(sketches(measures)).collect()}


def test_fences_without_spread_follow_the_group(spark):
    """Symbols: 12 in 100 words stand out in a source of long texts and not in one of short ones."""
    tail = " " + "#" * 12
    rows = (prose(0, 60, 60, "short") + prose(1000, 60, 800, "long")
            + prose(2000, 1, 99, "short", tail) + prose(3000, 1, 99, "long", tail)
            + prose(4000, 1, 99, "long", " " + "#" * 8) + prose(5000, 1, 799, "long", tail) + prose(6000, 1, 99, "short", " " + "#" * 40))
    kept, fences = verdicts(spark, rows)
    assert fences["short"].symbols == 4 * (2000 // 60) and fences["long"].symbols == 4 * (2000 // 800)
    assert {d: kept[d] for d in (2000, 3000, 4000, 5000, 6000)} == {2000: True, 3000: False, 4000: True, 5000: False, 6000: False}
    assert all(kept[i] for i in range(60)) and all(kept[1000 + i] for i in range(60))


def test_lower_fence_stands_where_the_group_holds_long_words(spark):
    """A fifth of the group are strings of 60 characters; single letters are rejected all the same."""
    rows = prose(0, 80, 60, "a") + [(1000 + i, " ".join(f"{k:060d}" for k in range(60)), "a", "s") for i in range(20)]
    rows += [(2000, " ".join(chr(97 + k * k % 23) for k in range(60)), "a", "s")]
    kept, fences = verdicts(spark, rows)
    assert all(kept[i] for i in range(80)) and not kept[2000] and not any(kept[1000 + i] for i in range(20))
    assert 0 < fences["a"].word_length_low < fences["a"].word_length_high


def test_empty(no_docs):
    rows = settle(measured(no_docs.select("doc_id", "text", "lang", "source")), "test")
    assert judged(rows).count() == 0 and len(RULES) == 5
