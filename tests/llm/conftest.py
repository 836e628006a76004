import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # Names that the operators use inside.
    T.StructField("size", T.LongType()), T.StructField("kept", T.StringType()), T.StructField("node", T.LongType()),
    T.StructField("n_words", T.LongType()), T.StructField("_row", T.StringType()), T.StructField("start", T.LongType()),
])


def prose(seed: int, n: int, words: int = 400) -> str:
    import random
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(words)}" + rng.choice(("", "", "", "\n", ".")) for _ in range(n))


def small_rows() -> list[tuple]:
    """(doc_id, text, lang, source): nulls, empty, blank, one word, long, ties, copies, near copies."""
    base = prose(1, 300)
    words = base.split(" ")
    near = " ".join(w if i % 90 else "changed" for i, w in enumerate(words))
    farther = " ".join(w if i % 45 else "altered" for i, w in enumerate(words))
    passage = prose(2, 160)
    rows = [
        (1, base, "en", "a"), (2, base, "en", "a"), (3, base.upper(), "en", "b"), (4, near, "en", "a"), (5, farther, "en", "c"),
        (6, None, "en", "a"), (7, "", "en", None), (8, " \t\n\x0b\f\r ", None, "a"), (9, "one", "en", "a"), (10, "ONE", "en", "b"),
        (11, "one two three", "fr", "b"), (12, prose(3, 9000), "en", "a"), (13, "x" * 5000, "en", "é"), (14, "é" * 900 + " ü" * 30, "de", "é"),
        (15, "ab " * 700, "en", "a"), (16, prose(4, 80) + " " + passage + " " + prose(5, 90), "en", "a"),
        (17, prose(6, 85) + " " + passage + " " + prose(7, 95), "en", None), (18, prose(8, 200) + "\nline twice\nline twice\nline twice", "en", "a"),
        (19, "İstanbul K ſ ǅ " * 40, "tr", "z"), (20, " ".join(f"{w}###" for w in prose(9, 100).split()), "en", "a"),
        (20, " ".join(f"{w}###" for w in prose(9, 100).split()), "en", "a"), (None, base, "en", "a"), (None, "no id", None, None),
    ]
    rows += [(100 + i, prose(100 + i, 60 + 7 * i), "en", "abc"[i % 3]) for i in range(40)]
    rows += [(200 + i, prose(50, 120), "en", "a") for i in range(30)]
    return rows


@pytest.fixture(scope="session")
def rows():
    return small_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    data = [(d, t, lang, s, len(t or ""), 5, "x", 1, 2, "r", 3) for d, t, lang, s in rows]
    return spark.createDataFrame(data, DOCS).repartition(4).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
