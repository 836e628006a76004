import zlib
from collections import defaultdict

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from scoutlab.llm.packing import END_ID, Packer, WordIds, pack

PATH = public_tokenizers.path("word_bpe_49k.json")


def plain_ids(text):
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return [e.ids + [END_ID] for e in t.encode_batch(text, add_special_tokens=False)]


def check(pieces, rows, capacity=4096):
    """Every document's ids lie in its pieces once; sequences are gapless and
    full or a power of two long."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert p.length * 4 == len(p.ids) and p.length > 0
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    want = defaultdict(list)
    for (d, t), ids in zip(rows, plain_ids([t or "" for _, t in rows])):
        want[d].append(ids)
    assert set(want) == set(by_doc)
    for d, texts in want.items():
        assert sum(p.length for p in by_doc[d]) == sum(map(len, texts))
        if len(texts) == 1:
            parts = sorted(by_doc[d], key=lambda p: p.start)
            joined = b"".join(bytes(p.ids) for p in parts)
            assert joined == b"".join(i.to_bytes(4, "little") for i in texts[0])
            assert [p.start for p in parts] == [sum(q.length for q in parts[:k]) for k in range(len(parts))]
            assert {p.doc_tokens for p in parts} == {len(texts[0])}
    for parts in by_sequence.values():
        parts.sort(key=lambda p: p.offset)
        assert [p.offset for p in parts] == [sum(q.length for q in parts[:k]) for k in range(len(parts))]
        total = sum(p.length for p in parts)
        assert total == capacity or total < capacity and total & (total - 1) == 0
    return by_sequence


def test_ids_lie_in_one_piece_each(docs, rows):
    check(pack(docs, PATH).collect(), [(d, t) for d, t, _, _ in rows])


def test_word_by_word_ids_equal_the_tokenizers(spark):
    odd = ["a  b\tc\r\nd", "don't STOP we'll", "naïve é é ﬁ", "x y z", "1234 5.6, (7)", "<|endoftext|> <|startoftext|>", "日本語 текст",
           "İI ſs ΑΣ ΑΣ.", "a\x1cb\x0bc", "...", " ", "", "word, word. word,. WORD"]
    assert [x.tolist() for x in WordIds(PATH)(odd)] == plain_ids(odd)
    assert [x.tolist() for x in WordIds(PATH)(odd * 2)] == plain_ids(odd * 2)


@pytest.mark.parametrize("segments,loss", [(3, 512), (64, 200), (1, 512)])
def test_three_limits_hold_at_once(docs, rows, segments, loss):
    flagged = "doc_id is not null and doc_id % 2 = 0"
    pieces = pack(docs, PATH, bears_loss=flagged, capacity=512, max_segments=segments, max_loss=loss).collect()
    sequences = check(pieces, [(d, t) for d, t, _, _ in rows], 512)
    for parts in sequences.values():
        assert len(parts) <= segments
        assert sum(p.length for p in parts if p.doc_id is not None and p.doc_id % 2 == 0) <= loss


def test_largest_dot_product_goes_first():
    p = Packer(100, 10, 100)
    p.add([("small", b"x" * 20, 0, 20, False), ("loss", b"x" * 60, 0, 60, True), ("big", b"x" * 70, 0, 70, False)])
    rows = p.fill()
    # 60 tokens of which all bear loss outweigh 70 that do not; then 20 fit,
    # and the rest of the room takes a cut of the big one.
    assert [(r[0], len(r[1])) for r in rows] == [("loss", 60), ("small", 20), ("big", 20)]


def test_crc_of_ids_is_little_endian(spark):
    docs = spark.createDataFrame([(1, "hello world")], "doc_id long, text string")
    got = pack(docs, PATH).select(F.crc32("ids").alias("c"), "sequence_id", "offset").orderBy("offset", "sequence_id").collect()
    ids = plain_ids(["hello world"])[0]
    assert [r.c for r in got] == [zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part)) for part in (ids[:2], ids[2:])]


def test_empty(no_docs):
    assert pack(no_docs, PATH).count() == 0


def test_written_out_added_tokens_are_read_as_the_plain_tokenizer_reads_them(spark):
    plain = Tokenizer.from_file(PATH)
    added = [str(x.content) for x in plain.get_added_tokens_decoder().values()]
    texts = [f"{a}{t}{b}" for t in [*added, "<|endoftext|>", "<|ENDOFTEXT|>"] for a in ("", "one", "One, ", "two\n", "x.")
             for b in ("", "end", " End", ".", t, f" {t}", "\tx")]
    got = [ids.tolist() for ids in WordIds.shared(PATH)(texts)]
    assert got == [e.ids + [END_ID] for e in plain.encode_batch(texts, add_special_tokens=False)]
    assert 49407 in got[texts.index("<|endoftext|>")]
    piece = pack(spark.createDataFrame([(1, "one <|endoftext|>")], "doc_id long, text string"), PATH).collect()
    want = plain.encode("one <|endoftext|>", add_special_tokens=False).ids + [END_ID]
    assert b"".join(bytes(p.ids) for p in sorted(piece, key=lambda p: p.start)) == b"".join(i.to_bytes(4, "little") for i in want)
