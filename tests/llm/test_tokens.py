import hashlib
import random
import zlib

import numpy as np
import pytest

import gapledger.llm.bpe as bpe
from gapledger.llm.bpe import Codec, encode_documents
from gapledger.llm.packing import pack, pack_documents, sum_of_squares

LETTERS = ["abcdeinthr", "ab'", "'sltrevmd!", "é́èa ", "日本語中文字", "😀🏽a1", " x ", "İıΣσς", "09", "\x1c\x85 a"]


@pytest.fixture(scope="module")
def coder(vocabulary):
    return Codec(vocabulary)


def plain(coder, text):
    ids = coder.tokenizer.encode(text, add_special_tokens=False).ids
    return np.array(ids, "<u4").tobytes()


def texts(seed, count, longest):
    r = random.Random(seed)
    for _ in range(count):
        letters = r.choice(LETTERS) + r.choice(["", *LETTERS])
        yield "".join(r.choice(letters) for _ in range(r.randint(0, longest)))
        yield "".join(r.choice(["<|endoftext|>", "<|", "the", " ", "'", "s"]) for _ in range(r.randint(0, 60)))


def test_encode_and_join_equal_the_library(coder, monkeypatch):
    monkeypatch.setattr(bpe, "LEAF", 64)
    r = random.Random(1)
    for text in texts(2, 400, 700):
        expected = plain(coder, text)
        assert coder.encode(text) == expected
        at = r.randint(0, len(text))
        left, right = text[:at], text[at:]
        got = coder.join(left, coder._offsets(left), right, coder._offsets(right))
        assert got[0].astype("<u4").tobytes() == expected


def rows_of(coder, docs):
    out = []
    for doc_id, text in docs:
        ids = plain(coder, text or "")
        shown = coder.tokenizer.decode(np.frombuffer(ids, "<u4").tolist(), skip_special_tokens=False)
        out.append((doc_id, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(shown.encode()).hexdigest()))
    return sorted(out, key=str)


ODD = [
    (1, None), (2, ""), (3, "   \n"), (4, "The quick brown fox's café"), (4, "The quick brown fox's café"),
    (None, "no id"), (5, "x" * 9000), (6, "ab'" * 3000), (7, "word " * 2500), (8, "日本語" * 2000),
]


def test_encode_documents(spark, coder, vocabulary):
    docs = spark.createDataFrame([(*r, "x", 1) for r in ODD], "doc_id long, text string, row string, n int")
    got = encode_documents(docs, vocabulary, piece=500)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == rows_of(coder, ODD)
    assert encode_documents(docs.limit(0), vocabulary).count() == 0


def check_packing(coder, docs, rows, size):
    pieces = {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
    for doc_id, text in docs:
        ids = plain(coder, text or "") + (1).to_bytes(4, "little")
        own = sorted(pieces[doc_id], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(-(-len(ids) // (4 * size))))
        for r in own:
            part = ids[4 * r.start : 4 * (r.start + r.length)]
            assert (r.start, r.length, r.ids_crc32) == (r.piece * size, len(part) // 4, zlib.crc32(part))
    check_gapless(rows, size)


def check_gapless(rows, size):
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    return len(sequences)


def test_pack_documents(spark, coder, vocabulary):
    unique = [r for i, r in enumerate(ODD) if i != 4]
    docs = spark.createDataFrame([(*r, 7) for r in unique], "doc_id long, text string, lot int")
    check_packing(coder, unique, pack_documents(docs, vocabulary, size=512).collect(), 512)
    assert pack_documents(docs.limit(0), vocabulary).count() == 0


def test_few_sequences_in_several_rounds(spark):
    r = np.random.default_rng(5)
    lengths = np.minimum(r.lognormal(5, 1.2, 4000).astype(int) + 1, 4096)
    df = spark.createDataFrame([(i, int(n)) for i, n in enumerate(lengths)], "lot long, length long")
    rows = pack(df.selectExpr("lot", "lot AS doc_id", "length"), shard_rows=500).collect()
    assert sorted(r.doc_id for r in rows) == list(range(4000))
    assert check_gapless(rows, 4096) <= -(-lengths.sum() // 4096) * 1.02 + 1


def test_sum_of_squares_prefers_even_counts():
    bins, offsets, fill = sum_of_squares(np.array([6, 4, 10, 3, 3, 4]), 10)
    assert fill.max() <= 10 and fill.sum() == 30 and len(fill) == 3
