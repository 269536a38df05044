"""Encoding by halves against the encoding of whole texts, and the exact round trip."""

import random

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from weektide.llm import bpe  # noqa: E402

FILE, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
SETS = ["abcdefgh the and ", " \t\n　\x1c\x85\xa0a'", "0123456789", "aab'lls're ", "日本語テキスト한국어 ", "😀é‍️‍'", "-=_*#/ "]


def odd_texts(n, sizes):
    pick = random.Random(4)
    for k in range(n):
        size = pick.choice(sizes)
        yield "".join(pick.choice(pick.choice(SETS) if pick.random() < 0.3 else SETS[k % len(SETS)]) for _ in range(size))


@pytest.mark.parametrize(("leaf", "piece"), [(6, 5), (40, 8), (2048, 128)])
def test_tree_equals_whole(monkeypatch, leaf, piece):
    monkeypatch.setattr(bpe, "LEAF", leaf)
    monkeypatch.setattr(bpe, "PIECE_LEAF", piece)
    codec = bpe._codec(bpe._read(FILE), PATTERN)
    texts = [*odd_texts(300, (5, 40, 200, 700)), "x" * 3000, " " * 3000, "ab" * 2500, "é" * 2500, "z 9" * 3000]
    for text in texts:
        tokens = codec.encode(text)
        assert tokens == codec._plain.encode_ordinary(text)
        assert codec.decode(tokens) == text.encode()


def test_table(spark):
    rows = [(k, t, 7) for k, t in enumerate(odd_texts(40, (0, 50, 5000)))] + [(None, "a b", 7), (90, None, 7), (90, "", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, tokens int")
    got = bpe.decode_tokens(bpe.encode_texts(docs, FILE, PATTERN), FILE, PATTERN).collect()
    codec = bpe._codec(bpe._read(FILE), PATTERN)
    want = [(d, codec._plain.encode_ordinary(t or ""), (t or "").encode()) for d, t, _ in rows]
    assert sorted(((r.doc_id, r.tokens, bytes(r.decoded)) for r in got), key=str) == sorted(want, key=str)
    assert bpe.encode_texts(docs, FILE, PATTERN).columns == ["doc_id", "text", "tokens"]
    assert bpe.encode_texts(docs.where("false"), FILE, PATTERN).collect() == []
