"""Merge rounds against the library, and the library's decoding."""

import random

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")

from weektide.llm import pieces  # noqa: E402

FILE = public_tokenizers.path("piece_bpe_32k.model")
SETS = ["abcdefgh the and ", " \t\n▁　a'", "0123456789", "aab'lls're ", "日本語テキスト한국어 ", "😀é‍️ꙮ\x00", "-=_*#/ ", " ", "ab", "anan ", "éèuxle "]


def odd_texts(n, sizes):
    pick = random.Random(7)
    for k in range(n):
        size = pick.choice(sizes)
        yield "".join(pick.choice(pick.choice(SETS) if pick.random() < 0.3 else SETS[k % len(SETS)]) for _ in range(size))


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=FILE)


def test_encoding_equals_library(library):
    words = [library.id_to_piece(k).replace("▁", " ") for k in range(259, 32000)]
    pick = random.Random(3)
    texts = [*odd_texts(1500, (0, 1, 2, 5, 40, 200)), "x" * 3000, " " * 3000, "ab" * 2500, "é" * 2500, "z 9" * 3000, "<s>a</s><0x41>"]
    texts += ["".join(pick.choice(words) for _ in range(pick.choice([1, 3, 30]))) for _ in range(1500)]
    texts += ["".join(pick.choice("abcdefghijklmnopqrstuvwxyzABCDEF0123456789+/") for _ in range(20000))]  # one long word
    table = pieces._pieces(pieces._read(FILE))
    ids, ends = table.encode(texts)
    want = library.encode(texts, num_threads=1)
    for k, t in enumerate(texts):
        assert ids[ends[k] : ends[k + 1]].tolist() == want[k], t[:80]
    got = table.decode(ids, ends)
    assert got == [library.decode(x) for x in want]


def test_places_that_must_wait():
    """Pairs that arise while places are merged may come first: all ids over two letters, against one by one."""
    table = pieces._pieces(pieces._read(FILE))

    def one_by_one(symbols):
        symbols = list(symbols)
        while True:
            ranks = [int(table.pair(np.array([a]), np.array([b]))[0][0]) for a, b in zip(symbols, symbols[1:])]
            if not ranks or min(ranks) == pieces.NONE:
                return symbols
            k = ranks.index(min(ranks))
            symbols[k : k + 2] = [int(table.pair(np.array([symbols[k]]), np.array([symbols[k + 1]]))[1][0])]

    pick = random.Random(5)
    for letters in ("an", "es", "er", "in", "to", "la", "=-", "▁a", "01"):
        texts = ["".join(pick.choice(letters) for _ in range(24)) for _ in range(20)]
        symbols = np.concatenate([table.char[[ord(c) for c in t]] for t in texts])
        got, word = table.merge(symbols.copy(), np.repeat(np.arange(len(texts)), 24))
        for k, t in enumerate(texts):
            assert got[word == k].tolist() == one_by_one(table.char[[ord(c) for c in t]])


def test_decoding_of_any_ids(library):
    pick = random.Random(11)
    table = pieces._pieces(pieces._read(FILE))
    for low, high in ((0, 259), (0, 32000), (100, 300), (0, 3), (250, 700)):
        for _ in range(400):
            ids = [pick.randrange(low, high) for _ in range(pick.randrange(0, 9))]
            assert table.decode(np.array(ids, np.int64), np.array([0, len(ids)])) == [library.decode(ids)], ids


def test_table(spark, library):
    rows = [(k, t, 7) for k, t in enumerate(odd_texts(40, (0, 50, 5000)))]
    rows += [(None, "a b", 7), (90, None, 7), (90, "", 7), (5, "a b", 7), (5, "a b", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, pieces int")
    got = pieces.decode_pieces(pieces.encode_pieces(docs, FILE), FILE).collect()
    want = [(d, library.encode(t or ""), t or "") for d, t, _ in rows]
    want = [(d, ids, library.decode(ids)) for d, ids, _ in want]
    assert sorted(((r.doc_id, r.pieces, r.decoded) for r in got), key=str) == sorted(want, key=str)
    assert pieces.encode_pieces(docs, FILE).columns == ["doc_id", "text", "pieces"]
    assert pieces.encode_pieces(docs.where("false"), FILE).collect() == []
