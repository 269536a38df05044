"""Ranked search against the scores of all documents."""

import math
import random
import re
from collections import Counter

import pytest

from weektide.llm import lexical
from weektide.llm.lexical import ranked_search

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(docs, items, k):
    lists = [(d, terms(t)) for d, t, *_ in docs]
    lists = [(d, Counter(x), len(x)) for d, x in lists if x]
    n, total = len(lists), sum(x[2] for x in lists)
    df = Counter(t for _, c, _ in lists for t in c)
    asked = {}
    for i, text in sorted({(i, t) for i, t, *_ in items}, key=str):
        asked.setdefault(i, []).extend(terms(text))
    out = []
    for i, own in asked.items():
        scores = []
        for d, c, size in lists:
            m = 25 + 75 * size * n // total
            s = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in own if c[t]
            )
            if s > 0:
                scores.append((-s, d is not None, d or 0))
        out += [(i, r, d if known else None, -s) for r, (s, known, d) in enumerate(sorted(scores)[:k], 1)]
    return out


@pytest.mark.parametrize(("tree_docs", "block"), [(8192, 500_000), (40, 30), (300, 100)])
def test_equals_all_scores(spark, monkeypatch, tree_docs, block):
    monkeypatch.setattr(lexical, "BLOCK_TERMS", block)
    pick = random.Random(block)
    words = [f"{pick.choice(['w', 'É', 'ß', 'X'])}{int(pick.paretovariate(0.6)) % 300}" for _ in range(3000)]
    prose = lambda n: pick.choice([" ", "-", "\n"]).join(pick.choice(words) for _ in range(n))
    docs = [(k, prose(pick.choice([0, 1, 3, 20, 60]))) for k in range(700)]
    docs += [(900, None), (901, ""), (902, prose(6000)), (None, prose(9)), (5, docs[4][1]), (5, docs[5][1])]
    docs += [(2000 + k, "the same w1 W2 w3 w3") for k in range(150)]  # ties
    items = [(k, prose(pick.choice([1, 4, 30]))) for k in range(25)]
    items += [(50, "w3 W1 w1"), (51, None), (52, "?!"), (53, "nobody has this"), (None, "w2 w7"), (50, "w3 W1 w1"), (54, "w1"), (54, "w2"), (55, prose(3000))]
    spread = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, n int").repartition(3)
    table = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, score int")
    got = [tuple(r) for r in ranked_search(spread, table, 10, tree_docs).collect()]
    assert sorted(got, key=str) == sorted(brute(docs, items, 10), key=str)


def test_small_trees():
    """The walk over trees of every size, without Spark."""
    import numpy as np

    pick = random.Random(9)
    for leaf in (1, 3, 32):
        lexical.LEAF, old = leaf, lexical.LEAF
        try:
            for n in (1, 2, 7, 60, 400):
                vectors = [{pick.randrange(12): pick.randrange(1, 5) for _ in range(pick.randrange(0, 9))} for _ in range(n)]
                m = np.array([pick.randrange(20, 300) for _ in range(n)])
                flat = [(d, t, f) for d, v in enumerate(vectors) for t, f in v.items()]
                doc, term, tf = (np.array([x[k] for x in flat], np.int64) for k in range(3))
                tree = lexical.Tree(np.arange(n) // 2, np.ones(n, bool), m, doc, term, tf)
                for _ in range(5):
                    asked = np.array(sorted(pick.sample(range(15), 5)), np.int64)
                    weights = np.array([pick.randrange(0, 9000) for _ in asked])
                    best = lexical.Best(10)
                    tree.search(asked, weights, best)
                    want = []
                    for d, v in enumerate(vectors):
                        s = sum(int(w) * (10**9 * v[t] // (1000 * v[t] + 8 * int(m[d]))) for t, w in zip(asked.tolist(), weights) if t in v)
                        if s:
                            want.append((-s, d // 2))
                    assert list(zip((-best.score).tolist(), best.ids.tolist())) == sorted(want)[:10]
        finally:
            lexical.LEAF = old


def test_empty(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    for d, i in ((docs.where("false"), items), (docs, items.where("false")), (docs.where("false"), items.where("false"))):
        assert ranked_search(d, i).collect() == []
    assert [tuple(r) for r in ranked_search(docs, items).collect()] == brute([(1, "a b")], [(1, "a")], 10)
