"""Languages of texts, spans of mixed texts, and the best path against all paths."""

import itertools
import os
import random

import numpy as np
import pytest

from weektide.llm import langid

GIVEN = "/root/testdata/sf0.01"

WORDS = {
    "en": "the and of that with from this have they which would there their what about".split(),
    "de": "der die und nicht mit sich auch nach über wird einer schon wenn können".split(),
    "ru": "и в не на что он как это по но из за так же от".split(),
}


def text(lang, n, pick):
    return " ".join(pick.choice(WORDS[lang]) for _ in range(n))


def test_best_path_equals_all_paths():
    rng = np.random.default_rng(1)
    first = np.array([0, 5, 5, 6, 12])
    emit = rng.normal(size=(12, 3)) * 15
    got = langid._viterbi(emit, first)
    for a, b in itertools.pairwise(first.tolist()):
        paths = itertools.product(range(3), repeat=b - a)
        value = lambda p, a=a: sum(emit[a + k, s] for k, s in enumerate(p)) - langid.SWITCH * sum(x != y for x, y in itertools.pairwise(p))
        assert np.isclose(max(map(value, paths)), value(got[a:b].tolist()))


def test_languages(spark):
    pick = random.Random(6)
    rows = [(k, text(lang, 40, pick), lang) for k, lang in enumerate(["en", "de", "ru"] * 40)]
    tables = langid.learn(spark.createDataFrame([*rows, (500, None, "en"), (501, "x", None)], "doc_id long, text string, lang string"))
    mixed = f"{text('en', 30, pick)} {text('de', 20, pick)}. {text('ru', 25, pick)}"
    new = [(k, text(lang, 12, pick), lang) for k, lang in enumerate(["en", "de", "ru"] * 5)]
    new += [(90, mixed, None), (91, None, None), (92, "", None), (93, "12 +% 7 — €", None), (None, "THE ÜBER and the", None)]
    docs = spark.createDataFrame([(*r, 3) for r in new], "doc_id long, text string, lang string, spans int")
    got = {r.doc_id: r for r in langid.languages(docs, tables).collect()}
    assert len(got) == len(new) and all(0 <= r.score <= 1 for r in got.values())
    assert all(got[k].lang_pred == lang for k, _, lang in new if lang)
    assert [(s.lang, s.first, s.words) for s in got[90].spans] == [("en", 0, 30), ("de", 30, 20), ("ru", 50, 25)]
    assert [(got[k].lang_pred, got[k].score, got[k].spans) for k in (91, 92, 93)] == [("und", 0.0, [])] * 3
    nothing = langid.learn(docs.where("false"))
    assert {r.lang_pred for r in langid.languages(docs, nothing).collect()} == {"und"}
    assert langid.languages(docs.where("false"), tables).collect() == []


def test_long_texts_repeats_and_ties(spark):
    """A very long text of two languages, repeated rows, and words of two languages in equal measure."""
    pick = random.Random(7)
    docs = spark.createDataFrame([(k, text(lang, 40, pick), lang) for k, lang in enumerate(["en", "de", "ru"] * 40)], "doc_id long, text string, lang string")
    tables = langid.learn(docs)
    long = f"{text('ru', 40_000, pick)}\n{text('en', 20_000, pick)}"
    rows = [(1, long), (2, text("de", 9, pick)), (2, text("en", 9, pick)), (3, "the der " * 50), (3, "the der " * 50)]
    got = langid.languages(spark.createDataFrame(rows, "doc_id long, text string"), tables).collect()
    assert len(got) == len(rows)
    (whole,) = [r for r in got if r.doc_id == 1]
    assert whole.lang_pred == "ru" and [(s.lang, s.words) for s in whole.spans] == [("ru", 40_000), ("en", 20_000)]
    assert {r.lang_pred for r in got if r.doc_id == 2} == {"de", "en"}
    tie = [(r.lang_pred, r.score) for r in got if r.doc_id == 3]
    assert tie[0] == tie[1] and tie[0][0] in ("de", "en")


@pytest.mark.skipif(not os.path.isdir(GIVEN), reason="given tables are not there")
def test_held_out_accuracy(spark):
    """On the given documents, of those that nothing was learned from."""
    from weektide.llm.queries import op8_language_id

    docs = spark.read.parquet(f"{GIVEN}/documents.parquet").where("lang is not null and text is not null")
    got = op8_language_id(spark, GIVEN).where("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) > 200 and sum(r.lang_pred == r.lang for r in got) >= 0.97 * len(got)
