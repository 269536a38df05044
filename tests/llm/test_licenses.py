"""License scans against a plain search in Python."""

import random
import re

import pytest

from weektide.llm.licenses import PHRASES, TEMPLATES, license_scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def told_apart(templates, percent):
    """For each template: what a run must hold to be it, and the wider templates that it is a part of."""
    sets, out = [(label, set(t.split())) for label, t in templates], []
    for label, own in sets:
        near = [(k, other) for k, (name, other) in enumerate(sets) if name != label and 100 * len(own & other) >= percent * len(own)]
        out.append((set().union(*(own - other for _, other in near)), [k for k, other in near if own <= other]))
    return out


def every_run(text, templates=TEMPLATES, reach=2, percent=80):
    """Labels and score by all runs of ``reach`` times a template's words."""
    words, runs = words_of(text), []
    told = told_apart(templates, percent)
    for (label, template), (must, _) in zip(templates, told):
        want, span = set(template.split()), reach * len(template.split())
        own = {}
        for k in range(len(words)):
            held = want & set(words[k : k + span])
            if 100 * len(held) >= percent * len(want) and must <= held:
                own[k] = len(held) / len(want)
        runs.append((span, own))
    labels, score = set(), 0.0
    for (label, _), (_, wider), (span, own) in zip(templates, told, runs):
        for k, share in own.items():
            if not any(j - span < k < j + runs[w][0] and j < k + span and k < j + runs[w][0] for w in wider for j in runs[w][1]):
                labels.add(label)
                score = max(score, share)
    return labels, score


def brute(text, templates=TEMPLATES, phrases=PHRASES, reach=2):
    words = words_of(text)
    places, base = [], set()
    labels, score = every_run(text, templates, reach)
    for phrase, label in phrases:
        p = phrase.split()
        found = [k for k in range(len(words) - len(p) + 1) if words[k : k + len(p)] == p]
        places += found
        if found:
            base.add(label)
            labels.add(label)
            score = 1.0
    first, last = (min(places), max(places)) if places else (None, None)
    return len(words), len(places), first, last, ",".join(sorted(base)), ",".join(sorted(labels)), pytest.approx(score)


@pytest.mark.parametrize("reach", [1, 2])
def test_equals_plain_search(spark, reach):
    pick = random.Random(11 + reach)
    long = ("long", " ".join(f"term{k}" for k in range(150)))
    templates = [*TEMPLATES, long, ("short", "one two three"), ("longer", "one two three four")]
    texts = [None, "", "\n\n", "All rights reserved", "CC-BY cc by", "general public license " * 3, "all rights", "é" * 70, long[1]]
    texts += [t for _, t in templates]
    for _ in range(250):
        parts = []
        for _ in range(pick.choice([1, 2, 5])):
            own = pick.choice([*(t for _, t in templates), *(p for p, _ in PHRASES)]).split()
            for _ in range(pick.choice([0, 1, 3])):
                own[pick.randrange(len(own))] = pick.choice(["other", "license", "the", "gap gap gap gap gap", "sa", "nc"])
            fill = [pick.choice(["filler", "Words", "the", "under"]) for _ in range(pick.choice([0, 5, 50, 90]))]
            words = " ".join(fill + own + fill[:20]).split()
            width = pick.choice([3, 7, 1000])
            parts.append("\n".join(" ".join(words[k : k + width]) for k in range(0, len(words), width)) + pick.choice(["\n", ". "]))
        texts.append("".join(parts))
    rows = [(k, t, "x") for k, t in enumerate(texts)] + [(None, texts[3], "x"), (3, texts[3], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, labels string")
    got = license_scan(docs, templates=templates, reach=reach).collect()
    assert len(got) == len(rows)
    for r in got:
        text = texts[3 if r.doc_id is None else r.doc_id]
        assert tuple(r)[1:] == brute(text, templates, reach=reach), text
    assert license_scan(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_near_templates_are_told_apart(spark):
    kinds = {"BY": "cc-by", "BY-NC": "cc-by,cc-by-nc", "BY-SA": "cc-by,cc-by-sa", "BY-ND": "cc-by,cc-by-nd", "BY-NC-SA": "cc-by,cc-by-nc-sa"}
    texts = [f"{head}Licensed under CC {kind} 4.0.{tail}" for kind in kinds for head in ("", "some words before\n") for tail in ("", " And others after it")]
    texts.append("Redistribution and use in source and binary forms, with or without\nmodification, are permitted")
    texts.append("This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0.")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.labels for r in license_scan(docs).collect()}
    want = [labels for labels in kinds.values() for _ in range(4)] + ["bsd", "mpl-2.0"]
    assert [got[k] for k in range(len(texts))] == want
    assert all(labels == want[k] for k, labels in got.items())


def test_each_filter_leaves_records_out():
    """Records against one template of ten words by rank, eight of them needed: prefix, length, position."""
    import numpy as np

    from weektide.llm.licenses import Index, Template

    plan = Template("x", list(range(0, 20, 2)), 8, 20)
    index = Index([plan, Template("y", [1, 3], 2, 20)], [0], np.arange(40))
    records = [
        list(range(0, 20, 2)),  # all words
        [6, 8, 10, 12, 14, 16, 18, 19],  # no word of the prefix 0, 2, 4
        [0, 2, 4],  # too short
        [1, 3, 5, 7, 4, 6, 8, 10],  # long enough, but six words follow from the first shared one
        [4, 6, 8, 10, 12, 14, 16, 18],  # just enough
    ]
    flat = [(r, w) for r, words in enumerate(records) for w in sorted(words)]
    record, rank = (np.array([x[k] for x in flat]) for k in range(2))
    assert index.candidates(record, rank).tolist() == [0, 4]
    assert index.candidates(record, rank, positional=False).tolist() == [0, 3, 4]


def test_a_very_long_text(spark):
    notice = dict(TEMPLATES)["isc"]
    text = "word filler\n" * 60_000 + notice.upper() + " tail" * 50_000 + " licensed under cc by sa 4 0"
    docs = spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in license_scan(docs).collect()}
    assert (got[1].labels, got[1].base_labels, got[1].n_base, got[1].score) == ("cc-by,cc-by-sa,isc", "cc-by", 1, 1.0)
    assert got[1].first_word == 120_000 + len(notice.split()) + 50_000 + 2
