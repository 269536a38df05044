"""Removal of repeated passages against a count of all windows."""

import hashlib
import random
import re
from collections import Counter

import pytest

from weektide.llm.substrings import remove_repeats


def brute(texts, size):
    lists = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    count = Counter(tuple(x[k : k + size]) for x in lists for k in range(len(x) - size + 1))
    out = []
    for x in lists:
        gone = set()
        for k in range(len(x) - size + 1):
            if count[tuple(x[k : k + size])] > 1:
                gone.update(range(k, k + size))
        kept = " ".join(w for k, w in enumerate(x) if k not in gone)
        out.append((len(x), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


@pytest.mark.parametrize(("size", "group", "bucket"), [(35, 8, None), (12, 4, 3), (12, 4, None)])
def test_equals_all_windows(spark, size, group, bucket):
    pick = random.Random(2)
    prose = lambda n: [f"{pick.choice('abcdé')}{pick.randrange(400)}" for _ in range(n)]
    passages = [prose(n) for n in (size - 1, size, size + 1, 60, 90)]
    texts = [None, "", " \n", "one", " ".join("ab" * 50), " ".join(["x"] * 100), " ".join(["p", "q"] * 80), " ".join(["x"] * 60)]
    for _ in range(60):
        own = prose(pick.choice([0, 5, 40, 300]))
        for _ in range(pick.choice([0, 1, 2])):
            at = pick.randrange(len(own) + 1)
            own[at:at] = pick.choice(passages)
        texts.append(pick.choice([" ", "\n", " \t"]).join(own))
    texts += [texts[-1], texts[-1], texts[-3]]
    rows = [(k, t, 1) for k, t in enumerate(texts)]
    got = remove_repeats(spark.createDataFrame(rows, "doc_id long, text string, k1 int"), size, group, bucket).collect()
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got}
    assert got == dict(enumerate(brute(texts, size)))


def test_odd_rows(spark):
    text = " ".join(map(str, range(50)))
    docs = spark.createDataFrame([(None, text), (3, text), (3, text), (4, None)], "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_words, r.n_removed) for r in remove_repeats(docs).collect())
    assert got == [("3", 50, 50), ("3", 50, 50), ("4", 0, 0), ("None", 50, 50)]
    assert remove_repeats(docs.where("false")).collect() == []


@pytest.mark.parametrize("bucket", [None, 50])
def test_common_passages(spark, bucket):
    """A passage in 1,500 texts, a line shorter than a window in as many others, and a very long text with both."""
    pick = random.Random(6)
    prose = lambda n: [f"{pick.choice('abcdé')}{pick.randrange(10**6)}" for _ in range(n)]
    passage, line, long = prose(50), prose(34), prose(30_000)
    long[900:900] = passage
    long[20_000:20_000] = line
    texts = [" ".join(prose(3) + passage + prose(4)) for _ in range(1500)]
    texts += [" ".join(prose(20) + line + prose(20)) for _ in range(1500)] + [" ".join(long)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in remove_repeats(docs, bucket=bucket).collect()}
    assert got == dict(enumerate(brute(texts, 35)))
