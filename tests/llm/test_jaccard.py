"""The Jaccard join against all pairs, with small and large tiles."""

import itertools
import random
import re

import numpy as np
import pytest

from weektide.llm import jaccard


def brute(rows, n, percent):
    sets = {}
    for doc, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        runs = [tuple(words[k : k + n]) for k in range(len(words) - n + 1)] or ([tuple(words)] if words else [])
        sets[doc] = set(runs)
    root = {d: d for d in sets}

    def top(d):
        while root[d] != d:
            d = root[d]
        return d

    for (a, x), (b, y) in itertools.combinations(sorted(sets.items()), 2):
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            a, b = sorted((top(a), top(b)))
            root[b] = a
    return {d: (len(sets[d]), top(d)) for d in sets}


def changed(words, times, pick):
    words = list(words)
    for _ in range(times):
        at, kind = pick.randrange(len(words)), pick.random()
        if kind < 0.4:
            words[at] = f"w{pick.randrange(999)}"
        elif kind < 0.7:
            words.insert(at, f"w{pick.randrange(999)}")
        elif len(words) > 1:
            del words[at]
    return words


@pytest.fixture(scope="module")
def rows():
    pick = random.Random(5)
    passage = [f"p{k}" for k in range(30)]
    out = [(1, None), (2, ""), (4, " \n\t")]
    for size in (1, 2, 3, 4, 9, 10, 12, 25, 60, 60, 200):
        base = [f"w{pick.randrange(999)}" for _ in range(size)]
        base = base[: size // 2] + passage * (size == 60) + base[size // 2 :]
        for _ in range(8):
            out.append((3 * len(out) + 7, " ".join(changed(base, pick.choice([0, 0, 1, 1, 2, 4]), pick))))
    return out


@pytest.mark.parametrize(
    ("n", "percent", "sets", "keys"),
    [(3, 90, 2000, 10**6), (5, 80, 2000, 10**6), (5, 80, 10, 10**6), (5, 80, 10, 300), (3, 100, 2000, 10**6)],
)
def test_equals_all_pairs(spark, rows, monkeypatch, n, percent, sets, keys):
    monkeypatch.setattr(jaccard, "BLOCK_SETS", sets)
    monkeypatch.setattr(jaccard, "TASK_KEYS", keys)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_groups(docs, n, percent).collect()}
    assert got == brute(rows, n, percent)


def test_linked_nodes_travel_as_one():
    """Keys of nodes that a task has connected name one node; the links keep every node of the group."""
    group, alone = np.arange(10, 60, dtype=np.uint64), np.array([3, 99], np.uint64)
    pairs = [(k, n) for n in group for k in range(20) if (int(n) + k) % 7] + [(1_000 + int(n), n) for n in alone]
    keys, nodes = (np.array(x, np.uint64) for x in zip(*pairs, strict=True))
    table = jaccard._packed(keys, nodes, 5)
    keys, nodes, a, b = (np.frombuffer(b"".join(table[c].to_pylist()), np.uint64) for c in ("keys", "nodes", "a", "b"))
    assert dict(zip(keys.tolist(), nodes.tolist(), strict=True)) == {k: 10 for k in range(20)} | {1_003: 3, 1_099: 99}
    assert sorted(zip(a.tolist(), b.tolist(), strict=True)) == [(n, 10) for n in range(11, 60)]


def test_groups_over_many_tasks(spark):
    """Near copies dealt over many partitions: what the tasks send grows with tasks and keys, not with the copies."""
    pick = random.Random(11)
    base = [f"b{k}" for k in range(120)]
    rows = [(k, " ".join(changed(base, pick.choice([1, 2, 3]), pick))) for k in range(240)]
    rows += [(1_000 + k, " ".join(f"x{pick.randrange(10**6)}" for _ in range(30))) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(24)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_groups(docs, 5, 80).collect()}
    assert got == brute(rows, 5, 80)


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(9, "A b c d", 1), (9, "a b c d", 1), (3, "a B c d", 1), (3, "a B c d", 1), (3, "x y z a b c d e f g h", 1), (3, "x y z a b c d e f g h", 1), (4, "x y z a b c d e f g h i", 1), (None, "a b c d", 1), (5, None, 1)],
        "doc_id long, text string, component_id int",
    )
    got = sorted(map(tuple, jaccard.jaccard_groups(docs, 3, 90).collect()), key=str)
    assert got == sorted([(9, 2, 3), (9, 2, 3), (3, 2, 3), (3, 2, 3), (3, 9, 3), (3, 9, 3), (4, 10, 3), (None, 2, None), (5, 0, 5)], key=str)
    assert jaccard.jaccard_groups(docs.where("doc_id = 0"), 3, 90).collect() == []


def test_very_long_texts(spark):
    pick = random.Random(5)
    long = [f"w{pick.randrange(10**6)}" for _ in range(40_000)]
    near, far = list(long), list(long)
    near[::2000] = ["other"] * len(near[::2000])
    far[::20] = ["other"] * len(far[::20])
    docs = [(3, " ".join(long)), (2, " ".join(near)), (1, " ".join(far)), (4, "short text")]
    got = jaccard.jaccard_groups(spark.createDataFrame(docs, "doc_id long, text string"), words=3, percent=90).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(docs, 3, 90)
    assert {r.doc_id: r.component_id for r in got} == {1: 1, 2: 2, 3: 2, 4: 4}
