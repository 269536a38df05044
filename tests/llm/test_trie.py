"""The trie of conversations against plain sequences."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from weektide.llm import trie
from weektide.llm.trie import conversation_trie

SCHEMA = "conv_id long, turn int, role string, text string, k1 string"


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(turns)] for c, turns in own.items()}
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        paths[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    out = []
    for node, convs in members.items():
        under = [x for x in members if x[: len(node)] == node]
        parents = {x[:-1] for x in members if x}
        words = lambda x: len(re.findall(r"[^\x20\x09-\x0D]+", x[-1][1])) if x else 0
        ends = ",".join(str(c) for c in sorted(convs) if len(paths[c]) == len(node))
        out.append((
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs),
            sum(1 for x in members if x and x[:-1] == node), sum(x not in parents for x in under),
            sum((len(members[x]) - 1) * words(x) for x in under), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return out


def check(spark, rows):
    got = conversation_trie(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)).drop("k1", "k2", "p1", "p2")
    got = [tuple(r) for r in got.collect()]
    assert sorted(got, key=str) == sorted(brute(rows), key=str)


def rows_of(pick, ids, longest):
    said = [None, "", "a b", "one  two\nthree", "x", "　y z"]
    for c in ids:
        for turn in range(pick.randrange(1, longest)):
            yield (c, turn if pick.random() < 0.9 else None, pick.choice(["user", "assistant", None]), pick.choice(said))


@pytest.mark.parametrize(("shard", "band", "span"), [(512, 256, 4096), (8, 3, 4), (1, 1, 1)])
def test_equals_plain_sequences(spark, monkeypatch, shard, band, span):
    for name, value in (("SHARD", shard), ("BAND", band), ("RANGE", span)):
        monkeypatch.setattr(trie, name, value)
    pick = random.Random(shard)
    ids = [*range(30), 41, 42, 45, 63, 100, 119, -5, -20, -31, 10**12 + 3]
    rows = list(rows_of(pick, ids, 9))
    rows += [(c, t, r, x) for c in range(200, 240) for _, t, r, x in rows[:6]]  # copies
    rows += [(None, 0, "user", "nobody's"), *rows[:4]]
    check(spark, rows)


def test_long_conversations(spark):
    """Conversations over several bands, with the same turns up to the middle of one."""
    rows = [(c, t, "user", f"turn {t}" if t < 400 + c % 3 else f"own {t % 7} {c % 5}") for c in range(7) for t in range(640 + c)]
    turns = conversation_trie(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)).drop("k1", "k2", "p1", "p2")
    got = {tuple(r) for r in turns.collect()}
    # The brute force is quadratic: the same over the tree of prefixes.
    own = {c: [f"turn {t}" if t < 400 + c % 3 else f"own {t % 7} {c % 5}" for t in range(640 + c)] for c in range(7)}
    paths = {c: (own[0][: zlib.crc32(str(c).encode()) % 4] + x[zlib.crc32(str(c).encode()) % 4 :]) for c, x in own.items()}
    members = defaultdict(list)
    for c, path in paths.items():
        key = hashlib.sha256()
        members[(0, key.digest(), None)].append(c)
        for d, text in enumerate(path, 1):
            above = key.digest()
            key.update(text.encode() + b"\0")
            members[(d, key.digest(), above)].append(c)
    kids, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    want = set()
    first = {k[1]: min(v) for k, v in members.items()}
    for (d, key, above), convs in sorted(members.items(), key=lambda x: -x[0][0]):
        leaves[key] += kids[key] == 0
        saved[key] += 2 * (len(convs) - 1) if d and d <= 400 else 3 * (len(convs) - 1) if d and any(paths[c][d - 1].startswith("own") for c in convs) else 2 * (len(convs) - 1) * bool(d)
        ends = ",".join(str(c) for c in sorted(convs) if len(paths[c]) == d)
        want.add((min(convs), d, first.get(above), len(convs), kids[key], leaves[key], saved[key], hashlib.sha256(ends.encode()).hexdigest()))
        kids[above] += 1
        leaves[above] += leaves[key]
        saved[above] += saved[key]
    assert got == want


def test_empty(spark):
    assert conversation_trie(spark.createDataFrame([], SCHEMA)).collect() == []
    check(spark, [(7, None, None, None)])
