"""Connected components of small graphs against a plain search."""

import random

import pytest

from weektide.llm import _shared
from weektide.llm._shared import components


def brute(edges):
    root = {n: n for e in edges for n in e}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        a, b = sorted((top(a), top(b)))
        root[b] = a
    return {n: top(n) for n in root if any(n in e and e[0] != e[1] for e in edges)}


@pytest.mark.parametrize("edges_of_a_task", [250_000, 20])
@pytest.mark.parametrize("kind", ["chain", "star", "random", "none"])
def test_components(spark, monkeypatch, kind, edges_of_a_task):
    monkeypatch.setattr(_shared, "EDGES", edges_of_a_task)
    pick = random.Random(1)
    edges = {
        "chain": [(k, k + 1) for k in range(60)],
        "star": [(500, k) for k in range(60)],
        "random": [(pick.randrange(-80, 80), pick.randrange(-80, 80)) for _ in range(70)],
        "none": [(3, 3)],
    }[kind]
    pick.shuffle(edges)
    found = components(spark.createDataFrame(edges, "a long, b long").repartition(7)).collect()
    assert len(found) == len({r.node for r in found})
    assert {r.node: r.component for r in found} == brute(edges)
