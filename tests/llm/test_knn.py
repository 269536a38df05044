"""Top-k search against all scores."""

import math

import numpy as np
import pytest

from weektide.llm import knn


def brute(rows, k):
    whole = {}
    for name, vector in rows:
        if name is not None and vector and all(x is not None and math.isfinite(x) for x in vector):
            whole[name] = [math.floor(256 * x) for x in vector]
    out = []
    for q in whole:
        if q % 5 == 0:
            scores = [(-sum(a * b for a, b in zip(whole[q], v, strict=True)), n) for n, v in whole.items() if n != q and len(v) == len(whole[q])]
            out += [(q, r + 1, n, -s) for r, (s, n) in enumerate(sorted(scores)[:k])]
    return sorted(out)


@pytest.mark.parametrize("block", [8192, 40])
def test_equals_all_scores(spark, monkeypatch, block):
    monkeypatch.setattr(knn, "BLOCK", block)
    monkeypatch.setattr(knn, "GROUP", block // 4)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 8)) * 3
    rows = [(n, (centres[n % 6] + rng.normal(size=8) * 0.05).tolist()) for n in range(300)]
    rows += [(n, centres[0].tolist()) for n in range(300, 360)]  # ties
    rows += [(n, [5e4, -7e4, float(n)]) for n in range(400, 410)]  # another length, large products
    rows += [(700, None), (701, []), (702, [None] * 8), (703, [float("nan")] * 8), (705, [float("inf")] * 8), (None, rows[0][1])]
    table = spark.createDataFrame([(*r, 1) for r in [*rows, rows[5]]], "vec_id long, embedding array<double>, score int")
    got = sorted(map(tuple, knn.top_k(table, "vec_id % 5 = 0", 5).collect()))
    assert got == brute(rows, 5)


def test_few_rows(spark):
    table = spark.createDataFrame([(0, [1.0, 2.0]), (1, [0.5, 0.25])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in knn.top_k(table).collect()] == [(0, 1, 1, 256 * 128 + 512 * 64)]
    assert knn.top_k(table.where("false")).collect() == []
    assert knn.top_k(table, "vec_id < 0").collect() == []


def test_bounds_leave_cells_out(spark):
    rng = np.random.default_rng(4)
    centres = np.eye(8) * 50
    rows = [(n, (centres[n % 8] + rng.normal(size=8) * 0.01).tolist()) for n in range(800)]
    assert sorted(map(tuple, knn.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id % 5 = 0").collect())) == brute(rows, 5)


def test_large_components_take_part(spark):
    """Finite vectors of any size are queries and candidates; scores are exact."""
    rows = [(0, [2e6, 1.0]), (1, [3e6, 1.0]), (2, [1.0, 1.0]), (50, [1.0, 0.0]), (55, [1e7, -1e7]), (60, [-1e6, 3e6]), (65, [0.0, 0.0])]
    rows += [(n, [1e5 + n / 7, n / 3 - 1e5]) for n in range(100, 180)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, knn.top_k(table, "vec_id % 5 = 0", 5).collect())) == brute(rows, 5)
    huge = [(0, [1e12, 0.0]), (5, [0.0, 7.0]), (10, [1e200, 2.0]), (15, [-1e300, 0.0]), (21, [0.0, 1e12]), (22, [0.0, 0.0])]
    table = spark.createDataFrame(huge, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, knn.top_k(table, "vec_id = 5", 3).collect())) == [x for x in brute(huge, 3) if x[0] == 5]
    with pytest.raises(Exception, match="(?i)too large|overflow|int64|long"):
        knn.top_k(table, "vec_id = 0", 5).collect()
