"""Exact top-k search by inner product.

Method: Voronoi kNN join. Pivots cut the data into cells, and the first few of them cut the queries into
groups. Each cell's summary (size, radius, smallest distances to its pivot) bounds the scores between a
query group and a cell from both sides: a cell whose best possible score is below what k others surely
reach is not sent to that group. What is sent is cut into blocks and solved there; the best k of all
blocks are the answer. The bounds only save work: the answer is exact for any data and any pivots.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weektide.llm._shared import staged

#: Cells for each length of vectors, at least and at most; queries in a group and vectors in a block, about.
PIVOTS, MOST_PIVOTS, GROUP, BLOCK = 32, 1024, 1024, 8192
#: Vectors with larger components, after scaling, are multiplied as Python integers.
LARGE = 1 << 24


def _matrix(column: pa.Array) -> np.ndarray:
    data = column.to_pylist()
    return np.frombuffer(b"".join(data), np.float64).reshape(len(data), -1)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers, as long as they fit one, else as Python integers.

    Sums of small numbers are exact as floats or longs; rows with large ones are few, and cost more.
    """
    far_a, far_b = (np.abs(x).max(1, initial=0) > LARGE for x in (a, b))
    near = np.where(far_a[:, None], 0, a), np.where(far_b[:, None], 0, b)
    top = float(np.abs(near[0]).max(initial=0)) * float(np.abs(near[1]).max(initial=0)) * a.shape[1]
    if top < 2**53:
        out = (near[0] @ near[1].T).astype(np.int64)
    elif top < 2**63:
        out = near[0].astype(np.int64) @ near[1].astype(np.int64).T
    else:  # vectors of very many components
        far_a, out = np.ones(len(a), bool), np.zeros((len(a), len(b)), np.int64)
    if far_a.any() or far_b.any():
        whole = lambda x: np.frompyfunc(int, 1, 1)(x)
        out = out.astype(object)
        if far_a.any():
            out[far_a] = whole(a[far_a]) @ whole(b).T
        if far_b.any():
            out[np.ix_(~far_a, far_b)] = whole(a[~far_a]) @ whole(b[far_b]).T
    return out


def _scaled(batches: Iterator[pa.RecordBatch], scale: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, kept = [], []
        for k, vector in enumerate(batch["embedding"].to_pylist()):
            if vector and None not in vector:
                values = np.floor(scale * np.array(vector, np.float64))
                if np.isfinite(values).all():
                    ids.append(k)
                    kept.append((values + 0.0).tobytes())
        size = pa.array([len(x) // 8 for x in kept], pa.int32())
        yield pa.record_batch([batch["vec_id"].take(pa.array(ids, pa.int64())), size, pa.array(kept, pa.binary())], ["vec_id", "size", "v"])


def top_k(vectors: DataFrame, queries: str = "vec_id % 50 = 0", k: int = 5, scale: float = 256.0) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the ``k`` best rows for each query.

    ``vectors`` needs vec_id (integer) and embedding (array of numbers); other columns are ignored. A
    component x becomes floor(scale * x). Queries are the rows that meet ``queries``, an expression on
    vec_id; candidates are all rows of another vec_id with as many components. Scores are integer inner
    products, ties go to the smaller vec_id; with fewer than k candidates all are returned. Null and empty
    vectors, and those with null or (scaled) non-finite components take no part, nor do rows without
    vec_id; a score among the best that does not fit a long fails the query; rows of one vec_id count once, with the smallest of their vectors in the
    order of bytes. An empty table, or no query, gives an empty result.
    """
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).where("vec_id is not null")
    rows = rows.mapInArrow(lambda batches: _scaled(batches, scale), "vec_id long, size int, v binary")
    rows = rows.groupBy("vec_id").agg(F.min_by("size", "v").alias("size"), F.min("v").alias("v"))
    rows = staged(rows.withColumn("is_query", F.expr(queries)), "vectors")

    # Cells grow with the square root of the rows, up to a bound.
    cells_wanted = min(MOST_PIVOTS, max(PIVOTS, math.isqrt(rows.count()) // 8))
    by_length = Window.partitionBy("size").orderBy(F.xxhash64("vec_id"), "vec_id")
    drawn = rows.withColumn("k", F.row_number().over(by_length)).where(f"k <= {cells_wanted}").orderBy("size", "k").collect()
    wanted = {r["size"]: -(-r["n"] // GROUP) for r in rows.where("is_query").groupBy("size").agg(F.count("*").alias("n")).collect()}
    pivots = [np.frombuffer(r["v"], np.float64) for r in drawn]
    cells: dict[int, list[int]] = {}
    for number, r in enumerate(drawn):
        cells.setdefault(r["size"], []).append(number)
    groups = {size: own[: wanted.get(size, 0)] for size, own in cells.items()}

    def nearest(v: np.ndarray, own: list[int]) -> tuple[np.ndarray, np.ndarray]:
        p = np.stack([pivots[n] for n in own])
        with np.errstate(over="ignore"):  # very far is infinitely far
            far = np.stack([np.sqrt(((v - row) ** 2).sum(1)) for row in p], 1)
        best = far.argmin(1)
        return np.array(own)[best], far[np.arange(len(v)), best]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, query = np.asarray(batch["size"]), batch["is_query"].to_numpy(zero_copy_only=False).astype(bool)
            cell, group = np.zeros(len(batch), np.int32), np.full(len(batch), -1, np.int32)
            far, near = np.zeros(len(batch)), np.zeros(len(batch))
            for s in np.unique(size).tolist():
                at = np.flatnonzero(size == s)
                v = _matrix(batch["v"].take(pa.array(at)))
                cell[at], far[at] = nearest(v, cells[s])
                if groups[s]:
                    asks = query[at]
                    if asks.any():
                        group[at[asks]], near[at[asks]] = nearest(v[asks], groups[s])
            columns = [batch["vec_id"], batch["v"], *map(pa.array, (cell, far, group, near))]
            yield pa.record_batch(columns, ["vec_id", "v", "cell", "far", "asks", "near"])

    placed = staged(rows.mapInArrow(assign, "vec_id long, v binary, cell int, far double, asks int, near double"), "placed")

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, tuple[int, float, list[float]]] = {}
        for batch in batches:
            cell, far = np.asarray(batch["cell"]), np.asarray(batch["far"])
            for c in np.unique(cell).tolist():
                own = np.sort(far[cell == c])
                n, top, least = seen.get(c, (0, 0.0, []))
                seen[c] = n + len(own), max(top, float(own[-1])), sorted([*least, *own[: k + 1].tolist()])[: k + 1]
        columns = zip(*((c, *x) for c, x in seen.items()), strict=True) if seen else ([], [], [], [])
        types = pa.int32(), pa.int64(), pa.float64(), pa.list_(pa.float64())
        yield pa.record_batch([pa.array(list(x), t) for x, t in zip(columns, types, strict=True)], ["cell", "n", "radius", "least"])

    summary = placed.select("cell", "far").mapInArrow(summarise, "cell int, n long, radius double, least array<double>")
    summary = summary.groupBy("cell").agg(
        F.sum("n").alias("n"), F.max("radius").alias("radius"), F.slice(F.array_sort(F.flatten(F.collect_list("least"))), 1, k + 1).alias("least")
    )
    data = {r["cell"]: r for r in summary.collect()}
    asking = placed.where("asks >= 0").groupBy("asks").agg(F.count("*").alias("n"), F.max("near").alias("radius")).collect()
    sends: dict[int, list[tuple[int, int]]] = {c: [] for c in data}
    asks: dict[int, list[tuple[int, int]]] = {}
    blocks = {c: -(-r["n"] // BLOCK) for c, r in data.items()}
    parts = {g["asks"]: -(-g["n"] // GROUP) for g in asking}
    # A bound that cannot be told, of products beyond all floats, leaves nothing out.
    told = lambda x, unknown: unknown if math.isnan(x) else x
    for g in asking:
        with np.errstate(over="ignore", invalid="ignore"):
            centre, spread = pivots[g["asks"]], np.float64(g["radius"])
            norm, low, high = np.linalg.norm(centre) + spread, [], {}
            for c, r in data.items():
                if len(pivots[c]) == len(centre):
                    middle, slack = centre @ pivots[c], spread * np.linalg.norm(pivots[c])
                    low += [told(middle - slack - norm * d, -np.inf) for d in r["least"]]
                    high[c] = told(middle + slack + norm * r["radius"], np.inf)
            low.sort(reverse=True)
            # k others besides the query itself surely reach this; a little less, as these are floats.
            sure = low[k] if len(low) > k else -np.inf
            sure = told(sure - 1e-9 * abs(sure), -np.inf)
            needed = [c for c, top in high.items() if told(top + 1 + 1e-9 * abs(top), np.inf) >= sure]
        asks[g["asks"]] = [(c, b) for c in needed for b in range(blocks[c])]
        for c in needed:
            sends[c] += [(g["asks"], part) for part in range(parts[g["asks"]])]
    spark = placed.sparkSession
    pair = "array<struct<x:int,y:int>>"
    sends_to = spark.createDataFrame([(c, blocks[c], to) for c, to in sends.items() if to], f"cell int, blocks int, to {pair}")
    asks_of = spark.createDataFrame([(g, parts[g], to) for g, to in asks.items()], f"asks int, parts int, to {pair}")
    salt = lambda n: F.pmod(F.xxhash64("vec_id"), F.col(n)).cast("int")
    sent = placed.join(sends_to, "cell").select("vec_id", "v", "cell", salt("blocks").alias("block"), F.explode("to").alias("to"))
    sent = sent.select("vec_id", "v", "cell", "block", F.col("to.x").alias("asks"), F.col("to.y").alias("part"))
    asked = placed.join(asks_of, "asks").select("vec_id", "v", "asks", salt("parts").alias("part"), F.explode("to").alias("to"))
    # Names of its own, as both sides come from one table.
    asked = asked.select(*(F.col(c).alias(f"q_{c}") for c in ("vec_id", "v", "asks", "part")), F.col("to.x").alias("q_cell"), F.col("to.y").alias("q_block"))
    key = ["asks", "part", "cell", "block"]

    def solve(data, queries):
        ids, names = np.asarray(data["vec_id"]), np.asarray(queries["q_vec_id"])
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if len(ids) and len(names):
            x, q = _matrix(data["v"]), _matrix(queries["q_v"])
            order = np.argsort(ids, kind="stable")
            ids, x = ids[order], x[order]
            for at in range(0, len(names), 128):
                scores = _products(q[at : at + 128], x)
                for name, row in zip(names[at : at + 128], scores, strict=True):
                    best = np.argsort(-row, kind="stable")[: k + 1] if len(row) <= 64 else _best(row, k + 1)
                    best = best[ids[best] != name][:k]
                    out.append((np.full(len(best), name), ids[best], row[best]))
        columns = [np.concatenate([o[c] for o in out]).tolist() if out else [] for c in range(3)]
        return pa.table([pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"])

    found = sent.groupBy(key).cogroup(asked.groupBy([f"q_{c}" for c in key])).applyInArrow(solve, "query_id long, vec_id long, score long")
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _best(row: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest values, ties to the smaller place."""
    least = np.partition(row, len(row) - k)[len(row) - k]
    sure, ties = np.flatnonzero(row > least), np.flatnonzero(row == least)
    best = np.concatenate([sure, ties[: k - len(sure)]])
    return best[np.lexsort((best, -row[best]))]
