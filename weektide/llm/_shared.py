"""Tables between steps, written to the folder that all executors share."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


#: Edges that one task folds at a time, about: sixteen bytes each.
EDGES = 250_000


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; where it is unset, one in the warehouse, which is shared too."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_steps"
    return folder.rstrip("/")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` once below the shared folder and returns the table read from there.

    It cuts the lineage: a lost executor costs no more than the step at hand. The files stay until
    the owner of the folder removes them, as the returned plan reads them.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Whole texts go to Python a thousand rows at a time instead of ten thousand: it bounds what a task holds."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= 1000:
        spark.conf.set(key, "1000")


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node that its edges reach), by node, for the nodes of the edges (a, b) that reach a smaller one."""
    nodes, at = np.unique(np.stack([a, b]), return_inverse=True)
    a, b = at.reshape(2, -1)
    root, before = np.arange(len(nodes)), None
    while before is None or (root != before).any():
        before = root.copy()
        low = np.minimum(root[a], root[b])
        for end in (a, b):
            np.minimum.at(root, root[end], low)
            np.minimum.at(root, end, low)
        root = root[root]
    away = np.flatnonzero(root != np.arange(len(root)))
    return nodes[away], nodes[root[away]]


def _forest(batches):
    """The forest of the edges (a, b) of one partition."""
    pairs = [np.stack([x["a"].to_numpy(), x["b"].to_numpy()]) for x in batches if len(x)]
    if not pairs:
        return
    yield pa.record_batch([pa.array(x) for x in forest(*np.concatenate(pairs, axis=1))], ["a", "b"])


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of ``edges`` (a, b: long): rows (node, component), component the smallest node.

    Each task folds its edges into stars, at most about EDGES of them at a time; once they all fit one
    task, that is the answer. Until then large-star and small-star steps join what the tasks have found,
    until every node points to a node that points nowhere. Minima are folded before the shuffle, and
    the joins read written tables on both sides, so that the adaptive plan can split the rows of a
    node with very many neighbours. Nothing passes through the driver but counts and a checksum.
    """
    sums = (F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum"))

    def kept(df: DataFrame, *measures) -> tuple[DataFrame, dict]:
        seen = Observation()
        return staged(df.observe(seen, *measures), name), seen.get

    def folded(df: DataFrame) -> tuple[DataFrame, dict]:
        return kept(df.mapInArrow(_forest, "a long, b long").distinct(), *sums)

    now, before = folded(edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b"))
    while before["n"]:
        tasks = -(-before["n"] // EDGES)
        if tasks == 1:
            now = staged(now.coalesce(1).mapInArrow(_forest, "a long, b long"), name)
            break
        now, before = folded(now.coalesce(tasks))
        # Large star: every larger neighbour of a node points to the node's smallest neighbour.
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = staged(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), name)
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large, after = kept(large.where("a <> b").distinct(), *sums)
        # Small star: a node and its smaller neighbours point to the smallest of them.
        least, nodes = kept(large.groupBy("a").agg(F.min("b").alias("m")), F.count("*").alias("n"))
        if after == before and nodes["n"] == after["n"]:
            break
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        now, before = folded(small.unionByName(least.select("a", F.col("m").alias("b"))))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
