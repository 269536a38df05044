"""Ranked lexical search: the best documents for each item of a query set, by weighted terms.

Method: a document FP-tree. A document's terms, restricted to those of the items and ordered by frequency, are
its path; documents with equal beginnings share it. Sorted by their paths, the documents below any node of the
tree are neighbours, so the tree is that order and the length of the beginning that neighbours share. An item
walks it depth first: the largest term counts and the smallest length measure below a node bound all scores
there, and a node whose bound is below the item's k-th score so far is left out.

Each task builds trees of a bounded number of documents from its own rows; no document is shuffled. The items
come in blocks of bounded size, one pass over the restricted vectors each. Statistics cover all documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weektide.llm._shared import small_batches, staged
from weektide.llm._words import LETTERS, LOWER, slices, split, utf8

#: Documents and terms of a tree; documents of a node that are scored at once; terms of a block of items.
TREE_DOCS, TREE_TERMS, LEAF, BLOCK_TERMS = 8192, 1_000_000, 32, 500_000
#: Bits of the filter of the items' terms: what passes it wrongly is told apart later.
FILTER_BITS = 1 << 23
#: Fixed values of the score.
UNIT, TF, LENGTH, BASE, SHARE = 1_000_000_000, 1000, 8, 100 - 75, 75


def _counted(batches: Iterator[pa.RecordBatch], name: str, bits: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """name, n (terms of the text), terms (hashes, ascending), tfs; with ``bits``, of the terms in them only."""
    for batch in batches:
        for part in slices(batch):
            data, offsets = utf8(part["text"])
            words = split(LOWER[data], offsets, LETTERS)
            rows, values = words.row, words.hashes()
            if bits is not None:
                at = values & np.uint64(FILTER_BITS - 1)
                held = (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
                rows, values = rows[held], values[held]
            order = np.lexsort((values, rows))
            rows, values = rows[order], values[order].view(np.int64)
            new = np.ones(len(rows), bool)
            new[1:] = (rows[1:] != rows[:-1]) | (values[1:] != values[:-1])
            first = np.flatnonzero(new)
            tf = np.diff(np.append(first, len(rows)))
            ends = pa.array(np.searchsorted(rows[first], np.arange(len(part) + 1)), pa.int32())
            yield pa.record_batch(
                [
                    part[name],
                    pa.array(words.counts, pa.int64()),
                    pa.ListArray.from_arrays(ends, pa.array(values[first])),
                    pa.ListArray.from_arrays(ends, pa.array(tf, pa.int64())),
                ],
                [name, "n", "terms", "tfs"],
            )


def _ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - size), size)


def _weight(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return UNIT * tf // (TF * tf + LENGTH * m)


class Tree:
    """Documents in the order of their paths. ``ids`` and ``m`` per document; doc, term, tf per entry."""

    def __init__(self, ids: np.ndarray, known: np.ndarray, m: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray) -> None:
        self.terms, at, often = np.unique(term, return_inverse=True, return_counts=True)
        rank = np.empty(len(self.terms), np.int64)
        rank[np.argsort(-often, kind="stable")] = np.arange(len(rank))
        order = np.lexsort((rank[at], doc))
        doc, at, tf = doc[order], at[order], tf[order]
        size = np.bincount(doc, minlength=len(m))
        start = np.cumsum(size) - size
        path = rank[at].astype(">u4").tobytes()
        keys = [path[4 * a : 4 * (a + n)] for a, n in zip(start.tolist(), size.tolist(), strict=True)]
        place = np.array(sorted(range(len(m)), key=keys.__getitem__), np.int64)
        self.ids, self.known, self.m = ids[place], known[place], m[place]
        start, size = start[place], size[place]
        # shared[k]: terms at the beginning that documents k - 1 and k have in common.
        least = np.minimum(size[1:], size[:-1])
        self.shared = np.zeros(len(m), np.int64)
        own, other = _ragged(start[1:], least), _ragged(start[:-1], least)
        depth = _ragged(np.zeros(len(least), np.int64), least)
        far = np.where(at[own] == at[other], np.iinfo(np.int64).max, depth)
        some = np.flatnonzero(least)
        if len(some):
            first = np.minimum.reduceat(far, (np.cumsum(least) - least)[some])
            self.shared[1 + some] = np.minimum(first, least[some])
        # Entries of each term, by the place of their documents.
        flat = _ragged(start, size)
        doc = np.repeat(np.arange(len(m)), size)
        order = np.argsort(at[flat], kind="stable")
        self.doc, self.tf = doc[order], tf[flat][order]
        self.first = np.searchsorted(at[flat][order], np.arange(len(self.terms) + 1))
        self.nodes: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def children(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """Where the children of the node over documents low .. high begin, and their smallest m."""
        if (low, high) not in self.nodes:
            inner = self.shared[low + 1 : high]
            begin = np.concatenate([[low], low + 1 + np.flatnonzero(inner == inner.min())])
            self.nodes[low, high] = begin, np.minimum.reduceat(self.m[low:high], begin - low)
        return self.nodes[low, high]

    def search(self, terms: np.ndarray, weights: np.ndarray, best: Best) -> None:
        at = np.searchsorted(self.terms, terms)
        at = np.minimum(at, max(0, len(self.terms) - 1))
        held = self.terms[at] == terms if len(self.terms) else np.zeros(len(terms), bool)
        at, weights = at[held], weights[held]
        size = self.first[at + 1] - self.first[at]
        flat = _ragged(self.first[at], size)
        self._visit(0, len(self.m), self.doc[flat], self.tf[flat], np.repeat(weights, size), np.repeat(np.arange(len(at)), size), best)

    def _visit(self, low, high, doc, tf, weight, term, best: Best) -> None:
        if not len(doc):
            return
        if high - low <= LEAF:
            self._score(doc, tf, weight, best)
            return
        begin, least = self.children(low, high)
        child = np.searchsorted(begin, doc, "right") - 1
        run = np.flatnonzero(np.append(True, (term[1:] != term[:-1]) | (child[1:] != child[:-1])))
        most = np.maximum.reduceat(tf, run)
        bound = np.zeros(len(begin), np.int64)
        np.add.at(bound, child[run], weight[run] * _weight(most, least[child[run]]))
        small = np.diff(np.append(begin, high)) <= LEAF
        now = (small & (bound > 0) & (bound >= best.least))[child]
        self._score(doc[now], tf[now], weight[now], best)
        large = np.flatnonzero(~small & (bound > 0))
        for c in large[np.argsort(-bound[large], kind="stable")].tolist():
            if bound[c] < best.least:
                break
            own = child == c
            end = int(begin[c + 1]) if c + 1 < len(begin) else high
            self._visit(int(begin[c]), end, doc[own], tf[own], weight[own], term[own], best)

    def _score(self, doc, tf, weight, best: Best) -> None:
        if not len(doc):
            return
        found, at = np.unique(doc, return_inverse=True)
        score = np.zeros(len(found), np.int64)
        np.add.at(score, at, weight * _weight(tf, self.m[doc]))
        good = (score > 0) & (score >= best.least)
        best.add(score[good], self.ids[found[good]], self.known[found[good]])


class Best:
    """The k highest scores so far; among equals null ids come first, then the smaller ones."""

    def __init__(self, k: int) -> None:
        self.k, self.least = k, 1
        self.score = self.ids = np.zeros(0, np.int64)
        self.known = np.zeros(0, bool)

    def add(self, score: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        if not len(score):
            return
        score, ids, known = (np.concatenate(x) for x in ((self.score, score), (self.ids, ids), (self.known, known)))
        order = np.lexsort((ids, known, -score))[: self.k]
        self.score, self.ids, self.known = score[order], ids[order], known[order]
        if len(order) == self.k:
            self.least = int(self.score[-1])


def _trees(batches: Iterator[pa.RecordBatch], vocabulary: np.ndarray, documents: int, total: int, size: int) -> Iterator[Tree]:
    held: list[tuple] = []
    n_docs = n_terms = 0

    def grown() -> Tree:
        sizes = [len(x[0]) for x in held]
        doc = np.concatenate([x[3] + at for x, at in zip(held, np.cumsum([0, *sizes]), strict=False)])
        ids, known, m = (np.concatenate([x[k] for x in held]) for k in range(3))
        return Tree(ids, known, m, doc, np.concatenate([x[4] for x in held]), np.concatenate([x[5] for x in held]))

    for batch in batches:
        for low in range(0, len(batch), 1024):
            part = batch.slice(low, 1024)
            counts = part["terms"].value_lengths().to_numpy(zero_copy_only=False)
            doc = np.repeat(np.arange(len(part)), counts)
            term, tf = (part[c].flatten().to_numpy(zero_copy_only=False) for c in ("terms", "tfs"))
            at = np.minimum(np.searchsorted(vocabulary, term), len(vocabulary) - 1)
            keep = vocabulary[at] == term
            known = part["doc_id"].is_valid().to_numpy(zero_copy_only=False)
            ids = part["doc_id"].fill_null(0).to_numpy(zero_copy_only=False)
            n = part["n"].to_numpy(zero_copy_only=False)
            held.append((ids, known, BASE + SHARE * n * documents // total, doc[keep], term[keep], tf[keep]))
            n_docs, n_terms = n_docs + len(part), n_terms + int(keep.sum())
            if n_docs >= size or n_terms >= TREE_TERMS:
                yield grown()
                held, n_docs, n_terms = [], 0, 0
    if held:
        yield grown()


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 10, tree_docs: int = TREE_DOCS) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of each item with a score above 0.

    ``docs`` needs doc_id and text, ``items`` item_id and text; other columns are ignored. Terms are runs of
    digits, letters and all beyond ASCII, A-Z lower-cased. With N documents that hold a term, L terms in all,
    df the documents of a term, tf its count and n the terms in a document: w = floor(1000 ln((2N+2)/(2df+1))),
    m = 25 + 75 n N div L, and the score sums w * (10^9 tf div (1000 tf + 8 m)) over the item's terms with
    their repeats. Equal scores by ascending doc_id, null first.

    Null and empty texts have no terms: such documents are in no result and items have no rows. Repeated rows
    of a document are documents of their own, under the same doc_id. Rows with the same item_id are one item
    with the terms of its different texts; null is an item_id too. Empty tables give an empty result. Terms
    are told apart by 64-bit hashes. ``tree_docs``: documents of a tree. The driver sees the bitmap of the items' terms and one block of items at
    a time, both of bounded size.
    """
    small_batches(docs.sparkSession)
    kind = items.schema["item_id"].dataType.simpleString()
    lists = "n long, terms array<long>, tfs array<long>"
    asked = items.select("item_id", "text").distinct().mapInArrow(
        lambda batches: _counted(batches, "item_id", None), f"item_id {kind}, {lists}"
    )
    asked = asked.select("item_id", F.explode(F.arrays_zip("terms", "tfs")).alias("t"))
    asked = staged(asked.groupBy("item_id", F.col("t.terms").alias("term")).agg(F.sum("t.tfs").alias("q")), "asked")
    place = F.col("term").bitwiseAND(FILTER_BITS - 1) + 1  # buckets of 4,096 bytes count from 1
    buckets = asked.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )
    bits = np.zeros((FILTER_BITS >> 15, 4096), np.uint8)
    for row in buckets.collect():  # FILTER_BITS at most
        bits[row.bucket - 1] = np.frombuffer(row.bits, np.uint8)
    bits = bits.ravel()

    docs = docs.select(F.col("doc_id").cast("long"), "text")
    vectors = docs.mapInArrow(lambda batches: _counted(batches, "doc_id", bits), f"doc_id long, {lists}")
    vectors = staged(vectors.where("n > 0"), "vectors")
    documents, total = vectors.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    often = vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    w = F.floor(1000 * F.ln(F.lit(2.0 * documents + 2) / (2.0 * F.col("df") + 1)))
    weighed = asked.join(often, "term").select("item_id", "term", (F.col("q") * w).alias("weight"))
    n_terms = asked.count()
    blocks = -(-n_terms // BLOCK_TERMS)
    weighed = weighed.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(max(1, blocks))))
    weighed = staged(weighed, "weighed")

    found = "item_id {}, doc_id long, score long".format(kind)
    results = []
    for block in range(blocks):
        table = weighed.where(F.col("block") == block).select("item_id", "term", "weight").toArrow()
        if not len(table):
            continue
        table = table.combine_chunks().sort_by("item_id")
        which = table["item_id"].combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
        cut = np.flatnonzero(np.append(True, which[1:] != which[:-1]))
        term, weight = (table[c].to_numpy() for c in ("term", "weight"))
        name = table["item_id"].combine_chunks().take(pa.array(cut)).to_pylist()
        query = list(zip(name, np.split(term, cut[1:]), np.split(weight, cut[1:]), strict=True))

        def search(batches: Iterator[pa.RecordBatch], query=query, vocabulary=np.unique(term), names=table["item_id"].type):
            best = [Best(k) for _ in query]
            for tree in _trees(batches, vocabulary, documents, total, tree_docs):
                for own, (_, terms, weights) in zip(best, query, strict=True):
                    tree.search(terms, weights, own)
            for low in range(0, len(query), 4096):
                part = list(zip(query, best, strict=True))[low : low + 4096]
                yield pa.record_batch(
                    [
                        pa.array([q[0] for q, b in part for _ in b.ids], names),
                        pa.array(np.concatenate([b.ids for _, b in part]), mask=~np.concatenate([b.known for _, b in part])),
                        pa.array(np.concatenate([b.score for _, b in part])),
                    ],
                    ["item_id", "doc_id", "score"],
                )

        results.append(staged(vectors.mapInArrow(search, found), "found"))
    if not results:
        return docs.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    rows = results[0]
    for other in results[1:]:
        rows = rows.unionByName(other)
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_first())
    rows = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return rows.select("item_id", "rank", "doc_id", "score")
