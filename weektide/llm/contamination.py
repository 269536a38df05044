"""Benchmark decontamination: short test items inside long documents.

Method: size-partitioned MinHash containment search. Items are partitioned by the power of two of
their number of shingles. Each partition has its own signature: an item of n distinct shingles, of
which ``need`` = ceil(percent * n / 100) must be in the document, is signed by its n - need + hits
smallest values in a random order, and a document that contains it holds ``hits`` of them at least,
however long it is; ``hits`` grows with the partition. So nothing is missed, and few pairs are left for the exact check
by the words of all shingles. Shingles of many items come last in the order, by powers of two of their count.

Nothing but two filters of a fixed largest size goes through the driver. Signatures meet the documents'
shingles that pass the filters in joins; copies of items and of texts take part once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from weektide.llm._shared import small_batches, staged
from weektide.llm._words import LETTERS, LOWER, Words, folded, mix, runs, slices, split, utf8

#: Bits of a filter: 32 for each value, within these powers of two (16 megabytes at most).
FILTER_BITS = 12, 27
#: Shingles of a document in one row; a document with more of them has several rows.
PIECE = 4096

_ITEM = "k1 long, k2 long, length int, n_item int, hashes array<long>, shingles array<string>"
_HIT = "doc_id long, t1 long, t2 long, piece int, n_words long, signed array<long>, shingles array<string>"


def _words_of(batch: pa.RecordBatch) -> Words:
    data, offsets = utf8(batch["text"])
    return split(LOWER[data], offsets, LETTERS)


def _key() -> tuple[Column, Column]:
    """128 bits of a text."""
    return F.xxhash64("text"), F.xxhash64(F.lit(1), "text")


def _hashed(words: Words, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, first words and hashes of all shingles of ``length`` words."""
    rows, at = runs(words, length)
    values = folded(words.hashes(), length)[at] if len(at) else np.zeros(0, np.uint64)
    return rows, at, (values ^ mix(np.array([length], np.uint64))).view(np.int64)


def _distinct(rows: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Places of the distinct (row, value), in this order."""
    order = np.lexsort((values, rows))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(rows[order]) != 0) | (np.diff(values[order]) != 0)
    return order[new]


def _texts(words: Words, at: np.ndarray, length: np.ndarray) -> list[str]:
    data, start, end = words.bytes.tobytes(), words.start, words.end
    return [
        b" ".join(data[a:b] for a, b in zip(start[k : k + n].tolist(), end[k : k + n].tolist(), strict=True)).decode("utf-8", "replace")
        for k, n in zip(at.tolist(), length.tolist(), strict=True)
    ]


@dataclass
class _Filter:
    """Values that may be in a set: two bits of each are set."""

    bits: np.ndarray
    power: int

    @staticmethod
    def of(values: DataFrame) -> _Filter:
        """Of the column ``h``; the bits are folded in tasks, and at most 2 ** FILTER_BITS[1] of them are fetched."""
        low, high = FILTER_BITS
        power = min(max(low, (32 * values.count()).bit_length()), high)
        slots = F.explode(F.array(F.shiftrightunsigned("h", 64 - power), F.col("h").bitwiseAND((1 << power) - 1)))
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("s").bitwiseAND(63).cast("int"))
        words = values.select(slots.alias("s")).groupBy(F.shiftright("s", 6).alias("w")).agg(F.bit_or(bit).alias("b"))
        table = words.toArrow()
        bits = np.zeros(1 << (power - 6), np.int64)
        bits[table["w"].to_numpy()] = table["b"].to_numpy()
        return _Filter(bits.view(np.uint64), power)

    def has(self, values: np.ndarray) -> np.ndarray:
        h, out = values.view(np.uint64), True
        for slot in (h >> np.uint64(64 - self.power), h & np.uint64((1 << self.power) - 1)):
            out = out & ((self.bits[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1)).astype(bool)
        return out


def _items(texts: DataFrame, n: int) -> DataFrame:
    """One row for each item text that has words: its shingles with their hashes."""

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                words, out = _words_of(piece), []
                for length in range(1, n + 1):
                    rows, at, values = _hashed(words, length)
                    own = words.counts[rows] >= n if length == n else words.counts[rows] == length
                    rows, at, values = rows[own], at[own], values[own]
                    first = _distinct(rows, values)
                    rows, at, values = rows[first], at[first], values[first]
                    for row in np.unique(rows).tolist():
                        mine = slice(*np.searchsorted(rows, [row, row + 1]))
                        named = _texts(words, at[mine], np.full(mine.stop - mine.start, length))
                        key = piece["k1"][row].as_py(), piece["k2"][row].as_py()
                        out.append((*key, length, len(named), values[mine].tolist(), named))
                columns = list(zip(*out, strict=True)) if out else [()] * 6
                types = pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.string())
                yield pa.record_batch(
                    [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                    ["k1", "k2", "length", "n_item", "hashes", "shingles"],
                )

    k1, k2 = _key()
    return texts.select("text", k1.alias("k1"), k2.alias("k2")).mapInArrow(shingles, _ITEM)


def _signatures(items: DataFrame) -> DataFrame:
    """Rows (h, k1, k2, length, need, hits): the signature of each item, as long as its partition of sizes asks."""
    part = F.floor(F.log2("n_item")).cast("int")
    hits = F.least("need", 1 + F.shiftright(part, 1))
    sized = items.select("k1", "k2", "length", "need", hits.alias("hits"), (F.col("n_item") - F.col("need") + hits).alias("size"), "hashes")
    rows = sized.withColumn("h", F.explode("hashes")).drop("hashes")
    common = rows.groupBy("h").agg(F.floor(F.log2(F.count("*"))).alias("common"))
    order = Window.partitionBy("k1", "k2").orderBy("common", "h")
    ranked = rows.join(common, "h").withColumn("place", F.row_number().over(order))
    return ranked.where("place <= size").select("h", "k1", "k2", "length", "need", "hits")


def _hits(docs: DataFrame, signed: _Filter, known: _Filter, lengths: list[int]) -> DataFrame:
    """For each document that may hold a value of a signature: all its shingles that may be an item's."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                words, found = _words_of(piece), []
                for length in lengths:
                    rows, at, values = _hashed(words, length)
                    some = np.flatnonzero(known.has(values))
                    found.append((rows[some], at[some], values[some], np.full(len(some), length)))
                rows, at, values, length = (np.concatenate(c) for c in zip(*found, strict=True))
                first = _distinct(rows, values)
                rows, at, values, length = rows[first], at[first], values[first], length[first]
                sign = signed.has(values)
                own = np.isin(rows, rows[sign])
                rows, at, values, length, sign = rows[own], at[own], values[own], length[own], sign[own]
                out, named = [], _texts(words, at, length)
                for row in np.unique(rows).tolist():
                    low, high = np.searchsorted(rows, [row, row + 1]).tolist()
                    for k, a in enumerate(range(low, high, PIECE)):
                        b = min(a + PIECE, high)
                        out.append((row, k, values[a:b][sign[a:b]].tolist(), named[a:b]))
                row, k, signs, texts = zip(*out, strict=True) if out else ((), (), (), ())
                row = pa.array(row, pa.int64())
                yield pa.record_batch(
                    [
                        *(piece[c].take(row) for c in ("doc_id", "t1", "t2")),
                        pa.array(k, pa.int32()),
                        pa.array(words.counts, pa.int64()).take(row),
                        pa.array(signs, pa.list_(pa.int64())),
                        pa.array(texts, pa.list_(pa.string())),
                    ],
                    ["doc_id", "t1", "t2", "piece", "n_words", "signed", "shingles"],
                )

    t1, t2 = _key()
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", t1.alias("t1"), t2.alias("t2")).mapInArrow(search, _HIT)


def _pairs(docs: DataFrame, texts: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """What may match of ``docs``, and (t1, t2, k1, k2, n_shared, n_item): the texts and items that do."""
    spark = docs.sparkSession
    small_batches(spark)
    need = F.ceil(F.lit(percent) * F.col("n_item") / 100).cast("int")
    items = staged(_items(texts.where("text is not null").distinct(), words).withColumn("need", need), "items")
    signatures = staged(_signatures(items), "signatures")
    lengths = sorted(r[0] for r in items.select("length").distinct().collect())
    known = _Filter.of(items.select(F.explode("hashes").alias("h")).distinct())
    hits = _hits(docs, _Filter.of(signatures.select("h").distinct()), known, lengths or [words])
    hits = staged(hits, "hits")
    # Copies of a text have the same pieces; one of each goes on.
    once = hits.drop("doc_id").dropDuplicates(["t1", "t2", "piece"])
    values = once.select("t1", "t2", "n_words", F.explode("signed").alias("h"))
    met = values.join(signatures, "h").where("n_words - length + 1 >= need")
    close = met.groupBy("t1", "t2", "k1", "k2").agg(F.count("*").alias("n"), F.first("hits").alias("hits")).where("n >= hits")
    exact = close.select("t1", "t2", "k1", "k2").join(
        items.select("k1", "k2", "n_item", F.col("shingles").alias("wanted")), ["k1", "k2"]
    )
    exact = exact.join(once.select("t1", "t2", "shingles"), ["t1", "t2"])
    shared = F.sum(F.size(F.array_intersect("wanted", "shingles"))).alias("n_shared")
    found = exact.groupBy("t1", "t2", "k1", "k2").agg(shared, F.first("n_item").cast("long").alias("n_item"))
    return hits, found.where(F.col("n_shared") * 100 >= F.lit(percent) * F.col("n_item"))


def contained_items(docs: DataFrame, items: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """Rows (doc_id, item_id, n_shared, n_item, containment): items of which a document holds at least ``percent`` %.

    ``docs`` needs doc_id and text, ``items`` item_id and text; other columns are ignored. A-Z are
    lower-cased, words are runs of letters, digits and characters beyond ASCII. An item's shingles are
    its distinct runs of ``words`` words; an item with fewer words is one shingle, found wherever its
    words stand in a row. Null and empty texts, and items without words, match nothing; a null doc_id or
    item_id is returned as it is; repeated rows of ``docs`` are returned once each, of ``items`` likewise.
    One pass over the documents, however many items there are.
    """
    hits, pairs = _pairs(docs.select("doc_id", "text"), items.select("text"), words, percent)
    k1, k2 = _key()
    named = items.where("text is not null").select(F.col("item_id").cast("long").alias("item_id"), k1.alias("k1"), k2.alias("k2"))
    out = hits.where("piece = 0").select("doc_id", "t1", "t2").join(pairs, ["t1", "t2"]).join(named, ["k1", "k2"])
    return out.select("doc_id", "item_id", "n_shared", "n_item", (F.col("n_shared") / F.col("n_item")).alias("containment"))


def without_items(docs: DataFrame, items: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` (text and any other columns) that contain no item, as they are, repeated ones too.

    Rows without text are kept. What goes is told by 128 bits of its text: that table is written first, so
    Spark knows its size and shuffles ``docs`` only where it is too large to be broadcast.
    """
    text = docs.select(F.lit(None).cast("long").alias("doc_id"), "text")
    _, pairs = _pairs(text, items.select("text"), words, percent)
    gone = staged(pairs.select("t1", "t2").distinct(), "contaminated")
    return docs.join(gone, (F.xxhash64(docs["text"]) == gone["t1"]) & (F.xxhash64(F.lit(1), docs["text"]) == gone["t2"]), "left_anti")
