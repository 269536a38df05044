"""Quality classifier: a generalised additive model with pairwise interactions.

Method: cyclic boosted shallow trees. Features are cut into quantile bins; round after round, one feature
after the other gets a small tree over the histogram of its bins, whose leaves are added to the feature's
lookup table; then the same for the few pairs of features whose common histogram explains most of what is
left. A score is the sum of one table entry for each feature and pair, added up for whole slices of texts.

The model is fitted on the driver from the features of a bounded sample of labelled rows; features and
scores are computed in tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weektide.llm._shared import small_batches
from weektide.llm._words import LOWER, NOT_SPACE, folded, runs, slices, split, utf8

#: Labelled rows that the model is fitted on, at most about.
SAMPLE = 20_000
BINS, PAIR_BINS, PAIRS, ROUNDS, PAIR_ROUNDS, RATE, RIDGE = 32, 8, 6, 150, 60, 0.1, 5.0
FEATURES = (
    "words word_bytes letters digits spaces punctuation symbols upper beyond_ascii distinct neighbours_equal "
    "top_word word_ends symbol_ends single_bytes line_words equal_lines equal_triples"
).split()
_KIND = np.zeros((7, 256), np.int64)
for _b in range(256):
    _c = chr(_b)
    _KIND[:, _b] = (
        _b >= 128 or _c.isalpha(),
        48 <= _b < 58,
        not NOT_SPACE[_b],
        _c in ".,;:!?'\"-()",
        32 < _b < 127 and not _c.isalnum() and _c not in ".,;:!?'\"-()",
        65 <= _b < 91,
        _b >= 128,
    )


def features(batch: pa.RecordBatch) -> np.ndarray:
    """One row of FEATURES for each text; a text without words has zeros in all but its counts of bytes."""
    data, offsets = utf8(batch["text"])
    n, size = len(batch), np.maximum(np.diff(offsets), 1)
    words = split(data, offsets, NOT_SPACE)
    row, count = words.row, words.counts
    least = np.maximum(count, 1)
    out = [np.log1p(count), np.bincount(row, words.end - words.start, n) / least]
    for kind in _KIND:
        ends = np.concatenate([[0], np.cumsum(kind[data])])
        out.append((ends[offsets[1:]] - ends[offsets[:-1]]) / size)
    h = split(LOWER[data], offsets, NOT_SPACE).hashes()
    order = np.lexsort((h, row))
    new = np.ones(len(h), bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (row[order][1:] != row[order][:-1])
    owner, times = row[order][new], np.diff(np.append(np.flatnonzero(new), len(h)))
    out.append(np.bincount(owner, minlength=n) / least)
    out.append(np.bincount(row[1:], (h[1:] == h[:-1]) & (row[1:] == row[:-1]), n) / least if len(h) else np.zeros(n))
    top = np.zeros(n)
    np.maximum.at(top, owner, times)
    out.append(top / least)
    last = data[words.end - 1] if len(h) else data[:0]
    for ends in (_KIND[3], _KIND[4]):
        out.append(np.bincount(row, ends[last], n) / least)
    out.append(np.bincount(row, words.end - words.start == 1, n) / least)
    lines = split(data, offsets, np.arange(256) != 10)
    lines_of = np.maximum(lines.counts, 1)
    out.append(np.log1p(count / lines_of))
    pairs = np.unique(np.stack([lines.row.astype(np.uint64), lines.hashes()]), axis=1)[0] if len(lines.start) else []
    out.append(1 - np.bincount(np.asarray(pairs, np.int64), minlength=n) / lines_of)
    out[-1][lines.counts == 0] = 0
    at_row, at = runs(words, 3)
    triples = folded(h, 3)[at] if len(at) else h[:0]
    order = np.lexsort((triples, at_row))
    same = (triples[order][1:] == triples[order][:-1]) & (at_row[order][1:] == at_row[order][:-1])
    out.append(np.bincount(at_row[order][1:], same, n) / np.maximum(count - 2, 1) if len(at) else np.zeros(n))
    return np.stack(out, 1)


def _tree(gain: np.ndarray, weight: np.ndarray, depth: int = 2) -> np.ndarray:
    """Leaf value of each bin of a small tree over a histogram of gradients and weights."""
    value = np.full(len(gain), gain.sum() / (weight.sum() + RIDGE))
    if depth == 0 or len(gain) < 2:
        return value
    g, w = np.cumsum(gain)[:-1], np.cumsum(weight)[:-1]
    better = g**2 / (w + RIDGE) + (gain.sum() - g) ** 2 / (weight.sum() - w + RIDGE)
    cut = int(better.argmax()) + 1
    return np.concatenate([_tree(gain[:cut], weight[:cut], depth - 1), _tree(gain[cut:], weight[cut:], depth - 1)])


def _table(gain: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Leaf values of a tree over two features: the better first cut, each side cut along the other feature."""
    best, most = np.zeros_like(gain), -1.0
    for turn in (False, True):
        g, w = (gain.T, weight.T) if turn else (gain, weight)
        for cut in range(1, len(g)):
            parts = [np.broadcast_to(_tree(g[s].sum(0), w[s].sum(0), 1), g[s].shape) for s in (slice(cut), slice(cut, None))]
            leaf = np.concatenate(parts)
            score = float((2 * g * leaf - w * leaf**2).sum())
            if score > most:
                best, most = (leaf.T if turn else leaf).copy(), score
    return best


@dataclass
class Model:
    """``edges``: cuts of each feature; ``tables`` and ``pairs``: what each bin, or pair of bins, adds to the log odds."""

    start: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def bins(self, x: np.ndarray, coarse: bool = False) -> np.ndarray:
        edges = self.coarse if coarse else self.edges
        return np.stack([np.searchsorted(e, x[:, k], "right") for k, e in enumerate(edges)]) if edges else np.zeros((0, len(x)), int)

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        for table, own in zip(self.tables, self.bins(x), strict=True):
            out += table[own]
        wide = self.bins(x, True)
        for a, b, table in self.pairs:
            out += table[wide[a], wide[b]]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.log_odds(x)))


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """A model of P(y = 1); without rows of both classes it is a constant."""
    mean = (y.sum() + 1) / (len(y) + 2)
    model = Model(float(np.log(mean / (1 - mean))))
    if len(np.unique(y)) < 2:
        return model
    cuts = lambda n: [np.unique(np.quantile(c, np.linspace(0, 1, n + 1)[1:-1])) for c in x.T]
    model.edges, model.coarse = cuts(BINS), cuts(PAIR_BINS)
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    own, wide = model.bins(x), model.bins(x, True)
    total = np.full(len(y), model.start)
    sums = lambda at, n, v: np.bincount(at, v, n)
    for _ in range(ROUNDS):
        for k, table in enumerate(model.tables):
            p = 1 / (1 + np.exp(-total))
            step = RATE * _tree(sums(own[k], len(table), y - p), sums(own[k], len(table), p * (1 - p)))
            table += step
            total += step[own[k]]
    p, shapes = 1 / (1 + np.exp(-total)), [len(e) + 1 for e in model.coarse]

    def histogram(a: int, b: int, v: np.ndarray) -> np.ndarray:
        return sums(wide[a] * shapes[b] + wide[b], shapes[a] * shapes[b], v).reshape(shapes[a], shapes[b])

    ranked = []
    for a, b in combinations(range(x.shape[1]), 2):
        g, w = histogram(a, b, y - p), histogram(a, b, p * (1 - p))
        leaf = _table(g, w)
        ranked.append((float((2 * g * leaf - w * leaf**2).sum()), a, b))
    model.pairs = [(a, b, np.zeros((shapes[a], shapes[b]))) for _, a, b in sorted(ranked, reverse=True)[:PAIRS]]
    for _ in range(PAIR_ROUNDS):
        for a, b, table in model.pairs:
            p = 1 / (1 + np.exp(-total))
            step = RATE * _table(histogram(a, b, y - p), histogram(a, b, p * (1 - p)))
            table += step
            total += step[wide[a], wide[b]]
    return model


_ROW = "array<double>"


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fits on about ``sample`` rows of ``labels`` (doc_id, label 0 or 1) at most, chosen by a hash of doc_id.

    Rows without a doc_id, a label or a document are left out; a document counts once for each doc_id.
    Of several labels of one doc_id the largest counts.
    """
    small_batches(docs.sparkSession)
    labels = labels.select("doc_id", F.col("label").cast("double")).where("doc_id is not null and label in (0, 1)")
    labels = labels.groupBy("doc_id").agg(F.max("label").alias("label"))
    total = labels.count()
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * min(1, sample / max(total, 1)))
    # Bounded by ``sample``: sixteen bytes a row.
    chosen = docs.select("doc_id", "text").join(F.broadcast(labels.where(draw)), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                x = pa.array(list(features(piece)), pa.list_(pa.float64()))
                yield pa.record_batch([piece["doc_id"], piece["label"], x], ["doc_id", "label", "x"])

    found = chosen.mapInArrow(run, f"doc_id long, label double, x {_ROW}")
    rows = found.groupBy("doc_id").agg(F.min(F.struct("x", "label")).alias("r")).select("doc_id", "r.*").orderBy("doc_id").collect()
    x = np.array([r["x"] for r in rows]).reshape(len(rows), len(FEATURES))
    return fit(x, np.array([r["label"] for r in rows]))


def quality_scores(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (0 to 1, higher: label 1 is likelier) of every row of ``docs`` (doc_id, text).

    Other columns are ignored, whatever their names. Whole texts are measured; null and empty ones have
    the features of no words and get the score of those. Null ids and repeated rows keep their rows; an
    empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                yield pa.record_batch([piece["doc_id"], pa.array(model.score(features(piece)))], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double")


def accepted(docs: DataFrame, model: Model, least: float = 0.3) -> DataFrame:
    """The rows of ``docs`` (doc_id, text and any others) that score ``least`` or more, as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                yield piece.filter(pa.array(model.score(features(piece)) >= least))

    return docs.mapInArrow(run, docs.schema)
