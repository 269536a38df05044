"""Language identification of texts and of spans of mixed texts.

Method: the ranges of scripts narrow the candidate languages of each word; hashed byte triples of the word
score the candidates; Viterbi over the words, with a penalty for each switch, labels spans. The language
with the most bytes of words is the text's.

The tables are learned from a bounded sample of texts of known language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weektide.llm._words import LOWER, Words, slices, split, utf8

#: Texts of each language that the tables are learned from, at most about.
SAMPLE = 2_000
BUCKETS = 1 << 16
SWITCH, SHUT_OUT, SMOOTH = 12.0, -30.0, 0.5
_LETTER = np.array([0x41 <= (b & 0xDF) <= 0x5A or b >= 0x80 for b in range(256)])
SCRIPTS = "latin greek cyrillic hebrew arabic indic thai kana han hangul other".split()


def _ranges() -> np.ndarray:
    """Script of a word by the first two bytes of its first character beyond ASCII."""
    table = np.full((256, 256), SCRIPTS.index("other"))
    for first, last, name in (
        (0x00, 0x7F, "latin"), (0xC3, 0xCA, "latin"), (0xCD, 0xCF, "greek"), (0xD0, 0xD4, "cyrillic"),
        (0xD6, 0xD7, "hebrew"), (0xD8, 0xDD, "arabic"), (0xE4, 0xE9, "han"), (0xEB, 0xED, "hangul"),
    ):
        table[first : last + 1] = SCRIPTS.index(name)
    for lead, first, last, name in (
        (0xE0, 0xA4, 0xB7, "indic"), (0xE0, 0xB8, 0xB9, "thai"), (0xE1, 0xB8, 0xBB, "latin"), (0xE1, 0xBC, 0xBF, "greek"),
        (0xE3, 0x81, 0x83, "kana"), (0xE3, 0x90, 0xBF, "han"), (0xEA, 0xB0, 0xBF, "hangul"),
    ):
        table[lead, first : last + 1] = SCRIPTS.index(name)
    return table


_SCRIPT = _ranges()


def _read(batch: pa.RecordBatch) -> tuple[Words, np.ndarray, np.ndarray]:
    """Words (runs of letters), the script of each, and the bucket of the triple around each byte."""
    data, offsets = utf8(batch["text"])
    data = LOWER[data]
    if len(data):  # upper-case letters of the Latin supplement
        up = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)) + 1
        data[up] += 32
    words = split(data, offsets, _LETTER)
    around = np.full(len(data) + 2, 32, np.uint32)
    around[1:-1] = np.where(_LETTER[data], data, 32)
    triple = (around[:-2] << np.uint32(16)) | (around[1:-1] << np.uint32(8)) | around[2:]
    buckets = ((triple * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64)
    high = data >= 0xC2
    place = np.append(np.flatnonzero(high), len(data))
    at = place[np.searchsorted(place[:-1], words.start)] if len(words.start) else words.start
    inside = at < words.end
    lead = np.where(inside, data[np.minimum(at, max(len(data) - 1, 0))] if len(data) else 0, 0)
    following = np.where(inside, np.append(data, [0, 0])[at + 1], 0)
    return words, _SCRIPT[lead, following], buckets


@dataclass
class Tables:
    """``scores``: log probability of each bucket by language; ``allowed``: languages seen in each script."""

    langs: list[str]
    scores: np.ndarray
    allowed: np.ndarray

    def label(self, batch: pa.RecordBatch) -> tuple[Words, np.ndarray]:
        """The words of the texts and the language (an index) of each."""
        words, script, buckets = _read(batch)
        if not len(words.start):
            return words, np.zeros(0, np.int64)
        emit = np.empty((len(words.start), len(self.langs)))
        for k in range(len(self.langs)):
            ends = np.concatenate([[0.0], np.cumsum(self.scores[buckets, k])])
            emit[:, k] = ends[words.end] - ends[words.start]
        emit += np.where(self.allowed, 0.0, SHUT_OUT)[script]
        return words, _viterbi(emit, words.first)


def _viterbi(emit: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Best state of each word; all texts advance together, word by word."""
    count = np.diff(first)
    order = np.argsort(-count, kind="stable")
    begin, count = first[:-1][order], count[order]
    longest, states = int(count[0]) if len(count) else 0, emit.shape[1]
    active = np.searchsorted(-count, -np.arange(longest), "left")
    back = np.empty(emit.shape, np.int16)
    value = np.zeros((len(begin), states))
    own = np.arange(states)
    for t in range(longest):
        k = active[t]
        at, now = begin[:k] + t, value[:k]
        best = now.argmax(1)
        moved = now[np.arange(k), best] - SWITCH
        stay = now >= moved[:, None]
        back[at] = np.where(stay, own, best[:, None])
        value[:k] = np.where(stay, now, moved[:, None]) + emit[at]
    out = np.empty(len(emit), np.int64)
    state = value.argmax(1)
    for t in range(longest - 1, -1, -1):
        k = active[t]
        at = begin[:k] + t
        out[at] = state[:k]
        state[:k] = back[at, state[:k]]
    return out


def learn(docs: DataFrame, sample: int = SAMPLE) -> Tables:
    """Learns from about ``sample`` texts at most of each language in ``docs`` (doc_id, text, lang), chosen by a hash.

    Rows without text or lang are left out. What comes to the driver is one count for each bucket, or
    script, and language.
    """
    docs = docs.select("doc_id", "text", "lang").where("text is not null and lang is not null")
    sizes = {r["lang"]: r["n"] for r in docs.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(sizes)
    if not langs:
        return Tables([], np.zeros((BUCKETS, 0)), np.zeros((len(SCRIPTS), 0), bool))
    shares = F.create_map(*(F.lit(x) for lang in langs for x in (lang, int(1e6 * min(1, sample / sizes[lang])))))
    chosen = docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) < shares[F.col("lang")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(langs), BUCKETS + len(SCRIPTS)), np.int64)
        for batch in batches:
            for piece in slices(batch):
                words, script, buckets = _read(piece)
                lang = pc.index_in(piece["lang"], pa.array(langs)).to_numpy()
                inside = np.zeros(len(buckets) + 1, np.int64)
                np.add.at(inside, words.start, 1)
                np.add.at(inside, words.end, -1)
                owner = np.repeat(lang, np.diff(words.offsets))
                use = np.cumsum(inside[:-1]) > 0
                width = counts.shape[1]
                both = np.concatenate([owner[use] * width + buckets[use], lang[words.row] * width + BUCKETS + script])
                counts += np.bincount(both, minlength=counts.size).reshape(counts.shape)
        lang, bucket = np.nonzero(counts)
        columns = [pa.array(lang, pa.int32()), pa.array(bucket, pa.int32()), pa.array(counts[lang, bucket])]
        yield pa.record_batch(columns, ["lang", "bucket", "n"])

    found = chosen.mapInArrow(run, "lang int, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros((BUCKETS + len(SCRIPTS), len(langs)))
    counts[found["bucket"], found["lang"]] = found["n"]
    triples, scripts = counts[:BUCKETS] + SMOOTH, counts[BUCKETS:]
    allowed = scripts >= 0.01 * np.maximum(scripts.sum(0), 1)
    allowed[~allowed.any(1)] = True  # a script that was never seen rules out nothing
    return Tables(langs, np.log(triples / triples.sum(0)), allowed)


def _has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def languages(docs: DataFrame, tables: Tables) -> DataFrame:
    """doc_id, lang_pred, score and spans of every row of ``docs`` (doc_id, text); other columns are ignored.

    spans: lang, first (word, from 0) and words of each stretch of one language; words are runs of letters.
    lang_pred is the language with the most bytes of words (ties: the first in order), score its share
    of them. A null text, or one without a letter, or tables without a language give ``und``, 0 and no spans.
    Null ids and repeated rows keep their rows; an empty table gives an empty result.
    """
    span = pa.struct([("lang", pa.string()), ("first", pa.int64()), ("words", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                yield one(piece)

    def one(piece: pa.RecordBatch) -> pa.RecordBatch:
        n, langs = len(piece), tables.langs
        if not langs:
            columns = [pa.array(["und"] * n), pa.array(np.zeros(n)), pa.array([[]] * n, pa.list_(span))]
            return pa.record_batch([piece["doc_id"], *columns], ["doc_id", "lang_pred", "score", "spans"])
        words, label = tables.label(piece)
        row = words.row
        sizes = np.bincount(row * len(langs) + label, words.end - words.start, n * len(langs)).reshape(n, len(langs))
        best, total = sizes.argmax(1), sizes.sum(1)
        ascii_letters = np.bincount(row, (words.bytes[words.start] < 128) | (words.bytes[words.end - 1] < 128), n) > 0 if len(row) else np.zeros(n, bool)
        known = ascii_letters.copy()
        for k in np.flatnonzero((total > 0) & ~ascii_letters).tolist():
            known[k] = _has_letter(piece["text"][k].as_py())
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (label[1:] != label[:-1])
        at = np.flatnonzero(new & known[row]) if len(row) else np.zeros(0, np.int64)
        every = np.append(np.flatnonzero(new), len(row))
        length = every[np.searchsorted(every, at, "right")] - at
        values = pa.StructArray.from_arrays(
            [pa.array(langs).take(pa.array(label[at])), pa.array(at - words.first[row[at]]), pa.array(length)], fields=list(span)
        )
        ends = np.searchsorted(row[at], np.arange(n + 1)).astype(np.int32)
        names = pa.array([langs[b] if k else "und" for b, k in zip(best.tolist(), known.tolist(), strict=True)])
        score = np.where(known, sizes[np.arange(n), best] / np.maximum(total, 1), 0.0)
        columns = [names, pa.array(score), pa.ListArray.from_arrays(pa.array(ends), values)]
        return pa.record_batch([piece["doc_id"], *columns], ["doc_id", "lang_pred", "score", "spans"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, lang_pred string, score double, spans array<struct<lang:string,first:long,words:long>>"
    )
