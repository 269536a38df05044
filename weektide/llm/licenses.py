"""License scans: every text block that holds enough of a license template.

Method: exact set-similarity join. A block is any run of ``reach`` times as many words as a template has, over
line ends too; it meets the template if it holds ``need`` = ceil(percent * n / 100) of its n distinct words.

The words of all templates have one order, by their frequency over all documents, rarest first. Texts are cut
into records: the known words of two spans of words, one span after the other, so that each run lies in a record.
A record is looked up in an inverted index of the templates' prefixes, their n - need + 1 rarest words (prefix
filter); it must hold ``need`` known words (length filter), and from a shared word on, as many as are lacking must
follow in the record and in the template (positional filter). In the records that are left the runs are counted
exactly: each word of the template counts from behind its last occurrence, so sums over the places where that
begins and ends give the number of distinct words of every run in one pass.

Templates that share enough words to meet each other are told apart: a run must hold the words by which a template
differs from another one, and a template that is a part of another one is not found where that one is.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weektide.llm._words import LETTERS, LOWER, Words, slices, split, utf8

#: Phrase and label.
PHRASES = (
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
)
#: Label and template. The customary notices of public licenses.
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2 0"),
    (
        "apache-2.0",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with "
        "the license you may obtain a copy of the license at unless required by applicable law or agreed to in writing "
        "software distributed under the license is distributed on an as is basis without warranties or conditions of any "
        "kind either express or implied see the license for the specific language governing permissions and limitations "
        "under the license",
    ),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc-sa", "licensed under cc by nc sa 4 0"),
    ("cc-by-nd", "licensed under cc by nd 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("mit", "released under the mit license"),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation the "
        "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
        "persons to whom the software is furnished to do so subject to the following conditions",
    ),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies",
    ),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license"),
    (
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
        "license as published by the free software foundation either version 3 of the license or at your option any later "
        "version",
    ),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    (
        "zlib",
        "this software is provided as is without any express or implied warranty in no event will the authors be held "
        "liable for any damages arising from the use of this software permission is granted to anyone to use this software "
        "for any purpose including commercial applications",
    ),
)


def _tokens(text: str) -> list[bytes]:
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.encode().lower())


class _Scan:
    """Finds the words of phrases and templates in the words of a slice of texts."""

    def __init__(self, phrases, templates) -> None:
        self.phrases = [(_tokens(p), label) for p, label in phrases]
        self.lengths = [len(_tokens(t)) for _, t in templates]
        self.templates = [(label, list(dict.fromkeys(_tokens(t)))) for label, t in templates]
        self.words = sorted({w for p, _ in self.phrases for w in p} | {w for _, t in self.templates for w in t})
        number = {w: k for k, w in enumerate(self.words)}
        self.phrases = [([number[w] for w in p], label) for p, label in self.phrases]
        self.templates = [(label, [number[w] for w in t]) for label, t in self.templates]
        data = np.frombuffer(b"".join(self.words), np.uint8)
        offsets = np.cumsum([0, *map(len, self.words)])
        self.hashes = split(data, offsets, LETTERS).hashes()
        self.order = np.argsort(self.hashes)
        self.quick = np.zeros(1 << 16, bool)
        self.quick[(self.hashes >> np.uint64(48)).astype(np.int64)] = True

    def hits(self, text: Words) -> tuple[np.ndarray, np.ndarray]:
        """Positions of known words and their numbers, compared byte by byte."""
        h = text.hashes()
        at = np.flatnonzero(self.quick[(h >> np.uint64(48)).astype(np.int64)])
        sorted_hashes = self.hashes[self.order]
        place = np.minimum(np.searchsorted(sorted_hashes, h[at]), len(self.words) - 1)
        same = sorted_hashes[place] == h[at]
        at, number = at[same], self.order[place[same]]
        size = text.end[at] - text.start[at]
        good = size == np.array([len(w) for w in self.words])[number]
        at, number = at[good], number[good]
        for k in range(max(map(len, self.words))):  # as many steps as the longest known word has bytes
            column = np.array([w[k] if k < len(w) else 0 for w in self.words], np.uint8)
            far = np.array([len(w) for w in self.words])[number] > k
            bad = np.zeros(len(at), bool)
            bad[far] = text.bytes[text.start[at[far]] + k] != column[number[far]]
            at, number = at[~bad], number[~bad]
        return at, number


def _text(batch: pa.RecordBatch) -> Words:
    data, offsets = utf8(batch["text"])
    return split(LOWER[data], offsets, LETTERS)


def template_frequencies(docs: DataFrame, phrases=PHRASES, templates=TEMPLATES) -> DataFrame:
    """(word, n): how often each template word stands in all documents."""
    scan = _Scan(phrases, templates)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(scan.words), np.int64)
        for batch in batches:
            for piece in slices(batch):
                total += np.bincount(scan.hits(_text(piece))[1], minlength=len(total))
        yield pa.record_batch([pa.array([w.decode() for w in scan.words]), pa.array(total)], ["word", "n"])

    return docs.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Template:
    """A template in the global order: ``words`` rarest first, ``span`` words of a run, and ``told_by``: words that
    a run must hold, as another template that has enough in common with this one lacks them."""

    def __init__(self, label: str, words: list[int], need: int, span: int) -> None:
        self.label, self.words, self.need, self.span = label, words, need, span
        self.told_by: set[int] = set()
        self.wider: list[int] = []


def _plans(scan: _Scan, often: np.ndarray, percent: int, reach: int) -> list[Template]:
    out = []
    for (label, numbers), size in zip(scan.templates, scan.lengths, strict=True):
        ordered = sorted(numbers, key=lambda k: (often[k], scan.words[k]))
        out.append(Template(label, ordered, -(-percent * len(ordered) // 100), reach * size))
    for one in out:
        for number, other in enumerate(out):
            shared = set(one.words) & set(other.words)
            if other.label != one.label and len(shared) >= one.need:
                one.told_by |= set(one.words) - shared
                if len(shared) == len(one.words):
                    one.wider.append(number)
    return out


class Index:
    """The inverted index of the prefixes of the templates with about as long runs, and the filters of a record."""

    def __init__(self, plans: list[Template], chosen: list[int], order: np.ndarray) -> None:
        self.chosen = chosen
        self.span = max(plans[t].span for t in chosen)
        self.known = np.zeros(len(order), bool)  # known words by rank
        self.length = np.array([len(plans[t].words) for t in chosen])
        self.need = np.array([plans[t].need for t in chosen])
        entries = []
        for k, t in enumerate(chosen):
            ranks = order[plans[t].words]
            self.known[ranks] = True
            entries += [(r, k, i) for i, r in enumerate(ranks[: len(ranks) - plans[t].need + 1].tolist())]
        entries = np.array(sorted(entries), np.int64).reshape(-1, 3)
        self.first = np.searchsorted(entries[:, 0], np.arange(len(order) + 1))
        self.template, self.place = entries[:, 1], entries[:, 2]

    def candidates(self, record: np.ndarray, rank: np.ndarray, positional: bool = True) -> np.ndarray:
        """(record, template) pairs, as record * templates + template, that pass the filters.

        ``record`` and ``rank``: the distinct known words of each record, sorted by record and rank.
        """
        size = np.bincount(record, minlength=1)
        begin = np.cumsum(size) - size
        follow = size[record] - (np.arange(len(record)) - begin[record])  # known words from this one on
        many = self.first[rank + 1] - self.first[rank]
        ends = np.cumsum(many)
        at = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - many, many) + np.repeat(self.first[rank], many)
        entry = np.repeat(np.arange(len(rank)), many)
        template = self.template[at]
        need = self.need[template]
        pair = record[entry] * len(self.chosen) + template
        # The rarest shared word of a pair is its first entry: no shared word stands before it.
        order = np.lexsort((rank[entry], pair))
        lead = order[np.append(True, pair[order][1:] != pair[order][:-1])] if len(order) else order
        good = size[record[entry[lead]]] >= need[lead]
        if positional:
            left = np.minimum(self.length[template[lead]] - self.place[at[lead]], follow[entry[lead]])
            good &= left >= need[lead]
        return np.sort(pair[lead[good]])


def license_scan(docs: DataFrame, phrases=PHRASES, templates=TEMPLATES, percent: int = 80, reach: int = 2) -> DataFrame:
    """Licenses named in each document: one row for each row of ``docs``.

    ``docs`` needs doc_id and text; other columns are ignored. A-Z are lower-cased; words are runs of
    letters, digits and characters beyond ASCII. Columns: doc_id, n_words, n_base (places of the phrases),
    first_word and last_word (smallest and largest start of such a place, null without any), base_labels,
    labels (those of the phrases, and of the templates of which a run of the text, ``reach`` times as many words
    as the template has, holds at least ``percent`` % of the distinct words, and all words that tell it from
    others; distinct, sorted, comma-joined), score (the largest share of a template found by these, 1 for a
    phrase, 0 without a label). Null and empty texts have no words and empty labels; repeated rows and null ids
    keep their rows; an empty table gives an empty result. The word frequencies are one row for each template word.
    """
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    scan = _Scan(phrases, templates)
    seen = {r["word"].encode(): r["n"] for r in template_frequencies(docs, phrases, templates).collect()}
    often = np.array([seen.get(w, 0) for w in scan.words])
    plans = _plans(scan, often, percent, reach)
    order = np.empty(len(scan.words), np.int64)
    order[sorted(range(len(scan.words)), key=lambda k: (often[k], scan.words[k]))] = np.arange(len(scan.words))
    # Templates whose runs have the same number of bits share their records.
    classes: dict[int, list[int]] = {}
    for number, plan in enumerate(plans):
        classes.setdefault(plan.span.bit_length(), []).append(number)
    indexes = [Index(plans, chosen, order) for chosen in classes.values()]
    places = []
    for plan in plans:
        position = np.full(len(scan.words), -1)
        position[plan.words] = np.arange(len(plan.words))
        places.append(position)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                yield one(piece)

    def runs_of(text: Words, at: np.ndarray, number: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """Template -> first words of its runs, and how many of its words each holds."""
        found = {}
        row = np.searchsorted(text.first, at, "right") - 1
        for index in indexes:
            mine = np.flatnonzero(index.known[order[number]])
            if not len(mine):
                continue
            span = index.span
            unit = (at[mine] - text.first[row[mine]]) // span
            # A word is in the record that its unit begins, and in the one that the unit before begins.
            per_row = -(-np.diff(text.first) // span) + 1
            base = np.cumsum(per_row) - per_row
            own = base[row[mine]] + unit
            record = np.concatenate([own, own[unit > 0] - 1])
            hit = np.concatenate([mine, mine[unit > 0]])
            keys = np.unique(record * len(order) + order[number[hit]])
            pairs = index.candidates(keys // len(order), keys % len(order))
            for k in np.unique(pairs % len(index.chosen)).tolist():
                t = index.chosen[k]
                wanted = pairs[pairs % len(index.chosen) == k] // len(index.chosen)
                of = np.unique(hit[np.isin(record, wanted) & (places[t][number[hit]] >= 0)])
                runs = _runs(text, at[of], places[t][number[of]], plans[t].need, plans[t].span, places[t][list(plans[t].told_by)])
                if len(runs[0]):
                    found[t] = runs
        return found

    def one(piece: pa.RecordBatch) -> pa.RecordBatch:
        text = _text(piece)
        n, row = len(piece), text.row
        at, number = scan.hits(text)
        known = np.full(len(row) + 1, -1)
        known[at] = number
        base, every = [set() for _ in range(n)], [set() for _ in range(n)]
        score, starts = np.zeros(n), []
        for numbers, label in scan.phrases:
            start = at[number == numbers[0]]
            for k, w in enumerate(numbers):
                start = start[start + k < len(row)]
                start = start[(known[start + k] == w) & (row[start + k] == row[start])]
            starts.append(start)
            for r in np.unique(row[start]).tolist():
                base[r].add(label)
                every[r].add(label)
                score[r] = 1.0
        starts = np.sort(np.concatenate(starts))
        owner = row[starts] if len(starts) else np.zeros(0, np.int64)
        within = starts - text.first[owner]
        count = np.bincount(owner, minlength=n)
        first, last = np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
        np.minimum.at(first, owner, within)
        np.maximum.at(last, owner, within)

        found = runs_of(text, at, number)
        for t, (begin, shared) in found.items():
            keep = np.ones(len(begin), bool)
            for wider in plans[t].wider:
                if wider in found:  # a run that overlaps one of the wider template is a part of that
                    other = found[wider][0]
                    low = np.searchsorted(other, np.maximum(begin - plans[wider].span + 1, text.first[row[begin]]))
                    near = low < len(other)
                    near[near] = other[low[near]] < np.minimum(begin + plans[t].span, text.first[row[begin] + 1])[near]
                    keep &= ~near
            most = np.zeros(n, np.int64)
            np.maximum.at(most, row[begin[keep]], shared[keep])
            for r in np.flatnonzero(most).tolist():
                every[r].add(plans[t].label)
                score[r] = max(score[r], most[r] / len(plans[t].words))
        none = count == 0
        join = lambda sets: pa.array([",".join(sorted(x)) for x in sets], pa.string())
        return pa.record_batch(
            [
                piece["doc_id"],
                pa.array(text.counts.astype(np.int64)),
                pa.array(count.astype(np.int64)),
                pa.array(first, pa.int64(), mask=none),
                pa.array(last, pa.int64(), mask=none),
                join(base),
                join(every),
                pa.array(score),
            ],
            ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
        )

    return docs.mapInArrow(
        find,
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double",
    )


def _distinct(begin: np.ndarray, end: np.ndarray, size: int) -> np.ndarray:
    """How many of the intervals begin .. end hold each place."""
    return np.cumsum(np.bincount(begin, minlength=size) - np.bincount(end + 1, minlength=size))


def _runs(
    text: Words, at: np.ndarray, place: np.ndarray, need: int, span: int, told_by: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """First words of the runs of ``span`` words with ``need`` or more distinct places, those of ``told_by`` among
    them, and their numbers of distinct places. A run ends with its text at the latest."""
    row = np.searchsorted(text.first, at, "right") - 1
    order = np.lexsort((at, place))
    at, place, row = at[order], place[order], row[order]
    begin = np.maximum(at - span + 1, text.first[row])
    again = np.flatnonzero((place[1:] == place[:-1]) & (row[1:] == row[:-1])) + 1
    begin[again] = np.maximum(begin[again], at[again - 1] + 1)
    size = len(text.start) + 2
    count = _distinct(begin, at, size)
    good = count >= need
    if len(told_by):
        telling = np.isin(place, told_by)
        good &= _distinct(begin[telling], at[telling], size) == len(told_by)
    found = np.flatnonzero(good)
    return found, count[found]
