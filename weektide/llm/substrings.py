"""Substring deduplication: removes words of passages that stand anywhere else too.

Method: super-k-mer partitioning. Among the word groups of a window the one with the smallest hash is its
minimiser; consecutive windows that share it travel as one packed string to the minimiser's bucket,
where sorting counts the windows exactly.

Equal windows have equal minimisers at equal places, so a minimiser that stands once in all texts rules
out its windows. Minimisers are counted first, and only super-k-mers whose minimiser is repeated travel.
Texts that several rows have in common take part once, and lose all their windows anyway. Equal super-k-mers
are folded before the shuffle: one that stands twice is repeated as a whole, and a bucket sorts different ones
only. What a bucket finds goes back by the super-k-mer's key, one row for each super-k-mer of a text. A bucket
that may hold more different super-k-mers than a task should sort is split by the content of its windows:
they are counted by 128-bit hashes, folded before the shuffle.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weektide.llm._shared import shuffle_parts, small_batches, staged
from weektide.llm._words import NOT_SPACE, Words, folded, mix, runs, slices, split, utf8

#: Words of the groups among which the minimiser is chosen.
GROUP = 8
#: Super-k-mers that one task sorts at a time; a minimiser of more is split by content.
BUCKET = 20_000


def _words(batch: pa.RecordBatch, column: str = "text") -> Words:
    data, offsets = utf8(batch[column])
    return split(data, offsets, NOT_SPACE)


def _minimisers(hashes: np.ndarray, at: np.ndarray, size: int, group: int) -> tuple[np.ndarray, np.ndarray]:
    """Place and value of the minimiser, leftmost of equals, of each window that begins at ``at``."""
    values = folded(hashes, group)
    place = np.arange(len(values))
    width, span = 1, size - group + 1
    low, where = values, place
    while 2 * width <= span:
        take = low[:-width] <= low[width:]
        low, where = np.where(take, low[:-width], low[width:]), np.where(take, where[:-width], where[width:])
        width *= 2
    other = at + span - width
    take = low[at] <= low[other]
    where = np.where(take, where[at], where[other])
    return where, values[where]


def _super(words: Words, size: int, group: int) -> tuple[np.ndarray, ...]:
    """Row, first window, number of windows and minimiser of each super-k-mer."""
    rows, at = runs(words, size)
    if not len(at):
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.uint64)
    place, value = _minimisers(words.hashes(), at, size, group)
    new = np.ones(len(at), bool)
    new[1:] = (place[1:] != place[:-1]) | (rows[1:] != rows[:-1])
    first = np.flatnonzero(new)
    return rows[first], at[first], np.diff(np.append(first, len(at))), value[first]


def _packed(words: Words, first: int, last: int, data: memoryview) -> bytes:
    """Words ``first`` to ``last`` (exclusive), one space between."""
    return b" ".join(bytes(data[words.start[first] : words.end[last - 1]]).split())


def _repeated(strings: list[bytes], size: int) -> list[np.ndarray]:
    """For packed strings of words: whether each of their windows stands twice among all their windows."""
    lengths = [len(s) for s in strings]
    data = b"".join(strings)
    words = split(np.frombuffer(data, np.uint8), np.cumsum([0, *lengths]), NOT_SPACE)
    rows, at = runs(words, size)
    twice = np.zeros(len(at), bool)
    if len(at):
        values = folded(words.hashes(), size)[at]
        order = np.argsort(values, kind="stable")
        same = values[order][1:] == values[order][:-1]
        groups = np.flatnonzero(np.append(True, ~same))
        ends = np.append(groups[1:], len(order))
        low, high = words.start[at], words.end[at + size - 1]
        for a, b in zip(groups[ends - groups > 1].tolist(), ends[ends - groups > 1].tolist(), strict=True):
            members = order[a:b].tolist()
            texts = [data[low[k] : high[k]] for k in members]
            if all(t == texts[0] for t in texts):
                twice[members] = True
            else:  # different windows with one hash
                for k, t in zip(members, texts, strict=True):
                    twice[k] = texts.count(t) > 1
    cuts = np.searchsorted(rows, np.arange(1, len(strings)))
    return np.split(twice, cuts)


def _key(data: bytes) -> tuple[int, int]:
    return struct.unpack("<qq", hashlib.blake2b(data, digest_size=16).digest())


def _spans(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def remove_repeats(docs: DataFrame, words: int = 35, group: int = GROUP, bucket: int | None = None) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, kept: each document without the words of repeated passages.

    ``docs`` needs doc_id and text; other columns are ignored. Words are what white space separates,
    unchanged. A window is ``words`` consecutive words of a document. A word goes if a window over it has
    a word sequence that also starts anywhere else, in the same document, a copy or another one, judged on
    the input. ``kept`` holds the other words joined by one space, null where nothing was removed (it is
    then the text's words), and kept_sha256 the SHA-256 of the kept words so joined. Null and empty texts
    have no words; repeated rows are copies of each other; null ids keep their rows; an empty table gives
    an empty result. A text has one line of rows per row of ``docs``, whatever its id. Texts
    and super-k-mers are told apart by 128 bits; windows are compared word by word in a bucket, and by 128
    bits where a bucket of more than ``bucket`` super-k-mers is split.
    """
    bucket = BUCKET if bucket is None else bucket
    small_batches(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    keys = [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit("again"), text).alias("k2")]
    docs = docs.select(F.col("doc_id").cast("long"), text.alias("text"), *keys)
    spark = docs.sparkSession

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                counts, sums = [], []
                for text in piece["text"].to_pylist():
                    own = text.encode().split()
                    counts.append(len(own))
                    sums.append(hashlib.sha256(b" ".join(own)).hexdigest())
                columns = [piece["doc_id"], piece["k1"], piece["k2"], pa.array(counts, pa.int64()), pa.array(sums, pa.string())]
                yield pa.record_batch(columns, ["doc_id", "k1", "k2", "n_words", "all_sha256"])

    def minimisers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                rows, _, _, value = _super(_words(piece), words, group)
                order = np.lexsort((value, rows))
                rows, value = rows[order], value[order]
                first = np.ones(len(rows), bool)
                first[1:] = (rows[1:] != rows[:-1]) | (value[1:] != value[:-1])
                count = np.diff(np.append(np.flatnonzero(first), len(rows)))
                yield pa.record_batch(
                    [
                        piece["k1"].take(pa.array(rows[first])),
                        pa.array(value[first].view(np.int64)),
                        pa.array(count),
                    ],
                    ["k1", "mini", "times"],
                )

    base = staged(docs.mapInArrow(measure, "doc_id long, k1 long, k2 long, n_words long, all_sha256 string"), "measured")
    minis = staged(docs.select("k1", "text").mapInArrow(minimisers, "k1 long, mini long, times long"), "minimisers")
    shared = minis.groupBy("mini").agg(
        F.sum("times").alias("n"), F.min("k1").alias("low"), F.max("k1").alias("high"), F.max("times").alias("times")
    )
    shared = staged(shared.where("low <> high or times > 1").select("mini", (F.col("n") > bucket).alias("hot")), "shared")
    wanted = minis.select("k1", "mini").join(shared, "mini").groupBy("k1")
    wanted = staged(wanted.agg(F.collect_set(F.struct("mini", "hot")).alias("minis")), "wanted")
    # One row stands for all copies of a text.
    lead = base.groupBy("k1", "k2").agg(F.min(F.coalesce("doc_id", "k2")).alias("lead"))
    lead = staged(lead.join(wanted, "k1"), "lead")
    rows = docs.withColumn("lead", F.coalesce("doc_id", "k2")).select("k1", "k2", "lead", "text")
    held = staged(
        rows.join(lead, ["k1", "k2", "lead"])
        .select("k1", "k2", "text", F.col("minis.mini").alias("mini"), F.col("minis.hot").alias("hot")),
        "held",
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()  # what the task has sent already
        for batch in batches:
            for piece in slices(batch):
                text = _words(piece)
                data = memoryview(text.bytes)
                row, first, n, value = _super(text, words, group)
                out = []
                cut = np.searchsorted(row, np.arange(len(piece) + 1))
                for r, (listed, hots) in enumerate(zip(piece["mini"].to_pylist(), piece["hot"].to_pylist(), strict=True)):
                    hot = dict(zip(listed, hots, strict=True))
                    mine = slice(cut[r], cut[r + 1])
                    for k in (np.flatnonzero(np.isin(value[mine].view(np.int64), listed)) + cut[r]).tolist():
                        whole = _packed(text, first[k], first[k] + n[k] + words - 1, data)
                        key, mini = _key(whole), int(value[k].view(np.int64))
                        new = key not in seen
                        seen.add(key)
                        out.append((r, int(first[k] - text.first[r]), int(n[k]), *key, mini, hot[mini], whole if new else None))
                if len(seen) > 1_000_000:
                    seen.clear()
                at = pa.array([x[0] for x in out], pa.int64())
                kinds = [*[pa.int64()] * 5, pa.bool_(), pa.binary()]
                columns = [pa.array([x[k] for x in out], kind) for k, kind in enumerate(kinds, 1)]
                yield pa.record_batch(
                    [piece["k1"].take(at), piece["k2"].take(at), *columns],
                    ["k1", "k2", "first", "windows", "s1", "s2", "mini", "hot", "packed"],
                )

    packed = "k1 long, k2 long, first long, windows long, s1 long, s2 long, mini long, hot boolean, packed binary"
    supers = staged(held.mapInArrow(pack, packed), "supers")
    often = supers.groupBy("s1", "s2").agg(F.count("*").alias("n"), F.max("windows").alias("high")).where("n > 1")
    often = often.select("s1", "s2", F.lit(0).cast("long").alias("low"), "high")
    once = supers.where("packed is not null").select("mini", "hot", "s1", "s2", "packed")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Buckets, in the order of their minimisers, some at a time."""
        held: dict[tuple[int, int], bytes] = {}
        last = None

        def told() -> pa.RecordBatch:
            rows = [
                (*key, a, b)
                for key, flags in zip(held, _repeated(list(held.values()), words), strict=True)
                for a, b in zip(*(x.tolist() for x in _spans(flags)), strict=True)
            ]
            return pa.record_batch([pa.array([x[k] for x in rows], pa.int64()) for k in range(4)], ["s1", "s2", "low", "high"])

        for batch in batches:
            for mini, s1, s2, whole in zip(*(batch[c].to_pylist() for c in ("mini", "s1", "s2", "packed")), strict=True):
                if mini != last and len(held) >= 4096:
                    yield told()
                    held = {}
                last = mini
                held[s1, s2] = whole
        if held:
            yield told()

    def split_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The windows of super-k-mers by 128-bit hashes."""
        for batch in batches:
            for at in range(0, len(batch), 1024):
                part = batch.slice(at, 1024)
                strings = part["packed"].to_pylist()
                text = split(np.frombuffer(b"".join(strings), np.uint8), np.cumsum([0, *map(len, strings)]), NOT_SPACE)
                rows, begin = runs(text, words)
                if not len(begin):
                    continue
                h = text.hashes()
                values = [folded(x, words)[begin].view(np.int64) for x in (h, mix(h))]
                owner = pa.array(rows)
                columns = [part["s1"].take(owner), part["s2"].take(owner), pa.array(begin - text.first[rows]), *map(pa.array, values)]
                yield pa.record_batch(columns, ["s1", "s2", "low", "w1", "w2"])

    spans = "s1 long, s2 long, low long, high long"
    cold = once.where("not hot").repartition(shuffle_parts(spark), "mini").sortWithinPartitions("mini")
    cold = cold.select("mini", "s1", "s2", "packed").mapInArrow(count, spans)
    windows = once.where("hot").select("s1", "s2", "packed").mapInArrow(split_up, "s1 long, s2 long, low long, w1 long, w2 long")
    windows = staged(windows, "windows")
    again = windows.groupBy("w1", "w2").agg(
        F.min("s1").alias("least"), F.max("s1").alias("most"), F.min("low").alias("from"), F.max("low").alias("to")
    )
    again = again.where("least <> most or from <> to").select("w1", "w2")
    warm = windows.join(again, ["w1", "w2"]).select("s1", "s2", "low", (F.col("low") + 1).alias("high"))
    flags = often.unionByName(cold).unionByName(warm).groupBy("s1", "s2")
    flags = staged(flags.agg(F.collect_set(F.struct("low", "high")).alias("spans")), "flags")
    # One row for each super-k-mer of a text that holds a repeated window.
    owned = supers.select("k1", "k2", "first", "s1", "s2").join(flags, ["s1", "s2"])
    moved = F.transform("spans", lambda x: F.struct((x["low"] + F.col("first")).alias("low"), (x["high"] + F.col("first")).alias("high")))
    repeated = owned.select("k1", "k2", moved.alias("spans")).groupBy("k1", "k2")
    repeated = staged(repeated.agg(F.flatten(F.collect_list("spans")).alias("spans")), "repeated")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in (x for batch in batches for x in slices(batch)):
            removed, kept, sums = [], [], []
            for t, lows, highs in zip(*(piece[c].to_pylist() for c in ("text", "low", "high")), strict=True):
                own = t.encode().split()
                edge = np.zeros(len(own) + 1, np.int64)
                np.add.at(edge, lows, 1)
                np.add.at(edge, np.array(highs) + words - 1, -1)
                gone = np.cumsum(edge[:-1]) > 0
                left = b" ".join([own[k] for k in np.flatnonzero(~gone).tolist()])
                removed.append(int(gone.sum()))
                kept.append(left.decode())
                sums.append(hashlib.sha256(left).hexdigest())
            yield pa.record_batch(
                [piece["k1"], piece["k2"], pa.array(removed, pa.int64()), pa.array(kept, pa.string()), pa.array(sums, pa.string())],
                ["k1", "k2", "n_gone", "left", "left_sha256"],
            )

    flagged = held.select("k1", "k2", "text").join(repeated, ["k1", "k2"]).dropDuplicates(["k1", "k2"])
    flagged = flagged.select("k1", "k2", "text", F.col("spans.low").alias("low"), F.col("spans.high").alias("high"))
    result = staged(
        flagged.mapInArrow(keep, "k1 long, k2 long, n_gone long, left string, left_sha256 string"), "kept"
    )
    copies = staged(base.groupBy("k1", "k2").count().where("count > 1").select("k1", "k2", F.lit(True).alias("copied")), "copies")
    whole = F.coalesce("copied", F.lit(False)) & (F.col("n_words") >= words)
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return (
        base.join(copies, ["k1", "k2"], "left")
        .join(result, ["k1", "k2"], "left")
        .select(
            "doc_id",
            "n_words",
            F.when(whole, F.col("n_words")).otherwise(F.coalesce("n_gone", F.lit(0))).alias("n_removed"),
            F.when(whole, nothing).otherwise(F.coalesce("left_sha256", "all_sha256")).alias("kept_sha256"),
            F.when(whole, "").otherwise(F.col("left")).alias("kept"),
        )
    )
