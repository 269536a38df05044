"""N-gram Jaccard join: which documents share at least a given percentage of their word shingles.

Method: size-banded tiles with hashed bitmap signatures; bit counts bound the overlap from above
before the exact intersection of sorted arrays.

1. Every text becomes the set of its hashed word shingles. Equal sets are one node from here on.
2. *Families.* Two sets that link differ in at most D = (100 - p) * size / p shingles. Each size band
   deals the shingles into somewhat more than D parts by hash; the D + 1 largest parts of a set cannot
   all be touched by D differences, so two sets that link share a whole part. Parts travel as packed
   (key, node) arrays; each key links its nodes to the smallest of them. What a task has linked already
   goes on as one node, once for each key. The connected components of these links are the families:
   every link lies within one.
3. *Tiles.* A family is cut into size-banded blocks and joined block by block. In a tile, bitmap
   signatures bound the overlap (each bit that only one side has is a shingle that the other lacks);
   what passes is intersected exactly. Pairs that are already connected are skipped, so a tile returns
   at most one row per set and never all pairs. A family too large for one tile is first dealt anew by
   other hash functions, as its true links share a part under each of them.
4. Connected components of the exact links, carried over to all copies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weektide.llm._shared import components, forest, shuffle_parts, small_batches, staged
from weektide.llm._words import LOWER, NOT_SPACE, mix, shingle_sets, slices, split, utf8

#: Sets in a block, and shingles in a block: what bounds a tile's memory and time.
BLOCK_SETS, BLOCK_SHINGLES = 4_000, 1_000_000
#: More rounds of dealing for families larger than one block.
ROUNDS = 3
FLUSH_KEYS = 500_000
#: Keys that one task links, at most about: what bounds its memory, however many there are of them.
TASK_KEYS = 2_000_000
_SPREAD = 1.25  # parts per guaranteed part


def _limits() -> np.ndarray:
    out = [1]
    while out[-1] < 1 << 40:
        out.append(max(out[-1] + 1, out[-1] * 3 // 2))
    return np.array(out)


#: Lower ends of the size bands. Neighbours differ by a third at least, more than two linked sizes do.
BANDS = _limits()


def _sums(groups: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """64-bit sums of ``values`` per group, in halves that float sums hold exactly."""
    low = np.bincount(groups, (values & np.uint64(0xFFFFFFFF)).astype(np.float64), n).astype(np.uint64)
    high = np.bincount(groups, (values >> np.uint64(32)).astype(np.float64), n).astype(np.uint64)
    return low + (high << np.uint64(32))


def _fingerprints(rows: np.ndarray, values: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    return _sums(rows, mix(values), n), _sums(rows, mix(values ^ np.uint64(0x5555)), n)


def part_keys(rows: np.ndarray, values: np.ndarray, n: int, percent: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of the parts that each set shows; two sets that link show an equal key."""
    sizes = np.bincount(rows, minlength=n)
    band = np.searchsorted(BANDS, np.maximum(sizes, 1), "right") - 1
    found = []
    mixed = mix(values ^ mix(np.uint64([seed]))) if len(values) else values
    for up in (0, 1):  # a set also shows itself in the next band, if a set there can link with it
        b = band + up
        use = sizes > 0
        if up:
            use &= 100 * sizes >= percent * BANDS[b]
        top = BANDS[b + 1] - 1
        parts = np.where(use, (_SPREAD * ((100 - percent) * top // percent + 1)).astype(np.int64), 0)
        parts = np.where(use & ((100 - percent) * top // percent == 0), 1, parts)
        base = np.concatenate([[0], np.cumsum(parts)])
        in_use = use[rows]
        r, v = rows[in_use], mixed[in_use]
        at = base[r] + (v % parts[r].astype(np.uint64)).astype(np.int64)
        total = int(base[-1])
        size, owner = np.bincount(at, minlength=total), np.repeat(np.arange(n), parts)
        # The largest size that enough parts of the set have.
        capped = np.minimum(size, 63)
        above = np.bincount(owner * 64 + capped, minlength=n * 64).reshape(n, 64)[:, ::-1].cumsum(1)[:, ::-1]
        need = (100 - percent) * sizes // percent + 1
        least = (above >= need[:, None]).sum(1) - 1
        shown = np.flatnonzero(capped >= least[owner])
        number = (shown - base[owner[shown]]).astype(np.uint64) + (b[owner[shown]].astype(np.uint64) << np.uint64(40))
        found.append((owner[shown], mix(_sums(at, mix(v), total)[shown] ^ mix(number))))
    return np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found])


def _stars(keys: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The smallest node of each key, and (node, smallest node) for the others."""
    if not len(keys):
        return keys, nodes, nodes[:0], nodes[:0]
    order = np.lexsort((nodes, keys))
    keys, nodes = keys[order], nodes[order]
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    hub = nodes[first][np.cumsum(first) - 1]
    others = hub != nodes
    edges = np.unique(np.stack([nodes[others], hub[others]], 1), axis=0)
    return keys[first], nodes[first], edges[:, 0], edges[:, 1]


_BLOBS = "part int, keys binary, nodes binary, a binary, b binary"


def _packed(keys: np.ndarray, nodes: np.ndarray, parts: int) -> pa.RecordBatch:
    """The keys, each with one node, and the links (a, b) found here, dealt into ``parts``.

    Nodes that are connected here stand for each other: all their keys name the smallest of them. So a group
    of near copies meets the other tasks as one node, whichever of its keys a copy lacks.
    """
    keys, nodes, a, b = _stars(keys, nodes)
    if len(a):
        a, b = forest(a, b)
        at = np.minimum(np.searchsorted(a, nodes), len(a) - 1)
        nodes = np.where(a[at] == nodes, b[at], nodes)
    to = (keys % np.uint64(parts)).astype(np.int64)
    order = np.argsort(to, kind="stable")
    keys, nodes, ends = keys[order], nodes[order], np.searchsorted(to[order], np.arange(parts + 1))
    to = (mix(a) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(to, kind="stable")
    a, b, cuts = a[order], b[order], np.searchsorted(to[order], np.arange(parts + 1))
    full = np.flatnonzero((np.diff(ends) > 0) | (np.diff(cuts) > 0))
    cut = lambda x, e: [x[e[p] : e[p + 1]].tobytes() for p in full]
    return pa.record_batch(
        [pa.array(full, pa.int32()), *(pa.array(cut(x, e), pa.binary()) for x, e in ((keys, ends), (nodes, ends), (a, cuts), (b, cuts)))],
        ["part", "keys", "nodes", "a", "b"],
    )


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    got: list[list[np.ndarray]] = [[], [], [], []]
    for batch in batches:
        for name, to in zip(("keys", "nodes", "a", "b"), got, strict=True):
            to += [np.frombuffer(x, np.uint64) for x in batch[name].to_pylist()]
    keys, nodes, a, b = (np.concatenate(x) if x else np.zeros(0, np.uint64) for x in got)
    _, _, c, d = _stars(keys, nodes)
    pairs = np.unique(np.stack([np.concatenate([a, c]), np.concatenate([b, d])], 1), axis=0).view(np.int64)
    yield pa.record_batch([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])


def _tasks(sets: int, shingles: int, percent: int) -> int:
    """How many tasks the keys ask for: a set of n shingles shows fewer than the parts of bands up to 2.25 * n."""
    keys = _SPREAD * (3.75 * (100 - percent) / percent * shingles + 2 * sets)
    return int(keys // TASK_KEYS) + 1


def _families(blobs: DataFrame, tasks: int) -> DataFrame:
    """node -> family, for the nodes that share a key with another.

    The tasks go by the number of keys: a node is linked once in each task, so few keys in many tasks would
    repeat every node, and many keys in few tasks would not fit them.
    """
    parts = max(tasks, shuffle_parts(blobs.sparkSession))
    dealt = blobs.repartition(parts, "part").coalesce(tasks)
    return components(dealt.mapInArrow(_edges, "a long, b long"), "families")


def _sets_of(batch: pa.RecordBatch, n: int) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = utf8(batch["text"])
    return shingle_sets(split(LOWER[data], offsets, NOT_SPACE), n)


def _join_tile(sizes: np.ndarray, arrays: list[np.ndarray], percent: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest index connected with each set by links between a set of ``left`` and one of ``right``."""
    count = len(sizes)
    root = np.arange(count)
    if count < 2:
        return root
    flat = np.concatenate(arrays)
    dense = np.unique(flat, return_inverse=True)[1].astype(np.int32)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    bits = 1 << int(np.clip(np.ceil(np.log2(4 * sizes.mean() + 1)), 6, 13))
    marks = np.zeros((count, bits), np.uint8)
    marks[np.repeat(np.arange(count), sizes), (mix(flat) & np.uint64(bits - 1)).astype(np.int64)] = 1
    signs = np.packbits(marks, axis=1).view(np.uint64)
    filled = np.bitwise_count(signs).sum(1).astype(np.int64)
    del marks
    seen = np.zeros(int(dense.max()) + 1, bool)
    for i in np.flatnonzero(left):
        other = right & (root != root[i])
        other &= 100 * np.minimum(sizes, sizes[i]) >= percent * np.maximum(sizes, sizes[i])
        other &= (np.arange(count) > i) | ~(left & right[i])  # within a block each pair once
        j = np.flatnonzero(other)
        if not len(j):
            continue
        common = np.bitwise_count(signs[j] & signs[i]).sum(1).astype(np.int64)
        most = np.minimum(sizes[i] - (filled[i] - common), sizes[j] - (filled[j] - common))
        j = j[100 * most >= percent * (sizes[i] + sizes[j] - most)]
        if not len(j):
            continue
        own = dense[ends[i] : ends[i + 1]]
        seen[own] = True
        lengths = sizes[j]
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        places = np.arange(lengths.sum()) - np.repeat(starts, lengths) + np.repeat(ends[j], lengths)
        both = np.add.reduceat(seen[dense[places]].astype(np.int64), starts)
        seen[own] = False
        j = j[100 * both >= percent * (sizes[i] + sizes[j] - both)]
        if len(j):
            joined = np.unique(np.append(root[j], root[i]))
            root[np.isin(root, joined)] = joined[0]
    return root


def jaccard_groups(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id of every document.

    ``docs`` needs doc_id (integer) and text; other columns are ignored. A-Z are lower-cased, words are
    what white space separates. A document's set holds its distinct ``words``-word shingles; with fewer
    words all of them are one shingle. Documents link when 100 * |A and B| >= percent * |A or B|
    (75 <= percent <= 100), and component_id is the smallest doc_id reachable by links.
    Null, empty and blank texts have no shingles and stand alone; a null doc_id keeps its row and takes
    part in no link (component_id null); repeated rows stay. doc_id should be unique: different texts
    under one doc_id are compared as texts, and sets that have the same smallest doc_id are one node. An empty table gives an empty result. Shingles are compared by 64-bit hashes, equal sets are told by
    128 bits and their size.
    """
    if not 75 <= percent <= 100:
        raise ValueError("percent must be from 75 to 100")
    small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long"), "text")

    def fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                rows, values = _sets_of(piece, words)
                one, two = _fingerprints(rows, values, len(piece))
                yield pa.record_batch(
                    [
                        piece["doc_id"],
                        pa.array(np.bincount(rows, minlength=len(piece))),
                        pa.array(one.view(np.int64)),
                        pa.array(two.view(np.int64)),
                    ],
                    ["doc_id", "n", "node", "check"],
                )

    def show(sets: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]], seed: int, parts: int) -> Iterator[pa.RecordBatch]:
        keys, nodes, held = [], [], 0
        for owner, rows, values, n in sets:
            at, key = part_keys(rows, values, n, percent, seed)
            keys.append(key)
            nodes.append(owner[at])
            held += len(key)
            if held >= FLUSH_KEYS:
                yield _packed(np.concatenate(keys), np.concatenate(nodes), parts)
                keys, nodes, held = [], [], 0
        if held:
            yield _packed(np.concatenate(keys), np.concatenate(nodes), parts)

    def parts_of(tasks: int) -> int:
        return 4 * max(tasks, shuffle_parts(docs.sparkSession))

    table = staged(docs.mapInArrow(fingerprints, "doc_id long, n long, node long, check long"), "sets")
    sets = table.where("n > 0 and doc_id is not null")
    tasks = _tasks(*sets.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first(), percent)
    parts = parts_of(tasks)

    def from_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sets():
            for batch in batches:
                for piece in slices(batch):
                    rows, values = _sets_of(piece, words)
                    yield _fingerprints(rows, values, len(piece))[0], rows, values, len(piece)

        return show(sets(), 0, parts)

    members = staged(sets.groupBy("node", "check", "n").agg(F.min("doc_id").alias("rep")), "nodes")
    family = _families(docs.where("doc_id is not null").mapInArrow(from_texts, _BLOBS), tasks)
    chosen = staged(
        members.join(family.withColumnRenamed("component", "family"), "node").select("node", "rep", "family"), "chosen"
    )

    def arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                rows, values = _sets_of(piece, words)
                ends = np.searchsorted(rows, np.arange(len(piece) + 1))
                yield pa.record_batch(
                    [
                        piece["rep"],
                        piece["family"],
                        pa.array(np.diff(ends)),
                        pa.array([values[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary()),
                    ],
                    ["rep", "family", "n", "shingles"],
                )

    # A repeated doc_id with several texts: all its texts are read, each is its own set of the family.
    # The same join at every size: the texts are dealt once, the chosen ids are the side that is looked up.
    ids = chosen.select(F.col("rep").alias("doc_id"), "family").distinct()
    texts = docs.join(ids.hint("shuffle_hash"), "doc_id")
    texts = texts.select(F.col("doc_id").alias("rep"), "family", "text")
    held = staged(texts.mapInArrow(arrays, "rep long, family long, n long, shingles binary").where("n > 0"), "arrays")
    big = f"sets > {BLOCK_SETS} or sum_n > {BLOCK_SHINGLES}"

    def sized(rows: DataFrame) -> DataFrame:
        return staged(rows.groupBy("family").agg(F.count("*").alias("sets"), F.sum("n").alias("sum_n")), "sizes")

    def of(rows: DataFrame, sizes: DataFrame, kind: str) -> DataFrame:
        return rows.join(sizes.where(kind).select("family"), "family")

    def again(seed: int, parts: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def sets():
                for batch in batches:
                    n, owner = np.asarray(batch["n"]), np.asarray(batch["rep"]).astype(np.int64).view(np.uint64)
                    values = np.frombuffer(b"".join(batch["shingles"].to_pylist()), np.uint64)
                    yield owner, np.repeat(np.arange(len(n)), n), values, len(n)

            return show(sets(), seed, parts)

        return run

    sizes, before, found = sized(held), None, None
    for seed in range(1, ROUNDS + 2):
        whole = of(held, sizes, f"not ({big})").groupBy("family").applyInArrow(_one_tile(percent), "rep long, component_id long")
        found = whole if found is None else found.unionByName(whole)
        large, shingles = sizes.where(big).agg(F.sum("sets"), F.sum("sum_n")).first()
        if not large:
            break
        rest = of(held, sizes, big)
        if seed > ROUNDS or before and large > 0.9 * before:  # these are close to each other indeed
            links = components(_tiles(rest, percent), "links")
            found = found.unionByName(links.toDF("rep", "component_id"))
            break
        before = large
        tasks = _tasks(large, shingles, percent)
        blobs = rest.select("rep", "n", "shingles").mapInArrow(again(seed, parts_of(tasks)), _BLOBS)
        dealt = _families(blobs, tasks).toDF("rep", "new")
        rest = rest.join(dealt, "rep").withColumn("family", F.xxhash64("new", F.lit(seed))).drop("new")
        held = staged(rest, "arrays")
        sizes = sized(held)
    found = found.groupBy("rep").agg(F.min("component_id").alias("component_id"))  # repeated rows of the input
    named = members.join(found, "rep", "left").select(
        "node", "check", "n", F.coalesce("component_id", "rep").alias("component_id")
    )
    named = staged(named, "named")
    rows = table.join(named, ["node", "check", "n"], "left")
    return rows.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
    )


def _one_tile(percent: int):
    def run(table):
        table = table.sort_by([("rep", "ascending")])
        sizes, rep = np.asarray(table["n"]).astype(np.int64), np.asarray(table["rep"])
        arrays = [np.frombuffer(x, np.uint64) for x in table["shingles"].to_pylist()]
        every = np.ones(len(sizes), bool)
        root = _join_tile(sizes, arrays, percent, every, every)
        return pa.table({"rep": pa.array(rep), "component_id": pa.array(rep[root])})

    return run


def _tiles(held: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that connect the sets of each family, block by block, as its exact links do."""
    band = F.floor(F.log("n") / F.log(F.lit(100 / percent + 1e-9))).cast("int")
    held = held.withColumn("band", band if percent < 100 else F.col("n").cast("int"))
    blocks = F.ceil(F.greatest(F.count("*") / BLOCK_SETS, F.sum("n") / BLOCK_SHINGLES)).cast("int")
    per_band = staged(held.groupBy("family", "band").agg(blocks.alias("blocks")), "bands")
    lower = per_band.select("family", (F.col("band") + 1).alias("band"), F.col("blocks").alias("below"))
    upper = per_band.select("family", (F.col("band") - 1).alias("band"), F.col("blocks").alias("above"))
    plan = per_band.join(lower, ["family", "band"], "left").join(upper, ["family", "band"], "left")
    rows = held.join(staged(plan.fillna(0, ["below", "above"]), "bands"), ["family", "band"])
    # Block i of band b meets block j of its own band, j >= i, and every block of the bands beside it.
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    tile = lambda low, i, j: F.struct(low.alias("low"), i.alias("i"), j.alias("j"))
    ints = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    here, up = F.col("band") * 2, F.col("band") * 2 + 1
    goes = F.concat(
        F.transform(ints(F.col("blocks")), lambda j: tile(here, F.least(j, F.col("own")), F.greatest(j, F.col("own")))),
        F.transform(ints(F.col("above")), lambda j: tile(up, F.col("own"), j)),
        F.transform(ints(F.col("below")), lambda j: tile(up - 2, j, F.col("own"))),
    )
    rows = rows.withColumn("own", own).withColumn("tile", F.explode(goes))

    def join(key, table):
        low, i, j = (x.as_py() for x in key[1:])
        rep, bands, own = (np.asarray(table[c]) for c in ("rep", "band", "own"))
        sizes = np.asarray(table["n"]).astype(np.int64)
        arrays = [np.frombuffer(x, np.uint64) for x in table["shingles"].to_pylist()]
        left, right = (bands == low // 2) & (own == i), (bands == (low + 1) // 2) & (own == j)
        root = _join_tile(sizes, arrays, percent, left, right)
        linked = np.flatnonzero(root != np.arange(len(root)))
        return pa.table({"a": pa.array(rep[linked], pa.int64()), "b": pa.array(rep[root[linked]], pa.int64())})

    keyed = rows.select("family", "tile.low", "tile.i", "tile.j", "band", "own", "rep", "n", "shingles")
    return keyed.groupBy("family", "low", "i", "j").applyInArrow(join, "a long, b long")
