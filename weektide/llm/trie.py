"""The prefix trie of all conversations: its nodes with members, children, leaves and shared words.

Method: vertical bitmaps. In each shard an index from (position, turn) to the bitset of conversations is
walked depth first: the bitset of a node and the posting of a member's next turn intersect in a child, the
popcount is its members, and what no posting takes ends there. Shards are merged by the key of a node.

*Keys.* A turn at a position has a 128-bit hash; the key of a node is the exclusive-or over its turns, so that
the key at any place of a long conversation is known without walking to it. Shards are hence cut twice: by
ranges of conversation ids, and by bands of positions; each holds a bounded number of turns.

*Sums over subtrees.* The smallest member owns a node; from the depth where a conversation begins to own its
nodes it owns all deeper ones. So each leaf, and one pass over the words of each node, belongs to exactly one
conversation, and the sums add up over members: the shards are walked once more with the bitsets of owners.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weektide.llm._shared import shuffle_parts, staged

#: Conversation ids of one shard, positions of one band, numbers of turns that are counted off at a time.
SHARD, BAND, RANGE = 512, 256, 4096
EMPTY = hashlib.sha256(b"").hexdigest()


def _hash(salt: str) -> Column:
    return F.xxhash64(F.lit(salt), "role", "text")


def _positions(turns: DataFrame) -> DataFrame:
    """``turns`` with p, its place in the conversation from 1: by turn (null first), role and text.

    Places are counted within ranges of turn numbers, so that a very long conversation is spread.
    """
    turns = turns.withColumn("span", F.expr(f"turn div {RANGE}"))
    order = [F.col("turn").asc_nulls_first(), "role", "text"]
    local = turns.withColumn("p", F.row_number().over(Window.partitionBy("conv_id", "span").orderBy(*order)))
    before = Window.partitionBy("conv_id").orderBy(F.col("span").asc_nulls_first())
    sizes = turns.groupBy("conv_id", "span").agg(F.count("*").alias("n"))
    sizes = sizes.select("conv_id", "span", (F.sum("n").over(before) - F.col("n")).alias("skip"))
    local, sizes = local.alias("l"), sizes.alias("r")
    on = (F.col("l.conv_id") == F.col("r.conv_id")) & F.col("l.span").eqNullSafe(F.col("r.span"))
    return local.join(sizes, on).select("l.conv_id", (F.col("l.p") + F.col("r.skip")).alias("p"), "l.h1", "l.h2", "l.words")


def rebuilt(conversations: DataFrame, block: int = 20, heads: int = 4) -> tuple[DataFrame, DataFrame]:
    """(turns, ids): turns (conv_id, d, h1, h2, words) after the change of heads, and all conversation ids.

    The first h turns of a conversation c are those of conversation c - c % block (all, if it has fewer;
    none, if there is no such conversation); h is crc32(decimal c) % heads. d counts from 1.
    """
    own = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    own = own.withColumns({
        "h1": _hash("1"),
        "h2": _hash("2"),
        "words": F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long"),
    })
    own = staged(_positions(own), "turns")
    head = lambda c: F.crc32(c.cast("string")) % heads
    ids = own.groupBy("conv_id").agg(F.count("*").alias("n"))
    ids = staged(ids.select("conv_id", "n", head(F.col("conv_id")).alias("h"), (F.col("conv_id") - F.col("conv_id") % block).alias("base")), "ids")
    first = own.where((F.col("conv_id") % block == 0) & (F.col("p") < heads))
    first = first.select(F.col("conv_id").alias("base"), F.col("p").alias("d"), "h1", "h2", "words")
    # At most heads - 1 turns of a base meet the ids of its block.
    lent = ids.join(first, "base").where("d <= h").select("conv_id", "d", "h1", "h2", "words")
    bases = ids.where(F.col("conv_id") % block == 0).select(F.col("conv_id").alias("base"), F.col("n").alias("held"))
    shift = ids.join(bases, "base", "left").select(
        "conv_id", "h", (F.least("h", F.coalesce("held", F.lit(0))) - F.col("h")).alias("shift")
    )
    rest = own.join(shift, "conv_id").where("p > h")
    rest = rest.select("conv_id", (F.col("p") + F.col("shift")).alias("d"), "h1", "h2", "words")
    turns = lent.unionByName(rest)
    # The hash of a turn takes in its position.
    salted = [F.xxhash64("d", F.lit(k), "h1", "h2").alias(f"h{k}") for k in (1, 2)]
    return turns.select("conv_id", "d", *salted, "words"), ids.select("conv_id")


def _segments(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """One row for each conversation and band: its turns, the key where the band begins, what follows it.

    A conversation without turns has one empty band. e1, e2: key at the beginning; final: the last band;
    after: words behind the band.
    """
    turns = turns.withColumn("band", F.expr(f"cast((d - 1) div {BAND} as int)"))
    bands = turns.groupBy("conv_id", "band").agg(
        F.array_sort(F.collect_list(F.struct("d", "h1", "h2", "words"))).alias("turns"),
        F.bit_xor("h1").alias("x1"),
        F.bit_xor("h2").alias("x2"),
        F.sum("words").alias("sum"),
    )
    order = Window.partitionBy("conv_id").orderBy("band")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy("conv_id").orderBy(F.col("band").desc()).rowsBetween(Window.unboundedPreceding, -1)
    bands = bands.select(
        "conv_id",
        "band",
        F.coalesce(F.bit_xor("x1").over(earlier), F.lit(0)).cast("long").alias("e1"),
        F.coalesce(F.bit_xor("x2").over(earlier), F.lit(0)).cast("long").alias("e2"),
        F.coalesce(F.sum("sum").over(later), F.lit(0)).cast("long").alias("after"),
        F.lead("band").over(order).isNull().alias("final"),
        *(F.col(f"turns.{c}").alias(c) for c in ("h1", "h2", "words")),
    )
    none = F.array().cast("array<bigint>")
    bands = ids.join(bands, "conv_id", "left")
    return bands.select(
        "conv_id",
        F.coalesce("band", F.lit(0)).alias("band"),
        *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("e1", "e2", "after")),
        F.coalesce("final", F.lit(True)).alias("final"),
        *(F.coalesce(c, none).alias(c) for c in ("h1", "h2", "words")),
    )


def _walk(rows: list[dict]):
    """All nodes of one shard, parents first: (index of the parent or -1, depth, key, parent's key, members, ends,
    words, next: members that go on in the next band). Bitsets are integers over the rows' places."""
    start = rows[0]["band"] * rows[0]["width"]
    postings: list[dict] = []
    for at, row in enumerate(rows):
        for d, turn in enumerate(zip(row["h1"], row["h2"], strict=True)):
            while len(postings) <= d:
                postings.append({})
            postings[d][turn] = postings[d].get(turn, 0) | 1 << at
    stops: dict[int, int] = {}
    for at, row in enumerate(rows):
        stops[len(row["h1"])] = stops.get(len(row["h1"]), 0) | 1 << at
    final = sum(1 << at for at, row in enumerate(rows) if row["final"])
    entries: dict = {}
    for at, row in enumerate(rows):
        key = (row["e1"], row["e2"])
        entries[key] = entries.get(key, 0) | 1 << at
    stack = [(-1, 0, key, None, bits, 0) for key, bits in entries.items()]
    nodes = 0
    while stack:
        parent, d, key, above, bits, words = stack.pop()
        ends = bits & stops.get(d, 0)
        left, children = bits & ~ends, []
        while left:
            row = rows[(left & -left).bit_length() - 1]
            turn = (row["h1"][d], row["h2"][d])
            child = left & postings[d][turn]
            children.append((nodes, d + 1, (key[0] ^ turn[0], key[1] ^ turn[1]), key, child, row["words"][d]))
            left &= ~child
        yield parent, start + d, key, above, bits, ends & final, words, ends & ~final
        stack += reversed(children)
        nodes += 1


def _members(bits: int) -> Iterator[int]:
    while bits:
        low = bits & -bits
        yield low.bit_length() - 1
        bits ^= low


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Rows of one band and range of ids at a time, from a partition sorted by them."""
    held: list[dict] = []
    for batch in batches:
        for at in range(0, len(batch), 256):
            for row in batch.slice(at, 256).to_pylist():
                if held and (held[0]["shard"], held[0]["band"]) != (row["shard"], row["band"]):
                    yield held
                    held = []
                held.append(row)
    if held:
        yield held


def conversation_trie(conversations: DataFrame, block: int = 20, heads: int = 4) -> DataFrame:
    """One row for each distinct sequence of first turns of the rebuilt conversations (see :func:`rebuilt`).

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256 and, for further use, the key (k1, k2) of the node and that of its parent.

    ``conversations`` needs conv_id, turn, role and text; other columns are ignored. Rows without conv_id
    belong to no conversation; null role and text are empty; null turns come first; rows of the same turn
    are ordered by role and text; repeated rows are turns of their own. A conversation that loses all its
    turns is a member of the root alone. An empty table gives no rows, not even a root. Turns are told
    apart by 128 bits. The ids that end at a node are hashed in their order, as a stream: no list is held.
    """
    turns, ids = rebuilt(conversations, block, heads)
    segments = staged(_segments(turns, ids), "segments")
    parts = shuffle_parts(segments.sparkSession)

    def dealt(df: DataFrame) -> DataFrame:
        shard = F.floor(F.col("conv_id") / SHARD).alias("shard")
        df = df.select("*", shard, F.lit(BAND).alias("width")).repartition(parts, "shard", "band")
        return df.sortWithinPartitions("shard", "band", "conv_id")

    node = "k1 long, k2 long, p1 long, p2 long, depth int, n long, conv_id long, words long, ends array<long>"

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["k1", "k2", "p1", "p2", "depth", "n", "conv_id", "words", "ends"]
        kinds = [*[pa.int64()] * 4, pa.int32(), *[pa.int64()] * 3, pa.list_(pa.int64())]
        for rows in _shards(batches):
            out = []
            for parent, depth, key, above, bits, ends, words, _ in _walk(rows):
                if parent < 0 and depth:
                    continue  # the node where a band begins was told by the band before
                low = rows[(bits & -bits).bit_length() - 1]["conv_id"]
                out.append((*key, *(above or (None, None)), depth, bits.bit_count(), low, words, [rows[k]["conv_id"] for k in _members(ends)]))
                if len(out) == 4096:
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names)
                    out = []
            if out:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names)

    local = staged(dealt(segments).mapInArrow(nodes, node), "local")
    merged = local.groupBy("k1", "k2", "depth").agg(
        F.sum("n").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max("words").alias("words"),
        F.max("p1").alias("p1"), F.max("p2").alias("p2"),
    )
    merged = staged(merged, "nodes")
    children = merged.where("depth > 0").groupBy("p1", "p2").agg(F.count("*").alias("n_children"))
    children = staged(children, "children")
    tree = merged.alias("n").join(
        children.alias("c"), (F.col("n.k1") == F.col("c.p1")) & (F.col("n.k2") == F.col("c.p2")), "left"
    ).select("n.*", F.coalesce("c.n_children", F.lit(0)).alias("n_children"))
    tree = staged(tree, "tree")
    owners = tree.groupBy("conv_id").agg(
        F.min("depth").alias("owns"), F.sum("words").alias("owned"), F.max(F.expr("n_children = 0")).alias("leaf")
    )

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _shards(batches):
            leaf = sum(1 << at for at, row in enumerate(rows) if row["leaf"])
            owned: dict[int, int] = {}
            for at, row in enumerate(rows):
                if row["owns"] is not None:
                    owned[row["owns"]] = owned.get(row["owns"], 0) | 1 << at
            since, upto = {}, 0
            found = list(_walk(rows))
            for depth in sorted({x[1] for x in found} | owned.keys()):
                upto |= owned.get(depth, 0)
                since[depth] = upto
            saved = [0] * len(found)
            for k in range(len(found) - 1, -1, -1):
                parent, depth, _, _, bits, _, words, on = found[k]
                saved[k] += words * (bits & ~since[depth]).bit_count()
                for at in _members(on):
                    row = rows[at]
                    saved[k] += max(0, row["after"] - (row["owned"] or 0))
                if parent >= 0:
                    saved[parent] += saved[k]
            kept = [k for k, x in enumerate(found) if x[0] >= 0 or not x[1]]
            for low in range(0, len(kept), 4096):
                part = kept[low : low + 4096]
                yield pa.record_batch(
                    [
                        pa.array([found[k][2][0] for k in part], pa.int64()),
                        pa.array([found[k][2][1] for k in part], pa.int64()),
                        pa.array([(found[k][4] & leaf).bit_count() for k in part], pa.int64()),
                        pa.array([saved[k] for k in part], pa.int64()),
                    ],
                    ["k1", "k2", "n_leaves", "saved_tokens"],
                )

    shared = dealt(segments.join(owners, "conv_id", "left")).mapInArrow(sums, "k1 long, k2 long, n_leaves long, saved_tokens long")
    shared = shared.groupBy("k1", "k2").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha, out = None, None, []

        def told() -> pa.RecordBatch:
            return pa.record_batch(
                [pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()), pa.array([x[2] for x in out], pa.string())],
                ["k1", "k2", "ends_sha256"],
            )

        for batch in batches:
            for k1, k2, ids in zip(*(batch[c].to_pylist() for c in ("k1", "k2", "ends")), strict=True):
                text = ",".join(map(str, ids)).encode()
                if (k1, k2) == key:
                    sha.update(b"," + text)
                    continue
                if key is not None:
                    out.append((*key, sha.hexdigest()))
                key, sha = (k1, k2), hashlib.sha256(text)
            if len(out) > 4096:
                yield told()
                out = []
        if key is not None:
            out.append((*key, sha.hexdigest()))
        if out:
            yield told()

    ends = local.where("size(ends) > 0").select("k1", "k2", "ends", F.col("ends")[0].alias("first"))
    ends = ends.repartition(parts, "k1", "k2").sortWithinPartitions("k1", "k2", "first")
    ends = ends.mapInArrow(digests, "k1 long, k2 long, ends_sha256 string")
    above = tree.where("n_children > 0").select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    return (
        tree.join(shared, ["k1", "k2"])
        .join(ends, ["k1", "k2"], "left")
        .join(above, ["p1", "p2"], "left")
        .select(
            "conv_id",
            F.col("depth").cast("long").alias("depth"),
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"),
            "k1",
            "k2",
            "p1",
            "p2",
        )
    )
