"""Contained items against plain sets of word shingles."""

import random
import re

from weektide.llm import contamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, n, percent):
    out = []
    for doc, text in docs:
        words = words_of(text)
        for item, wanted in items:
            own = words_of(wanted)
            k = min(n, len(own))
            if k:
                want = {tuple(own[i : i + k]) for i in range(len(own) - k + 1)}
                shared = len(want & {tuple(words[i : i + k]) for i in range(len(words) - k + 1)})
                if 100 * shared >= percent * len(want):
                    out.append((doc, item, shared, len(want)))
    return sorted(out, key=str)


def test_equals_plain_sets(spark, monkeypatch):
    pick = random.Random(3)
    word = lambda: pick.choice(["Ab", "cd", "é", "x1", "ef", "gh", "the", "long-word", "verylongwordindeed"])
    items = [(k, " ".join(word() for _ in range(size))) for k, size in enumerate((1, 3, 5, 6, 14, 30, 30, 55))]
    items += [(90, None), (91, ""), (92, "..."), (None, items[4][1])]
    docs = [(7, None), (8, ""), (9, "cd")]
    for k in range(60):
        text = " ".join(word() for _ in range(pick.choice([3, 40, 400])))
        own = (items[pick.randrange(8)][1]).upper().split(" ")
        for _ in range(pick.choice([0, 1, 3])):
            own[pick.randrange(len(own))] = word()
        docs.append((k + 10, f"{text}.\n{', '.join(own)}; {text}"))
    docs += [docs[-1], (None, docs[-1][1])]
    table = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items, 5, 80)
    assert len(want) > 60
    # Documents in many rows; filters that let everything through.
    for piece, bits in ((4096, (12, 27)), (2, (6, 7))):
        monkeypatch.setattr(contamination, "PIECE", piece)
        monkeypatch.setattr(contamination, "FILTER_BITS", bits)
        got = contamination.contained_items(table, bench).drop("containment").collect()
        assert sorted(map(tuple, got), key=str) == want
    assert contamination.contained_items(table, bench.where("false")).collect() == []
    assert contamination.contained_items(table.where("false"), bench).collect() == []


def test_a_very_long_document(spark):
    pick = random.Random(4)
    word = lambda: f"w{pick.randrange(10**6)}"
    items = [(k, " ".join(word() for _ in range(size))) for k, size in enumerate((1, 4, 9, 40, 300))]
    long = [word() for _ in range(60_000)]
    for at, (_, text) in zip((0, 9_000, 20_000, 59_000, 60_100), items):
        long[at:at] = text.split()
    docs = [(1, " ".join(long)), (2, " ".join(long[:8_000])), (2, " ".join(long[:8_000]))]
    got = contamination.contained_items(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    )
    assert sorted(map(tuple, got.drop("containment").collect())) == brute(docs, items, 5, 80)


def test_many_items_with_a_common_beginning(spark):
    """Items of all sizes that share a template, copies of one of them, and documents at every share of an item's shingles."""
    pick = random.Random(5)
    word = lambda: f"w{pick.randrange(10**6)}"
    template = "which one of the following answers is the best".split()
    items = [(k, " ".join(template + [word() for _ in range(k % 90)])) for k in range(600)]
    items += [(1000 + k, items[70][1]) for k in range(200)]
    docs = []
    for k in range(40):
        own = items[pick.randrange(600)][1].split()
        cut = pick.randrange(len(own) // 2, len(own) + 1)
        docs.append((k, " ".join([word() for _ in range(50)] + own[:cut] + [word() for _ in range(50)])))
    docs += [(100 + k, items[70][1]) for k in range(30)]
    got = contamination.contained_items(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    )
    want = brute(docs, items, 5, 80)
    assert sorted(map(tuple, got.drop("containment").collect()), key=str) == want
    assert len(want) > 30 * 200


def test_signatures_are_partitioned_by_size_and_miss_nothing(spark):
    items = [(k, " ".join(f"w{k}x{j}" for j in range(size + 4))) for k, size in enumerate((1, 2, 5, 40, 300))]
    texts = spark.createDataFrame(items, "item_id long, text string").select("text")
    need = contamination.F.ceil(contamination.F.col("n_item") * 80 / 100).cast("int")
    signed = contamination._signatures(contamination._items(texts, 5).withColumn("need", need))
    got = sorted(map(tuple, signed.groupBy("k1", "k2", "need", "hits").count().select("need", "hits", "count").collect()))
    # n - need + hits values: that many are met even when n - need shingles are missing.
    assert got == [(1, 1, 1), (2, 1, 1), (4, 2, 3), (32, 3, 11), (240, 5, 65)]


def test_rows_without_items_stay_as_they_are(spark):
    docs = [(1, "a b c d e f", 1, "x"), (1, "a b c d e f", 1, "x"), (2, "clean", 2, None), (2, "clean", 2, None), (None, None, None, None)]
    table = spark.createDataFrame(docs, "doc_id long, text string, t1 long, k1 string")
    items = spark.createDataFrame([(1, "A, b. c d e f", 5)], "item_id long, text string, t1 long")
    got = contamination.without_items(table, items)
    assert got.columns == table.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted(docs[2:], key=str)
    assert got.select("text").where("text = 'clean'").count() == 2
    assert sorted(map(tuple, contamination.without_items(table, items.where("false")).collect()), key=str) == sorted(docs, key=str)
