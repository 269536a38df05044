"""The registered queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weektide.llm.bpe import decode_tokens, encode_texts
from weektide.llm.contamination import contained_items
from weektide.llm.jaccard import jaccard_groups
from weektide.llm.knn import top_k
from weektide.llm.langid import languages, learn
from weektide.llm.lexical import ranked_search
from weektide.llm.licenses import license_scan
from weektide.llm.pieces import decode_pieces, encode_pieces
from weektide.llm.quality import quality_scores, train
from weektide.llm.quotes import reply_order
from weektide.llm.secrets import KINDS, secret_spans
from weektide.llm.substrings import remove_repeats
from weektide.llm.trie import conversation_trie


def op1_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    tokens = encode_texts(docs, *vocabulary).select("doc_id", "tokens")
    return decode_tokens(tokens, *vocabulary).select(
        "doc_id",
        F.size("tokens").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("tokens").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def _joined(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def op2_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_spans(spark.read.parquet(f"{folder}/documents.parquet"))
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in KINDS),
        F.sha2(_joined("base"), 256).alias("base_sha256"),
        _joined("spans").alias("spans"),
        "n_layers",
        "n_unread",
    )


def op3_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{folder}/documents.parquet"), words=35).drop("kept")


def op4_exact_topk(spark: SparkSession, folder: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{folder}/embeddings.parquet"), "vec_id % 50 = 0", k=5, scale=256.0)


def op5_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    return contained_items(spark.read.parquet(f"{folder}/documents.parquet"), items, words=5, percent=80)


def op6_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    return reply_order(spark.read.parquet(f"{folder}/conversations.parquet"))


def op7_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_groups(spark.read.parquet(f"{folder}/documents.parquet"), words=3, percent=90)


def _remainder(n: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % n


def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    tables = learn(docs.where(_remainder(4) != 2))
    held_out = F.coalesce(_remainder(4) == 2, F.lit(True)).alias("held_out")
    return languages(docs, tables).select("doc_id", held_out, "lang_pred", "score", F.size("spans").alias("n_spans"))


def op9_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    model = train(docs, labels.where(_remainder(5) != 0).select("doc_id", F.col("quality").alias("label")))
    held_out = F.coalesce(_remainder(5) == 0, F.lit(True)).alias("held_out")
    return quality_scores(docs, model).select(
        "doc_id", held_out, "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted")
    )


def op10_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan(spark.read.parquet(f"{folder}/documents.parquet"))


def op11_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    docs, items = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "benchmark"))
    return ranked_search(docs, items, k=10)


def op12_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    nodes = conversation_trie(spark.read.parquet(f"{folder}/conversations.parquet"), block=20, heads=4)
    return nodes.drop("k1", "k2", "p1", "p2")


def op13_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    ids = encode_pieces(docs, model).select("doc_id", "pieces")
    return decode_pieces(ids, model).select(
        "doc_id",
        F.size("pieces").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("pieces").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_secret_scan": op2_secret_scan,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_exact_topk": op4_exact_topk,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_chat_formatting": op6_chat_formatting,
    "op7_ngram_jaccard": op7_ngram_jaccard,
    "op8_language_id": op8_language_id,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_license_scan": op10_license_scan,
    "op11_lexical_search": op11_lexical_search,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_sentencepiece": op13_sentencepiece,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_LETTERS = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')".format(_LOWER)

SQL: dict[str, str] = {
    "op3_substring_dedup": r"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
        ),
        windows AS (
            SELECT r, p, array_to_string(w[p:p + 34], ' ') AS s
            FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS p FROM d WHERE len(w) >= 35)
        ),
        often AS (SELECT s FROM windows GROUP BY 1 HAVING count(*) > 1),
        gone AS (SELECT DISTINCT r, unnest(range(p, p + 35)) AS k FROM windows SEMI JOIN often USING (s)),
        kept AS (
            SELECT r, string_agg(word, ' ' ORDER BY k) AS words, count(*) AS n
            FROM (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS k FROM d) ANTI JOIN gone USING (r, k) GROUP BY 1
        )
        SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(words, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (r)""",
    "op5_benchmark_decontamination": f"""
        WITH i AS (SELECT item_id, {_LETTERS} AS w FROM benchmark),
        ni AS (SELECT item_id, w, least(5, len(w)) AS k FROM i WHERE len(w) > 0),
        items AS (
            SELECT DISTINCT item_id, k, array_to_string(w[p:p + k - 1], ' ') AS s
            FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM ni)
        ),
        d AS (SELECT doc_id, {_LETTERS} AS w FROM documents),
        shingles AS (
            SELECT DISTINCT doc_id, k, array_to_string(w[p:p + k - 1], ' ') AS s
            FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p
                  FROM d, (SELECT DISTINCT k FROM items) WHERE len(w) >= k)
        ),
        sizes AS (SELECT item_id, count(*) AS n_item FROM items GROUP BY 1),
        shared AS (SELECT doc_id, item_id, count(*) AS n_shared FROM shingles JOIN items USING (k, s) GROUP BY 1, 2)
        SELECT doc_id, item_id, n_shared, n_item, n_shared / n_item AS containment
        FROM shared JOIN sizes USING (item_id) WHERE 100 * n_shared >= 80 * n_item""",
    "op4_exact_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
            FROM embeddings
            WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        s AS (
            SELECT q.vec_id AS query_id, d.vec_id, CAST(list_dot_product(q.e, d.e) AS BIGINT) AS score
            FROM v q JOIN v d ON q.vec_id <> d.vec_id AND len(q.e) = len(d.e) WHERE q.vec_id % 50 = 0
        ),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5""",
    "op11_lexical_search": f"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_LETTERS} AS w FROM documents),
        s AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_all FROM d WHERE len(w) > 0),
        tf AS (
            SELECT r, doc_id, n, t, count(*) AS tf FROM (SELECT r, doc_id, len(w) AS n, unnest(w) AS t FROM d) GROUP BY ALL
        ),
        q AS (
            SELECT item_id, t, count(*) AS q
            FROM (SELECT item_id, unnest({_LETTERS}) AS t FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY ALL
        ),
        df AS (SELECT t, count(*) AS df FROM tf GROUP BY 1),
        w AS (SELECT t, CAST(floor(1000 * ln((2.0::DOUBLE * n_docs + 2) / (2.0::DOUBLE * df + 1))) AS BIGINT) AS w FROM df, s),
        scored AS (
            SELECT item_id, r, doc_id, CAST(sum(
                q * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_all)))) AS BIGINT) AS score
            FROM q JOIN w USING (t) JOIN tf USING (t), s GROUP BY ALL
        ),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS rank
            FROM scored WHERE score > 0
        )
        SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10""",
    "op12_conversation_trie": r"""
        WITH turns AS (
            SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p
            FROM conversations WHERE conv_id IS NOT NULL
        ),
        ids AS (
            SELECT c, n, c - c % 20 AS base, xor(4294967295, list_reduce(list_concat([4294967295], flatten(
                list_transform(range(1, len(s) + 1), lambda k: [ascii(s[k]), 0, 0, 0, 0, 0, 0, 0]))),
                lambda crc, b: xor(xor(crc, b) >> 1, 3988292384 * (xor(crc, b) & 1)))) % 4 AS h
            FROM (SELECT c, CAST(c AS VARCHAR) AS s, count(*) AS n FROM turns GROUP BY ALL)
        ),
        placed AS (
            SELECT i.c, t.p AS d, role, text FROM ids i JOIN turns t ON t.c = i.base WHERE t.p <= h
            UNION ALL
            SELECT i.c, p - i.h + least(i.h, coalesce(b.n, 0)), role, text
            FROM ids i JOIN turns t ON t.c = i.c LEFT JOIN ids b ON b.c = i.base WHERE t.p > i.h
        ),
        paths AS (
            SELECT ids.c, coalesce(list({'role': role, 'text': text} ORDER BY d) FILTER (d IS NOT NULL), []) AS path
            FROM ids LEFT JOIN placed ON placed.c = ids.c GROUP BY 1
        ),
        steps AS (SELECT c, path, unnest(range(0, len(path) + 1)) AS depth FROM paths),
        nodes AS (
            SELECT path[1:depth] AS node, depth, min(c) AS conv_id, count(*) AS n_convs,
                   sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (len(path) = depth), '')) AS ends_sha256
            FROM steps GROUP BY 1, 2
        ),
        children AS (SELECT node[1:depth - 1] AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
        weighed AS (
            SELECT nodes.*, coalesce(n_children, 0) AS n_children, CASE WHEN depth = 0 THEN 0 ELSE
                   (n_convs - 1) * len(regexp_extract_all(node[depth].text, '[^\x20\x09-\x0D]+')) END AS saved
            FROM nodes LEFT JOIN children USING (node)
        ),
        sums AS (
            SELECT node, count(*) FILTER (n_children = 0) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens
            FROM (SELECT node[1:d] AS node, n_children, saved FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM weighed))
            GROUP BY 1
        )
        SELECT w.conv_id, w.depth, p.conv_id AS parent_conv_id, w.n_convs, w.n_children, n_leaves, saved_tokens, w.ends_sha256
        FROM weighed w JOIN sums USING (node) LEFT JOIN nodes p ON p.node = w.node[1:w.depth - 1] AND p.depth = w.depth - 1""",
}
