"""The corpus pipeline: stages of operators of weektide.llm, each on all that its predecessor kept.

Rows without text keep their place until the last stage, unless the classifier rejects them.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weektide.llm._shared import staged
from weektide.llm.bpe import decode_tokens, encode_texts
from weektide.llm.contamination import without_items
from weektide.llm.jaccard import jaccard_groups
from weektide.llm.quality import accepted, train
from weektide.llm.secrets import redacted

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.3 or more; learned from the labelled rows that op9 learns from."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    return accepted(docs, train(docs, labels.select("doc_id", F.col("quality").alias("label"))), 0.3)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: that with the smallest doc_id, once; rows without doc_id stay.

    Shingles of five words, a similarity of 80 % or more.
    """
    groups = jaccard_groups(docs, words=5, percent=80)
    lead = staged(groups.where("component_id = doc_id").select("doc_id").distinct(), "lead")
    own = docs.where("doc_id is not null").join(lead.hint("merge"), "doc_id", "left_semi")
    own = own.select("doc_id", F.xxhash64("text").alias("h"), F.struct(*docs.columns).alias("row"))
    once = Window.partitionBy("doc_id", "h").orderBy("h")
    kept = own.withColumn("n", F.row_number().over(once)).where("n = 1").select("row.*")
    return kept.unionByName(docs.where("doc_id is null"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item (80 % of its shingles of five words)."""
    return without_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), words=5, percent=80)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets replaced and n_chars brought up to date."""
    return redacted(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, tokens, and whether the tokens decode to the text exactly."""
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    decoded = decode_tokens(encode_texts(docs.select("doc_id", "lang", "source", "text"), *vocabulary), *vocabulary)
    exact = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return decoded.select(
        "doc_id", "lang", "source", F.size("tokens").cast("long").alias("n_tokens"), "tokens", exact.alias("exact")
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("tokens", tokens),
]

#: The classifier, the set joins and the tokenizer have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = staged(docs, name)
    return docs
