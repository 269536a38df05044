"""Each stage of the corpus pipeline against a brute-force version, on the smallest given tables and on odd rows."""

import os

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

import __spark_entry__ as contract  # noqa: E402
from tests.llm import test_contamination, test_jaccard, test_secrets  # noqa: E402

FOLDER = contract.SMOKE_FOLDER
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="given tables are not there")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    given = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    item = spark.read.parquet(f"{FOLDER}/benchmark.parquet").first()["text"]
    prose = given[0][1]
    more = [prose, f"{prose} and", f"{item}\n{prose[:200]}", f"x {test_secrets.SECRET} y", None, "", None]
    odd = [(10_000 + k, t, None, "s", 1) for k, t in enumerate(more)] + [(10_000, prose, None, "s", 1), (None, prose, None, None, None)]
    return spark.createDataFrame(given + odd, SCHEMA).cache()


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_names_and_columns(spark, docs):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "secrets", "tokens"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, FOLDER).columns == docs.columns
        assert stage(spark, docs.where("false"), FOLDER).collect() == []


def test_quality_rejects_and_keeps_rows_as_they_are(spark, docs):
    kept = rows(corpus_pipeline.quality(spark, docs, FOLDER))
    assert set(kept) < set(rows(docs))
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    ids = {r[0] for r in kept}
    right = [(d in ids) == bool(q) for d, q in labels.items()]
    assert sum(right) >= 0.95 * len(right)


def test_near_duplicates(spark, docs):
    every = rows(docs)
    group = test_jaccard.brute([(r[0], r[1]) for r in every if r[0] is not None], 5, 80)
    want = {r for r in every if r[0] is None or group[r[0]][1] == r[0]}
    got = rows(corpus_pipeline.near_duplicates(spark, docs, FOLDER))
    assert set(got) == want and len(got) == len(want)


def test_decontamination(spark, docs):
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    hit = {d for d, *_ in test_contamination.brute([(k, r[1]) for k, r in enumerate(rows(docs))], items, 5, 80)}
    want = [r for k, r in enumerate(rows(docs)) if k not in hit]
    assert hit and rows(corpus_pipeline.decontamination(spark, docs, FOLDER)) == want


def test_secrets_are_gone(spark, docs):
    got = {r[0]: r for r in rows(corpus_pipeline.secrets(spark, docs, FOLDER))}
    for r in rows(docs):
        text = got[r[0]][1]
        assert got[r[0]][2:4] == r[2:4]
        if not test_secrets.plain(r[1] or ""):
            assert text == r[1]
        else:
            assert test_secrets.plain(text) == [] and "[secret]" in text and got[r[0]][4] == len(text)


def test_tokens(spark, docs):
    import tiktoken

    from weektide.llm import bpe

    codec = bpe._codec(bpe._read(corpus_pipeline.public_tokenizers.path("byte_bpe_50k.tiktoken")), corpus_pipeline.public_tokenizers.PATTERN)
    assert isinstance(codec._plain, tiktoken.Encoding)
    got = corpus_pipeline.tokens(spark, docs, FOLDER).collect()
    want = sorted((str(r[0]), codec._plain.encode_ordinary(r[1] or "")) for r in rows(docs))
    assert sorted((str(r.doc_id), r.tokens) for r in got) == want
    assert all(r.exact and r.n_tokens == len(r.tokens) for r in got)


def test_whole_run(spark):
    got = corpus_pipeline.run(spark, FOLDER).collect()
    assert 0 < len(got) < spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert all(r.exact for r in got)
