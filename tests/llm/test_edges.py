"""Null and repeated ids, repeated rows, clashing columns, empty tables: each has a defined result."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from scorchmap.llm import brown_lm, fingerprints, packing, substring_dedup, token_counts, token_files
from test_exact import BYTE_BPE, WORD_BPE

LONG = " ".join(f"word{k}" for k in range(60))
ROWS = [(None, LONG), (1, LONG), (1, LONG), (2, LONG + " more"), (2, "other"), (3, None), (None, None), (4, "")]


@pytest.fixture(scope="module")
def docs(spark):
    wide = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3)
    return wide.select("doc_id", "text", *(F.lit(1).alias(c) for c in ("n_tokens", "length", "start", "spans", "anchor", "bucket", "last", "found", "key", "mark")))


def test_rows_stay_rows(spark, docs, tmp_path):
    none = docs.where("doc_id = 99")
    for run in (
        lambda d: token_counts.count_tokens(d, BYTE_BPE),
        lambda d: packing.pack_documents(d, WORD_BPE, 1).where("start = 0"),
        lambda d: fingerprints.edit_report(d, 3),
        lambda d: substring_dedup.removal_report(d),
        lambda d: brown_lm.score(d, *brown_lm.train(d)),
        lambda d: token_files.read_token_files(spark, f"file://{tmp_path}/{d is none}", token_files.write_token_files(d, f"file://{tmp_path}/{d is none}", WORD_BPE, 2, 3)),
    ):
        got = [r.doc_id for r in run(docs).collect()]
        assert sorted(got, key=repr) == sorted((k for k, _ in ROWS), key=repr)
        assert run(none).count() == 0


def test_removal_by_ids(docs):
    got = sorted((repr(r.doc_id), r.n_words, r.n_removed) for r in substring_dedup.removal_report(docs).collect())
    # rows without an id neither own nor lose words; spans found for an id hold for all its rows
    assert got == sorted([("None", 60, 0), ("1", 60, 0), ("1", 60, 0), ("2", 61, 60), ("2", 1, 1), ("3", 0, 0), ("None", 0, 0), ("4", 0, 0)])


def test_equal_texts_have_equal_fingerprints(docs):
    got = fingerprints.edit_report(docs, 3).where("n_chars > 0").select("n_chars", "fingerprint").distinct().count()
    assert got == 3


def test_pipeline_stages(spark, docs, tmp_path):
    d = f"file://{tmp_path}"
    docs = docs.withColumns({"row among rows": F.lit(2), "c0": F.lit("x"), "a.b": F.col("doc_id"), "odd`name": F.lit(1), "map": F.create_map(F.lit("k"), F.col("doc_id"))})
    spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(None, "word1 word2")], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    _, near, repeats, clean, pack = (f for _, f in corpus_pipeline.STAGES)
    one = near(spark, docs, d)
    assert one.columns == docs.columns
    # of two texts of one document that is kept, the least one stays
    assert sorted((repr(r.doc_id), r.text) for r in one.where("text is not null").collect()) == [("1", LONG), ("4", ""), ("None", LONG)]
    for stage in (near, repeats, clean, pack):
        assert stage(spark, docs.limit(0), d).count() == 0
    assert repeats(spark, docs, d).count() == len(ROWS) and clean(spark, docs, d).count() == len(ROWS)
    docs.limit(0).write.parquet(f"{d}/documents.parquet")
    assert corpus_pipeline.run(spark, d).count() == 0
