"""A training-data pipeline over ``documents``: each stage works on all that the one before it kept.

1. toxicity: documents with a score of 0.5 or more go.
2. near duplicates: one document of each group of linked ones (five-word shingles, Jaccard 0.8) stays: that with the least doc_id.
3. repeated passages: words in windows of 50 that a document with a smaller doc_id has are taken out; rows stay.
4. decontamination: documents of which at least a twentieth of the words is in benchmark windows go.
5. packing: one row for each piece of a training sequence.

Rows with a null doc_id pass stages 2 and 3 as they are. Rows of one doc_id are one document in stage 2: that with the least text
stays. Empty tables give no rows; further columns, whatever their names, are kept up to packing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scorchmap.llm import decontaminate, ngram_join, packing, substring_dedup, toxicity
from scorchmap.storage import materialize, new_path, remove


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.reject_toxic(docs, toxicity.fit(docs, labels.where(~toxicity.held_out())))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = ngram_join.similarity_components(docs.where("doc_id is not null"), ngram_join.Similarity(grams=5, percent=80))
    ids = materialize(found.groupBy("doc_id").agg(F.min("component_id").alias("component_id"), F.count("*").alias("rows")), "ids")
    gone = ids.where("doc_id != component_id").select("doc_id")
    # up to so many ids are sent to the texts; beyond, these are shuffled once
    gone = F.broadcast(gone) if gone.limit(ngram_join.MAX_NAMED + 1).count() <= ngram_join.MAX_NAMED else gone
    every = [F.col(f"`{c.replace('`', '``')}`") for c in docs.columns]
    out = docs.where("doc_id is not null").join(gone, "doc_id", "left_anti").select(*every)
    if not ids.where("rows > 1 and doc_id = component_id").isEmpty():
        # as strings, since maps have no hash
        line = Window.partitionBy("doc_id").orderBy(F.col("text").asc_nulls_last(), F.xxhash64(*(c.cast("string") for c in every)))
        out = out.withColumn("row among rows", F.row_number().over(line)).where("`row among rows` = 1").select(*every)
    return out.union(docs.where("doc_id is null").select(*every))


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(docs, window=50)


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=13, coverage=0.05)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    pieces = packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("toxicity", reject_toxic), ("near duplicates", one_of_each_group), ("substring dedup", remove_repeats), ("decontamination", remove_contaminated), ("packing", pack)]

#: Model scores, connected components and packing are beyond SQL; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = new_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove(spark, before)  # only the last stage's input has to stay
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
