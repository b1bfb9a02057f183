"""The stages of the pipeline on a small folder of tables."""

import random

import pytest

import corpus_pipeline
from scorchmap.llm.queries import QUERIES


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rnd = random.Random(8)
    d = f"file://{tmp_path_factory.mktemp('tables')}"
    vocabulary = ["".join(rnd.choices("abcdefgh", k=rnd.randint(2, 7))) for _ in range(500)]
    text = lambda n: " ".join(rnd.choices(vocabulary, k=n))
    docs = [text(rnd.randint(60, 200)) for _ in range(300)]
    for k in range(0, 300, 5):
        docs[k] = docs[k].replace(" ", " vile ", 1).replace(" ", " scumbag ", 3)
    item = text(30)
    docs += [docs[1], docs[2] + " more", f"{text(30)} {item}", f"{' '.join(docs[7].split()[:55])} {text(60)}"]
    rows = [(k, t, "en", f"s{k % 3}", len(t)) for k, t in enumerate(docs)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(k, 1, int(k % 5 == 0)) for k in range(300)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d, docs


def test_stages(spark, folder):
    d, texts = folder
    docs = spark.read.parquet(f"{d}/documents.parquet")
    kept = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, d)
        assert out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), docs.schema)
        kept.append({r.doc_id: r.text for r in docs.collect()})
    assert kept[0].keys() == {k for k in range(304) if k % 5 or k >= 300}
    assert kept[1].keys() == kept[0].keys() - {300, 301}
    assert kept[2].keys() == kept[1].keys() and kept[2][303] == " ".join(texts[303].split()[55:])
    assert {k: t for k, t in kept[2].items() if k != 303} == {k: t for k, t in kept[1].items() if k != 303}
    assert kept[3] == {k: t for k, t in kept[2].items() if k != 302}
    pieces = corpus_pipeline.pack(spark, docs, d)
    assert {r.doc_id for r in pieces.collect()} == kept[3].keys()


def test_run_has_all_columns(spark, folder):
    out = corpus_pipeline.run(spark, folder[0])
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] and out.count() > 0


def test_every_operator_has_a_query():
    assert {int(q[2:].split("_")[0]) for q in QUERIES if q.startswith("op")} == set(range(1, 14))


def test_texts_are_not_shuffled_to_drop_near_duplicates(spark, capsys, monkeypatch):
    """Whatever Spark's own limit on broadcasts; with more ids than are sent, the same rows stay."""
    texts = [" ".join(f"w{k * 100 + j}" for j in range(40)) for k in range(6)]
    rows = [(k, t) for k, t in enumerate(texts)] + [(10, texts[2]), (11, texts[4] + " more"), (12, None), (None, texts[0])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = corpus_pipeline.one_of_each_group(spark, docs, "")
        capsys.readouterr()
        out.explain()
        assert "SortMergeJoin" not in capsys.readouterr().out
        want = sorted([(k, t) for k, t in enumerate(texts)] + [(12, None), (None, texts[0])], key=repr)
        assert sorted(map(tuple, out.collect()), key=repr) == want
        monkeypatch.setattr(corpus_pipeline.ngram_join, "MAX_NAMED", 1)
        assert sorted(map(tuple, corpus_pipeline.one_of_each_group(spark, docs, "").collect()), key=repr) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
