"""The stages of the corpus pipeline one after the other, on rows that need care."""

import random

import pytest

import corpus_pipeline
from orefold.llm import common, cotraining, packing
from orefold.llm.queries import WORD_VOCABULARY


@pytest.fixture
def folder(spark, tmp_path):
    """documents with clashing and dotted column names, null ids and texts, copies and a long shared passage; labels."""
    rng = random.Random(4)
    passage = " ".join(f"shared{k}" for k in range(60))
    rows, labels = [], []
    for k in range(120):
        good = k % 2 == 0
        words = [rng.choice(["river", "stone", "morning", "letter", "window"] if good else ["$$$", "win!!", "###", "CLICK", "buy"]) + str(rng.randrange(40))
                 for _ in range(60)]
        text = " ".join(words) + ("\n" + passage if k in (10, 20) else "")
        rows.append((k, text, "en", "a" if good else "b", len(text), "own score", "own dot"))
        if k % 3:
            labels.append((k, int(good), 0))
    rows += [(500, rows[4][1], "en", "a", 5, "own score", "x"), (None, rows[6][1] + " end", "en", "a", 5, "own score", "x"),
             (501, None, None, None, None, None, None), (502, "", "en", "a", 0, None, None)]
    names = ["doc_id", "text", "lang", "source", "n_chars", "score", "a.b"]
    spark.createDataFrame(rows, ", ".join(f"`{n}` {'bigint' if n in ('doc_id', 'n_chars') else 'string'}" for n in names)).repartition(
        3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality bigint, toxic bigint").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def test_stages_keep_columns_and_their_decisions(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, now, folder)
        assert after.columns == docs.columns, name
        before_ids, ids = ({(r.doc_id, r["a.b"]) for r in x.select("doc_id", "`a.b`").collect()} for x in (now, after))
        assert ids <= before_ids, name
        now = spark.createDataFrame(after.collect(), docs.schema)
    kept = {r.doc_id for r in now.collect()}
    assert {k for k in range(0, 120, 2)} - kept <= {4, 6} and not {k for k in range(1, 120, 2)} & kept and 500 not in kept
    texts = {r.doc_id: r.text for r in now.collect()}
    assert "shared30" in texts[10] and "shared30" not in texts[20]
    assert all(r.score in ("own score", None) for r in now.collect())
    packed = corpus_pipeline.run(spark, folder)
    want = packing.pack_documents(now, WORD_VOCABULARY)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, packed.select(columns).collect()), key=str) == sorted(map(tuple, want.select(columns).collect()), key=str)
    assert {r.doc_id for r in cotraining.classify(docs.drop("score"), labels).where("not kept").collect()} >= {k for k in range(1, 120, 2)}


@pytest.mark.parametrize("labels", ["true", "quality = 1"])
def test_a_trained_classifier_leaves_no_stored_rows(spark, folder, tmp_path, labels, monkeypatch):
    monkeypatch.setattr(common, "work_dir", lambda spark, purpose: f"{tmp_path}/stored/{purpose}")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = cotraining.keep_good(docs, spark.read.parquet(f"{folder}/labels.parquet").where(labels))
    assert (tmp_path / "stored").is_dir() and not list((tmp_path / "stored").iterdir())
    assert 0 < kept.count() <= docs.count()


@pytest.mark.parametrize("labels", ["quality = 5", "quality = 1"])
def test_without_labels_of_both_classes_all_rows_stay(spark, folder, labels):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    few = spark.read.parquet(f"{folder}/labels.parquet").where(labels)
    assert cotraining.keep_good(docs, few).count() == docs.count()
    assert cotraining.classify(docs, few).where("score is not null").count() == 0


def test_an_empty_table_passes_all_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs_after = stage(spark, docs, folder)
        assert docs_after.count() == 0
