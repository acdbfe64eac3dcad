import numpy as np
import pytest
from pyspark.sql import functions as F

from tarnlake.llm import langid
from tarnlake.llm.queries import op3_language_id


def test_held_out_accuracy(spark, sf_dir):
    rows = op3_language_id(spark, sf_dir)
    truth = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    held = rows.join(truth, "doc_id").filter("held_out").collect()
    assert rows.count() == truth.count() and len(held) > 40
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) >= 0.95
    assert all(0 <= r["score"] <= 1 for r in held)


def test_labels_of_held_out_rows_are_not_read(spark, sf_dir, tmp_path):
    """Neither labels and sources of held-out rows nor those of any row at prediction change the result."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = F.expr("crc32(cast(cast(doc_id AS string) AS binary)) % 3 = 1")
    docs.withColumn("lang", F.when(held, "xx").otherwise(F.col("lang"))).withColumn("source", F.lit("s")).write.parquet(
        f"{tmp_path}/documents.parquet")
    def read(path):
        return {r["doc_id"]: r["lang_pred"] for r in op3_language_id(spark, path).collect()}

    assert read(str(tmp_path)) == read(sf_dir)


def test_families_first_then_pairs_within():
    model = langid.Model(["en", "de", "fr", "xx"], {}, langid.FAMILIES)
    assert model.steps == {"": ["germanic", "only xx", "romance"], "germanic": ["de", "en"], "romance": ["fr"], "only xx": ["xx"]}
    one = np.zeros(langid.BUCKETS + 1)
    one[-1] = 1.0
    model.pairs = {("", "germanic", "only xx"): -one, ("", "germanic", "romance"): -one, ("", "only xx", "romance"): one,
                   ("germanic", "de", "en"): one}
    label, score = model.predict(np.zeros(langid.BUCKETS))
    assert label == "en" and 0.7 < score < 0.8


def test_machine_separates_what_can_be_separated():
    rng = np.random.default_rng(1)
    x = rng.random((200, 50))
    y = np.where(x[:, 3] + x[:, 4] > 1, 1.0, -1.0)
    w = langid.fit(x, y)
    assert np.mean(np.sign(x @ w[:-1] + w[-1]) == y) > 0.97


def test_features_are_shares_of_the_whole_text():
    a = np.frombuffer(("abc def " * 30_000).encode(), np.uint8)
    x = langid.features(a)
    assert x.sum() == pytest.approx(len(langid.ORDERS))
    assert np.allclose(langid.features(np.frombuffer(b"Hello,  World", np.uint8)), langid.features(np.frombuffer(b"hello world", np.uint8)))
    assert langid.features(np.zeros(0, np.uint8)).shape == (langid.BUCKETS,)


def test_edge_rows(edge_docs, no_docs, texts):
    model = langid.train(edge_docs.withColumn("label", F.col("lang")))
    got = {(r["doc_id"], r["lang_pred"], r["score"]) for r in langid.predict(edge_docs, model).collect()}
    assert {label for _, label, _ in got} <= {"en", "de", "und"}
    silent = {i for i, t in texts if not any(c.isalpha() for c in t or "")}
    assert {1, 2, 3} <= silent
    assert all((label == "und") == (i in silent) or i is None for i, label, _ in got)
    assert langid.predict(no_docs, model).count() == 0


def test_nothing_to_learn_and_one_label(edge_docs, no_docs):
    empty = langid.train(no_docs.withColumn("label", F.col("lang")))
    assert {r["lang_pred"] for r in langid.predict(edge_docs, empty).collect()} == {"und"}
    one = langid.train(edge_docs.withColumn("label", F.lit("fr")))
    assert {r["lang_pred"] for r in langid.predict(edge_docs, one).collect()} == {"und", "fr"}


def test_the_sample_is_bounded_by_label(spark):
    rows = [(i, f"text {i} words", "en" if i % 10 else "de") for i in range(4000)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, label string"), per_label=100)
    assert set(model.pairs) == {("germanic", "de", "en")}
