import zlib

import numpy as np

from clickweave.llm import quality as q
from llm_help import no_docs, odd_docs, rows  # noqa: F401

FEW = q.Settings(buckets=1 << 12, epochs=6, least_steps=600)


def test_held_out_rows(spark):
    got = rows(spark.range(50).selectExpr("id AS doc_id").select("doc_id", q.is_held_out()))
    assert got == sorted(((i, zlib.crc32(str(i).encode()) % 4 == 2) for i in range(50)), key=repr)


def test_accuracy_on_rows_it_has_not_seen(spark, small):
    docs, labels = spark.read.parquet(f"{small}/documents.parquet"), spark.read.parquet(f"{small}/labels.parquet")
    got = q.judge(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in got]) >= 0.9
    assert np.mean([r.predicted for r in got if r.quality == 1]) >= 0.95


def test_scores_are_the_softmax_of_the_mean():
    bags = q.Bags(FEW)
    texts = ["a clean text", "JUNK!! JUNK!! JUNK!!", "more clean words here", "LOUD!! THINGS!!"]
    model = q.trained(list(bags(texts)), [1, 0, 1, 0], FEW)
    scorer = q.Scorer(model, FEW)
    said = [*texts, "", "unseen unseen words", "ÄÖ 中文 😀 a \ud800"]
    for score, bag in zip(scorer(said), bags(said)):
        assert abs(score - model.probabilities(model.mean(*bag))[1]) < 1e-5
    clean, junk = list(scorer(texts))[:2]
    assert clean > 0.5 > junk


def test_features_of_many_words_are_those_of_each_alone():
    words = ["a", "ab", "word", "中", "😀x", "<>", "é" * 5000, "\ud800"]
    features, owners = q.features_of(words, FEW)
    for i, w in enumerate(words):
        alone, _ = q.features_of([w], FEW)
        assert sorted(features[owners == i]) == sorted(alone)
        marked = len(w) + 2
        assert len(alone) == 1 + sum(max(0, marked - n + 1) for n in (2, 3, 4))  # the word and its n-grams
    assert len(set(q.features_of(["word"], q.Settings())[0])) == 13
    assert [len(x) for x in q.features_of([], FEW)] == [0, 0]


def test_cold_and_warm_scorers_agree():
    bags = q.Bags(FEW)
    texts = [" ".join(f"w{i * j % 91}" for j in range(i)) for i in range(200)] + ["x " * 800_000, "y"]
    model = q.trained(list(bags(texts[:50])), [i % 2 for i in range(50)], FEW)
    scorer = q.Scorer(model, FEW)
    first, again = list(scorer(texts)), list(scorer(texts[::-1]))[::-1]
    assert np.allclose(first, again, atol=1e-12)
    scorer.reset()
    assert np.allclose(list(scorer(texts[5:9])), first[5:9], atol=1e-12)


def test_odd_rows_and_labels(spark, odd_docs):
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 1), (99, 0), (4, 0), (4, 0), (5, 7)], "doc_id long, quality int")
    got = q.judge(odd_docs, labels, s=FEW).collect()
    assert len(got) == odd_docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    kept = q.keep_good(odd_docs, labels, threshold=0.0, s=FEW)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()


def test_empty_tables(spark, no_docs, odd_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert q.judge(no_docs, labels, s=FEW).collect() == []
    assert {r.score for r in q.judge(odd_docs, labels, s=FEW).collect()} == {0.5}


def test_the_sample_is_bounded(spark):
    docs = spark.range(60).selectExpr("id AS doc_id", "concat('word', id) AS text")
    labels = spark.range(60).selectExpr("id AS doc_id", "cast(id % 2 AS int) AS quality")
    tight = q.Settings(buckets=1 << 12, least_steps=50, train_rows=5, train_features=10)
    one, two = (q.train(docs.repartition(n), labels, tight) for n in (1, 7))
    assert one.packed() == two.packed()  # the order of rows does not matter


def test_many_documents_of_one_sampled_id(spark):
    docs = spark.range(3000).selectExpr("id % 3 AS doc_id", "concat('word', id) AS text").unionByName(
        spark.range(500).selectExpr("0L AS doc_id", "'' AS text"))
    labels = spark.createDataFrame([(0, 1), (1, 0)], "doc_id long, quality int")
    tight = q.Settings(buckets=1 << 12, least_steps=50, train_rows=20)
    one, two = (q.train(docs.repartition(n), labels, tight) for n in (1, 7))
    assert one.packed() == two.packed()
    assert q.sample(docs, labels, tight).count() == 20
