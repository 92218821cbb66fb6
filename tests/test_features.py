import math

from pyspark.sql import functions as F

from clickweave.operators import features

TEXTS = ["Hi I heard about Spark", "I wish Java could use case classes", "Logistic regression models are neat"]


def docs(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string")


def test_tfidf(spark):
    got = {(r.id, r.term): r.tfidf for r in features.tfidf(docs(spark), "id", F.split(F.lower("text"), " ")).collect()}
    assert len(got) == 17
    assert math.isclose(got[0, "i"], math.log(4 / 3)) and math.isclose(got[2, "neat"], math.log(4 / 2))


def test_hashed_tfidf_agrees_with_its_own_counts(spark):
    out = features.hashed_tfidf(docs(spark), "text").select(features.as_array("raw_features").alias("tf"), features.as_array("features").alias("x")).collect()
    assert [sum(r.tf) for r in out] == [5, 7, 5] and all(len(r.x) == 20 for r in out)
    for slot in range(20):
        df = sum(1 for r in out if r.tf[slot] > 0)
        assert all(math.isclose(r.x[slot], r.tf[slot] * math.log(4 / (df + 1)), abs_tol=1e-12) for r in out)


def test_document_vector_is_the_mean_of_its_words(spark):
    df = docs(spark).select("id", F.split("text", " ").alias("words"))
    model = features.word_vectors(df, "words", partitions=2)
    vectors = {r.word: r.vector.toArray() for r in model.getVectors().collect()}
    assert len(vectors) == 16 and all(len(v) == 3 for v in vectors.values())
    hashed = df.select("id", features.bucketed_words(F.col("words")).alias("words"))
    for row in model.transform(hashed).collect():
        mean = sum(vectors[w] for w in row.words) / len(row.words)
        assert abs(mean - row.features.toArray()).max() < 1e-6


def test_the_vocabulary_is_bounded(spark):
    df = docs(spark).select("id", F.split("text", " ").alias("words"))
    assert features.word_vectors(df, "words", buckets=4).getVectors().count() <= 4
    out = features.document_vectors(df, "words", buckets=4)
    assert [len(r.words) for r in out.orderBy("id").collect()] == [5, 7, 5]


def test_common_and_other_terms_score_the_same(spark):
    texts = [f"all w{i % 5} w{i % 5} rare{i} {'long' * 30}" for i in range(60)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(3, "all again"), (None, "all"), (99, None)], "id int, text string")
    score = lambda **o: features.tfidf(df, "id", F.split("text", " "), **o)
    want = {}
    for i, text in df.collect():
        for term in (text or "").split():
            want[i, term] = want.get((i, term), 0) + 1
    n = lambda term: sum(term in (t or "").split() for _, t in df.collect())
    idf = {term: math.log((63 + 1) / (n(term) + 1)) for _, term in want}
    for terms in (1000, 6):
        got = score(common_terms=terms).collect()
        assert len(got) == len(want) and {(r.id, r.term): r.tf for r in got} == want
        assert all(math.isclose(r.tfidf, r.tf * idf[r.term], abs_tol=1e-12) for r in got)
