"""Text features: TF-IDF and Word2Vec."""

from __future__ import annotations

from pyspark.ml.feature import IDF, HashingTF, Tokenizer, Word2Vec
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from clickweave.operators.skew import join_keyed
from clickweave.workspace import stored


def hashed_tfidf(df: DataFrame, text: str, features: int = 20) -> DataFrame:
    """TF-IDF with hashed terms: a ``features`` vector of fixed length per text."""
    words = Tokenizer(inputCol=text, outputCol="words").transform(df)
    counted = HashingTF(inputCol="words", outputCol="raw_features", numFeatures=features).transform(words)
    model = IDF(inputCol="raw_features", outputCol="features").fit(counted.select("raw_features"))
    return model.transform(counted).drop("words")


def as_array(vector: str) -> Column:
    return vector_to_array(F.col(vector))


HOT_TERMS = 1000
COMMON_TERMS, COMMON_BYTES = 250_000, 64  # so many terms of at most so many bytes are copied to every task


def tfidf(df: DataFrame, row_id: str, words: Column, common_terms: int = COMMON_TERMS) -> DataFrame:
    """TF-IDF per (row, term): ``tf * ln((rows + 1) / (rows with the term + 1))``.

    Rows per term are counted from each row's distinct terms and combine before the shuffle. Texts, not their terms, are
    brought together by ``row_id`` to be counted, unless one id has too many rows for a task. The ``common_terms`` most
    frequent terms, which are most of all rows, meet their idf in a table copied to every task; the others are joined by
    term, and long terms that are frequent, which would gather in one task, are spread in that join.
    """
    most, total = df.groupBy(row_id).agg(F.count("*").alias("n")).agg(F.max("n"), F.sum("n")).first()
    total = total or 0
    found = df.select(F.explode(F.array_distinct(words)).alias("term")).where("term <> ''").groupBy("term").agg(F.count("*").alias("df"))
    idf = stored(found.select("term", "df", F.log((F.lit(total) + 1) / (F.col("df") + 1)).alias("idf")), "idf")
    short = idf.where(F.octet_length("term") <= COMMON_BYTES)
    common = stored(short.orderBy(F.desc("df"), "term").limit(common_terms).select("term", "idf"), "common-terms")
    others = stored(idf.join(F.broadcast(common), "term", "left_anti"), "other-terms")
    texts = df.repartition(row_id) if (most or 0) <= max(100, total // 100) else df
    tokens = texts.select(row_id, F.explode(words).alias("term")).where("term <> ''")
    often = tokens.join(F.broadcast(common), "term").groupBy(row_id, "term", "idf").agg(F.count("*").alias("tf"))
    scored = lambda counted: counted.select(row_id, "term", "tf", (F.col("tf") * F.col("idf")).alias("tfidf"))
    if others.isEmpty():
        return scored(often)
    top = others.where(F.col("df") * 100 > total).orderBy(F.desc("df"), "term").limit(HOT_TERMS)
    hot = [r[0] for r in top.select(F.xxhash64("term")).collect()]
    seldom = tokens.join(F.broadcast(common), "term", "left_anti").groupBy(row_id, "term").agg(F.count("*").alias("tf"))
    return scored(often).unionByName(scored(join_keyed(seldom, others.drop("df"), ["term"], row_id=[row_id], hot=hot)))


BUCKETS = 1 << 16


def bucketed_words(words: Column, buckets: int = BUCKETS) -> Column:
    """Words as bucket names, so that a vocabulary never has more than ``buckets`` entries."""
    return F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(buckets)).cast("string"))


def word_vectors(df: DataFrame, words: str, size: int = 3, seed: int = 1, partitions: int = 8, buckets: int = BUCKETS):
    """Word2Vec model over hashed words (see ``bucketed_words``).

    Training runs over ``partitions`` tasks whose vectors are averaged each round. The vocabulary lies on the
    driver, which is why it is bounded by ``buckets``.
    """
    estimator = Word2Vec(inputCol=words, outputCol="features", vectorSize=size, minCount=0, seed=seed, numPartitions=partitions)
    return estimator.fit(df.select(bucketed_words(F.col(words), buckets).alias(words)))


def document_vectors(df: DataFrame, words: str, buckets: int = BUCKETS, **options) -> DataFrame:
    """The mean of the vectors of each text's words, in ``features``."""
    model = word_vectors(df, words, buckets=buckets, **options)
    hashed = df.withColumn("_words", F.col(words)).withColumn(words, bucketed_words(F.col(words), buckets))
    return model.transform(hashed).withColumn(words, F.col("_words")).drop("_words")
