"""Text features."""

from pyspark.sql import functions as F

from clickweave.functions.scalars import words_of
from clickweave.operators import features
from clickweave.plans.registry import query
from clickweave.plans.views import table


SLOTS = 20


@query(
    "tfidf_hashing",
    f"""SELECT doc_id, {SLOTS} AS slots, CAST(len(regexp_split_to_array(lower(text), '\\s')) AS DOUBLE) AS tokens, TRUE AS weighted FROM documents""",
)
def tfidf_hashing(spark, folder):
    """Per text: slots, the sum of the raw counts (its tokens), and whether every slot is count times idf >= 0."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    found = features.hashed_tfidf(documents, "text", SLOTS).select(
        "doc_id", features.as_array("raw_features").alias("raw"), features.as_array("features").alias("x")
    )
    weighted = F.forall(F.arrays_zip("raw", "x"), lambda p: (p["x"] >= 0) & ((p["raw"] > 0) | (p["x"] == 0)))
    total = F.aggregate("raw", F.lit(0.0), lambda a, n: a + n)
    return found.select("doc_id", F.size("x").alias("slots"), total.alias("tokens"), weighted.alias("weighted"))


@query(
    "tfidf_sql",
    """WITH tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id,
        unnest(string_split(replace(lower(text), chr(10), ' '), ' ')) AS term FROM documents) WHERE term <> '' GROUP BY 1, 2),
    idf AS (SELECT term, ln(((SELECT count(*) FROM documents) + 1) / (count(*) + 1)) AS idf FROM tf GROUP BY 1)
    SELECT doc_id, term, tf, round(tf * idf, 6) AS tfidf FROM tf JOIN idf USING (term)""",
)
def tfidf_sql(spark, folder):
    scored = features.tfidf(table(spark, folder, "documents"), "doc_id", words_of(F.lower("text")))
    return scored.withColumn("tfidf", F.round("tfidf", 6))


@query("word2vec_docs", "SELECT conv_id, turn, 3 AS size, TRUE AS finite FROM conversations")
def word2vec_docs(spark, folder):
    turns = table(spark, folder, "conversations").select("conv_id", "turn", words_of("text").alias("words"))
    vectors = features.document_vectors(turns, "words")
    x = features.as_array("features")
    finite = F.forall(x, lambda v: ~F.isnan(v) & (F.abs(v) < float("inf")))
    return vectors.select("conv_id", "turn", F.size(x).alias("size"), finite.alias("finite"))
