import math
import random

from pyspark.sql import functions as F

from clickweave.llm import va_search as v
from llm_help import rows


def brute(vectors, asked, k, scale=256):
    sound = []
    for i, (name, x) in enumerate(vectors):
        if name is not None and x is not None and all(c is not None and math.isfinite(c) for c in x):
            sound.append((i, name, [math.floor(scale * c) for c in x]))
    out = []
    for i, name, q in sound:
        if asked(name):
            best = sorted(((-sum(a * b for a, b in zip(q, x)), other) for j, other, x in sound if j != i))[:k]
            out += [(name, r, other, -score) for r, (score, other) in enumerate(best, 1)]
    return sorted(out, key=repr)


def check(spark, vectors, k=5, every=3, **blocks):
    df = spark.createDataFrame([(n, x, 0, "r") for n, x in vectors], "vec_id long, embedding array<float>, class int, rank string")
    exact = [(r.vec_id, r.embedding) for r in df.select("vec_id", "embedding").collect()]
    got = v.search(df.repartition(3), F.col("vec_id") % every == 0, k, **blocks)
    assert rows(got, "query_id", "rank", "vec_id", "score") == brute(exact, lambda n: n % every == 0, k)


def test_random_vectors_in_blocks(spark):
    draw = random.Random(1)
    check(spark, [(i, [draw.gauss(0, 0.3) for _ in range(12)]) for i in range(400)], asked_block=20, file_block=60)


def test_copies_ties_and_odd_rows(spark):
    draw = random.Random(2)
    hot = [0.5, -0.25, 0.125]
    vectors = [(i, hot if i % 3 else [draw.choice([-0.5, 0.0, 0.5]) for _ in range(3)]) for i in range(150)]
    vectors += [(3, hot), (6, hot), (6, hot), (6, hot), (None, hot), (9, None), (12, [None, 1.0, 1.0]), (15, [math.nan, 0.0, 0.0]), (18, [math.inf, 0.0, 0.0])]
    vectors += [(21, []), (24, [0.5]), (27, [-1e6, 1e6, 3.0])]
    check(spark, vectors, asked_block=10, file_block=16)


def test_few_rows(spark):
    check(spark, [(0, [1.0, 2.0])])
    check(spark, [(0, [1.0, 2.0]), (1, [0.0, 0.0]), (3, [1.0, 1.0])])
    check(spark, [(1, [1.0])])
    check(spark, [])
