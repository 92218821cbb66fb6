from pyspark.sql import functions as F

from clickweave.operators import organize
from conftest import rows


def test_parents_keep_and_orphans_go(spark):
    parents = spark.createDataFrame([(1, "p"), (2, "q")], "k int, name string")
    children = spark.createDataFrame([(1, 5, "b"), (1, 4, "a"), (9, 1, "z")], "k int, id int, t string")
    nested = organize.nest_children(parents, children, "k", ["id", "t"], ["id"])
    got = {(r.k, r.page): [tuple(c) for c in r.children] for r in nested.collect()}
    assert got == {(1, 0): [(4, "a"), (5, "b")], (2, 0): []}


def test_children_come_in_pages(spark):
    parents = spark.createDataFrame([(1,), (2,)], "k int")
    children = spark.range(0, 600).select(F.when(F.col("id") % 3 == 0, 2).otherwise(1).alias("k"), "id")
    nested = organize.nest_children(parents, children, "k", ["id"], ["id"], 50)
    assert {(r.k, r.page): r.n for r in nested.select("k", "page", F.size("children").alias("n")).collect()} == {
        (k, p): 50 for k, n in ((1, 400), (2, 200)) for p in range(n // 50)
    }
    assert rows(nested.select("k", F.explode("children.id"))) == rows(children, "k", "id")


def test_questions_without_answers(spark):
    posts = spark.createDataFrame([(1, 0, "q"), (1, 2, "b"), (1, 1, "a"), (2, 0, "lonely"), (3, 1, "orphan")], "k int, turn int, t string")
    qa = organize.question_answers(posts, "k", F.col("turn") == 0, ["turn", "t"], ["turn"])
    assert {r.k: [tuple(a) for a in r.answers] for r in qa.collect()} == {1: [(1, "a"), (2, "b")], 2: []}


def test_a_record_goes_to_every_bin(spark):
    df = spark.createDataFrame([(1, "ab"), (2, "b"), (3, "c")], "id int, t string")
    out = organize.binned(df, {"has-a": F.col("t").contains("a"), "has-b": F.col("t").contains("b")})
    assert rows(out, "id", "bin") == [(1, "has-a"), (1, "has-b"), (2, "has-b")]


def test_posts_against_mean(spark):
    posts = spark.createDataFrame([(1,), (1,), (1,), (2,), (3,), (3,), (None,)], "u int")
    users = spark.createDataFrame([(1, 10.0), (2, 20.0)], "u int, reputation double")
    got = organize.posts_against_mean(posts, users, "u")
    assert rows(got, "u", "posts", "reputation", "bin") == [(1, 3, 10.0, "above"), (2, 1, 20.0, "below"), (3, 2, None, "above")]
    assert rows(organize.reputation_by_bin(got)) == [("above", 2, 10.0), ("below", 1, 20.0)]
    assert rows(organize.folded_chain(posts, users, "u", 15), "posts", "reputation", "total", "bin") == [
        (1, 20.0, 1, "above"), (3, 10.0, 3, "below"),
    ]


def test_merged_outputs_keep_copies_on_one_side_only(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y"), (None, "z")], "u long, t string")
    got = organize.anonymized_and_distinct(df, "u", ["u"], [])
    assert rows(got, "output", "value") == [
        ("anonymized", '{"t":"x"}'), ("anonymized", '{"t":"x"}'), ("anonymized", '{"t":"y"}'), ("anonymized", '{"t":"z"}'),
        ("distinct", "1"), ("distinct", "2"),
    ]


def test_shuffle_keeps_rows_and_changes_order(spark):
    df = spark.range(0, 500, 1, 4)
    mixed = [r[0] for r in organize.shuffled(df, 3).collect()]
    assert sorted(mixed) == list(range(500)) and mixed != list(range(500))
