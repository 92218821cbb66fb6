"""Small inputs whose answers are plain."""

from pyspark.sql import Row, functions as F

from clickweave.functions import registered, scalars
from clickweave.operators import aggregates, filters, joins, ordering, text
from clickweave.sources import readers
from clickweave.workspace import fresh_dir
from conftest import rows


def test_grades(spark):
    df = spark.createDataFrame([(0,), (59,), (70,), (79,), (80,), (100,)], "grade int")
    got = df.select("grade", scalars.grade("grade").alias("level"), scalars.good_or_bad("grade").alias("word"))
    assert {r.grade: (r.level, r.word) for r in got.collect()} == {
        0: ("E", "BAD"), 59: ("E", "BAD"), 70: ("C", "BAD"), 79: ("C", "BAD"), 80: ("B", "GOOD"), 100: ("A", "GOOD"),
    }


def test_row_number_in_group(spark):
    df = spark.createDataFrame([("north", w) for w in (12, 31, 7)] + [("south", 5)], "herd string, weight int")
    ranked = ordering.rank_in_group(df, ["herd"], [F.desc("weight")])
    assert rows(ranked, "herd", "weight", "rank") == [("north", 12, 2), ("north", 31, 1), ("north", 7, 3), ("south", 5, 1)]


def test_daily_visitors(spark):
    logs = [(f"2031-02-{d:02d}", u) for d, seen in ((3, "aab"), (4, "bbb"), (5, "abcd")) for u in seen]
    df = spark.createDataFrame(logs, "date string, user string")
    assert rows(aggregates.distinct_per_group(df, ["date"], "user", "uv")) == [("2031-02-03", 2), ("2031-02-04", 1), ("2031-02-05", 4)]


def test_lines_that_lost_a_field_are_dropped(spark):
    df = spark.createDataFrame([(x,) for x in ("mon,1.5,x", "mon,2.25,y", "mon,9.0,", "tue,4.0,z", "tue,3", "wed,1,2,3")], "line string")
    parts = F.split("line", ",")
    sums = filters.well_formed(df, "line", 3).groupBy(parts[0].alias("day")).agg(F.sum(parts[1].cast("double")).alias("s"))
    assert rows(sums) == [("mon", 3.75), ("tue", 4.0)]


def test_names_are_counted_nulls_included(spark):
    df = spark.createDataFrame([(n,) for n in ("ash", None, "oak", "ash", None, None)], "name string")
    got = {r.name: r.n for r in df.groupBy("name").agg(registered.str_count("n")).collect()}
    assert got == {"ash": 2, "oak": 1, None: 3}


def test_inner_join(spark):
    trees = spark.createDataFrame([(4, "elm"), (5, "fir"), (6, "yew")], "id int, tree string")
    heights = spark.createDataFrame([(5, 31), (6, 9), (7, 12)], "id int, height int")
    assert rows(joins.inner(trees, heights, ["id"])) == [(5, "fir", 31), (6, "yew", 9)]


def test_sums_and_counters(spark):
    few, path = spark.range(2, 9).withColumnRenamed("id", "n"), fresh_dir(spark, "observed")
    assert aggregates.observed(few, {"total": F.sum("n")}) == {"total": 35}
    assert aggregates.observed(few, {"rows": F.count(F.lit(1))}, path) == {"rows": 7} and spark.read.parquet(path).count() == 7
    assert spark.range(1, 11, 1, 4).agg(F.sum("id")).first()[0] == 55


def test_clean_words(spark):
    df = spark.createDataFrame([("Can't &lt;B&gt; stop--the B&amp;B",), (None,)], "t string")
    assert rows(text.word_counts(df, text.clean_words("t"))) == [("b", 3), ("cant", 1), ("stop", 1), ("the", 1)]


def test_dictionary_takes_the_first_known_word(spark):
    df = spark.createDataFrame([("Portland or WA",), ("ny",), ("Paris France",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(text.first_known("t")).collect()] == ["OR", "NY", "Unknown", "Null or Empty", "Null or Empty"]


def test_top_values_of_a_short_group_are_a_short_list(spark):
    df = spark.createDataFrame([("a", 1, 0), ("a", 9, 1), ("a", 5, 2), ("a", 7, 3), ("b", 4, 4)], "k string, v int, id int")
    best = ordering.top_values(df, "k", "v", 3, ["id"])
    assert {r.k: list(r["values"]) for r in best.collect()} == {"a": [9, 7, 5], "b": [4]}


def test_concat_renders_null(spark):
    registered.register(spark)
    got = spark.sql("SELECT concat_long_string(1, 'x', ':') a, concat_long_string(NULL, 'x', ':') b, concat_long_string(1, NULL, ':') c").first()
    assert tuple(got) == ("1:x", "null:x", "1:null")


def test_group_concat_keeps_a_label_contained_in_another(spark):
    df = spark.createDataFrame([("11:A",), ("1:A",), ("11:A",)], "c string")
    assert df.agg(registered.group_concat_distinct("c")).first()[0] == "11:A,1:A"


def test_link_index(spark):
    pages = spark.createDataFrame([(1, '<A HREF="/x">'), (2, '<a href="/x"><a href="/y"><a href="/y">'), (3, None)], "id long, body string")
    got = text.link_index(pages, "id", "body", 'href="([^"]+)"')
    assert rows(got, "link", "position", "id") == [("/x", 1, 1), ("/x", 2, 2), ("/y", 1, 2)]


def test_typed_rows(spark):
    from clickweave.plans.storage import Student

    df = spark.createDataFrame([Row(balance="2.5", name="x", id=7)])
    got = readers.typed(df, Student).first()
    assert (got.id, got.name, got.balance) == (7, "x", 2.5)
    assert got.asDict() == {"id": 7, "name": "x", "balance": 2.5}
