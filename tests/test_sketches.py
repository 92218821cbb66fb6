"""Distinct counts from daily sketches."""

from pyspark.sql import functions as F

from clickweave.operators import sketches
from clickweave.workspace import fresh_dir
from conftest import plan, rows


def visits(spark, first, n, users):
    return spark.range(n).selectExpr(f"date_format(date'2024-01-01' + CAST({first} + id % 3 AS int), 'yyyy-MM-dd') AS d", f"id * 7919 % {users} AS u")


def test_merged_days_estimate_a_range_within_the_error(spark):
    log = sketches.sketch_log(spark, fresh_dir(spark, "uv"), every=2)
    arrivals = [visits(spark, i, 6000, 5000) for i in range(5)]
    for i, rows_ in enumerate(arrivals):
        log.write(sketches.daily_sketches(rows_, F.col("d"), "u"), i)
        log.write(sketches.daily_sketches(rows_, F.col("d"), "u"), i)  # tried again
    assert log.folded() >= 1
    everything = arrivals[0]
    for other in arrivals[1:]:
        everything = everything.unionByName(other)
    for days in (("2024-01-01", "2024-01-07"), ("2024-01-03", "2024-01-04")):
        exact = everything.where(F.col("d").between(*days)).select("u").distinct().count()
        got = sketches.distinct_in(log.rows(days), F.lit("all")).first()["distinct"]
        assert abs(got - exact) <= 5 * sketches.standard_error() * exact
    assert "PartitionFilters: [isnotnull(_day" in plan(log.rows(("2024-01-03", "2024-01-04")))


def test_a_late_day_is_merged_and_folds_change_nothing(spark):
    log = sketches.sketch_log(spark, fresh_dir(spark, "uv"), every=2)
    parts = [[("d1", 1), ("d1", 2), ("d1", None)], [("d2", 2)], [("d1", 2), ("d1", 3)], [("d3", None)]]
    for i, part in enumerate(parts):
        log.write(sketches.daily_sketches(spark.createDataFrame(part, "d string, u long"), F.to_date(F.lit("2024-01-01")).cast("string"), "u"), i)
    assert rows(sketches.distinct_in(log.rows(), F.col("day"))) == [("2024-01-01", 3)]


def test_empty_table(spark):
    log = sketches.sketch_log(spark, fresh_dir(spark, "uv"))
    log.write(sketches.daily_sketches(spark.createDataFrame([], "d string, u long"), F.col("d"), "u"), 0)
    assert rows(sketches.distinct_in(log.rows(), F.lit("all"))) == []
