"""The physical plans the operators count on."""

from pyspark.sql import functions as F

from clickweave.operators import joins, ordering
from clickweave.plans import views
from clickweave.plans.catalog import BUILDERS, SQL
from conftest import final_plan, plan


def test_date_range_and_kind_reach_the_scan(spark, small):
    text = plan(views.actions(spark, small, "2024-01-05", "2024-01-06", kind="click"))
    pushed = text.split("PushedFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(ts" in pushed and "LessThan(ts" in pushed and "EqualTo(event_type,click)" in pushed


def test_only_used_columns_are_read(spark, small):
    schema = plan(BUILDERS["sum_by_key"](spark, small)).split("ReadSchema: ")[1].split(">")[0]
    assert schema == "struct<l_suppkey:bigint,l_quantity:double"


def test_top_n_is_cut_before_the_shuffle(spark, small):
    assert "TakeOrderedAndProject" in plan(BUILDERS["top_ten"](spark, small))
    text = plan(BUILDERS["top3_per_category"](spark, small))
    assert "WindowGroupLimit" in text and text.index("Final") < text.index("Partial")


def test_small_side_is_broadcast(spark, small):
    assert "BroadcastHashJoin" in plan(BUILDERS["join_broadcast"](spark, small))


def test_months_read_only_their_folders(spark, small):
    assert "PartitionFilters: [month" in plan(BUILDERS["src_month_pruned"](spark, small))


def test_distributed_rank_has_no_window_over_rows(spark):
    df = spark.range(0, 100).select("id", (F.col("id") % 2).alias("k"))
    text = final_plan(ordering.rank_in_group(df, ["k"], ["id"]))
    windows = text.count("+- Window") + text.count("Window [")
    assert windows and "row_number" not in text


def test_no_query_uses_a_cross_join(spark, small):
    for key in ("join_full", "join_bucketed", "posts_vs_average", "task_params", "tfidf_sql", "page_convert_rate"):
        text = plan(BUILDERS[key](spark, small))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, key


def test_every_sql_has_a_builder():
    assert set(SQL) == set(BUILDERS)


def test_symmetric_anti_join_keeps_null_keys(spark):
    a = spark.createDataFrame([(1, "x"), (None, "y")], "k int, a string")
    b = spark.createDataFrame([(1, "u"), (None, "v")], "k int, b string")
    got = {(r.a, r.b) for r in joins.anti_both(a, b, ["k"]).collect()}
    assert got == {("y", None), (None, "v")}
