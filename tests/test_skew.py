"""One key holds a third of all rows; results must equal those of the plain operators."""

import pytest
from pyspark.sql import Window as W, functions as F

from clickweave.operators import aggregates, joins, ordering, skew
from conftest import final_plan, plan, rows

N = 3000


@pytest.fixture(scope="module")
def big(spark):
    """Ids 0..N-1; key 7 in every third row, a null key in some."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.col("id") % 40)
    return spark.range(0, N, 1, 6).select("id", key.cast("int").alias("k"), F.pmod(F.hash("id"), F.lit(97)).alias("v"))


@pytest.fixture(scope="module")
def small_side(spark):
    return spark.range(0, 30).select(F.col("id").cast("int").alias("k"), F.concat(F.lit("n"), F.col("id")).alias("name")).union(
        spark.createDataFrame([(None, "nobody"), (999, "far")], "k int, name string")
    )


def test_hot_keys(big):
    assert 7 in skew.hot_keys(big, "k", 0.2)
    assert len(skew.hot_keys(big, "k", 0.2)) <= 5


def test_split_and_salted_joins(big, small_side):
    want = rows(big.join(small_side, "k"), "id", "k", "name")
    assert rows(skew.split_join(big, small_side, "k", ["id"], 4, 0.1), "id", "k", "name") == want
    assert rows(skew.salted_join(big, small_side, "k", ["id"], 5), "id", "k", "name") == want


def test_salted_sum(big):
    want = rows(big.groupBy("k").agg(F.sum("v").alias("s")))
    assert rows(skew.salted_sum(big, ["k"], {"s": F.col("v")}, ["id"], 7)) == want


@pytest.mark.parametrize("how", ["left", "right", "full"])
def test_outer_joins(big, small_side, how):
    built = {"left": joins.left_outer, "right": joins.right_outer, "full": joins.full_outer}[how]
    columns = ["id", "k", "v", "name"]
    assert rows(built(big, small_side, ["k"]), *columns) == rows(big.join(small_side, "k", how), *columns)


def test_anti_both(big, small_side):
    want = big.join(small_side, "k", "left_anti").unionByName(small_side.join(big, "k", "left_anti"), allowMissingColumns=True)
    assert rows(joins.anti_both(big, small_side, ["k"]), "id", "k", "v", "name") == rows(want, "id", "k", "v", "name")


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_bucketed_join_merges_without_shuffle_or_sort(spark, big, small_side, how):
    joined = joins.bucketed(big, small_side, "k", 4, how, share=0.2)
    assert rows(joined, "id", "k", "name") == rows(big.join(small_side, "k", how), "id", "k", "name")
    if how == "inner":
        merged = plan(joined).split("SortMergeJoin")[1].split("\n   +- ")[0].split("AdaptiveSparkPlan")[0]
        first = merged.split("BroadcastHashJoin")[0].split("ShuffledHashJoin")[0]
        assert "Bucketed: true" in first


def test_merged_buckets_are_read_as_they_lie(spark):
    left = spark.range(4000).select((F.col("id") % 500).alias("k"), "id")
    right = spark.range(500).select(F.col("id").alias("k"), F.col("id").alias("v"))
    joined = joins.bucketed(left, right, "k", 4)
    tables = plan(joined).split("Union")[1] if "Union" in plan(joined) else plan(joined)
    merge = tables[tables.index("SortMergeJoin"):]
    merge = merge[: merge.index("Join", 20)] if "Join" in merge[20:] else merge
    assert "Exchange" not in merge and "Sort [" not in merge
    assert joined.count() == 4000


@pytest.mark.parametrize("how", ["inner", "left"])
def test_replicated_join_is_the_same_within_and_beyond_its_bounds(big, small_side, how):
    want = rows(big.join(small_side, "k", how), "id", "k", "v", "name")
    near = joins.replicated(big, small_side, ["k"], how)
    assert "BroadcastHashJoin" in plan(near) and rows(near, "id", "k", "v", "name") == want
    for bound in ({"max_rows": 5}, {"max_bytes": 50}):
        far = joins.replicated(big, small_side, ["k"], how, **bound)
        assert "ResolvedHint" not in far._jdf.queryExecution().analyzed().toString().split("Join")[0]
        assert rows(far, "id", "k", "v", "name") == want


@pytest.mark.parametrize("how", ["right", "full", "left_anti", "left_semi"])
def test_replicated_join_refuses_what_a_copied_side_cannot_do(big, small_side, how):
    with pytest.raises(ValueError):
        joins.replicated(big, small_side, ["k"], how)


def test_keyed_joins_with_map_columns_and_rows_of_only_a_key(spark, big, small_side):
    mapped = big.withColumn("m", F.create_map(F.lit("a"), "id"))
    got = skew.join_keyed(mapped, small_side.where("k IS NOT NULL"), ["k"], "left")
    want = mapped.join(small_side.where("k IS NOT NULL"), ["k"], "left")
    assert rows(got.select("id", "name", F.col("m")["a"])) == rows(want.select("id", "name", F.col("m")["a"]))
    assert rows(joins.full_outer(mapped, small_side, ["k"]).select("id", "name", F.col("m")["a"])) == rows(
        mapped.join(small_side, "k", "full").select("id", "name", F.col("m")["a"])
    )
    only = spark.range(0, 64_000, 1, 64).select(F.lit(1).alias("k"))
    assert only.select(skew.spread(only, 32).alias("s")).distinct().count() == 32
    assert skew.join_keyed(only, small_side.where("k = 1"), ["k"], "left_semi").count() == 64_000


def test_full_outer_reads_each_side_twice_at_most(spark):
    from clickweave.plans.catalog import BUILDERS

    text = final_plan(BUILDERS["join_full"](spark, "/root/testdata/sf0.01"))
    final = text.split("== Initial Plan ==")[0]
    assert final.count("customer.parquet") <= 2 and final.count("orders.parquet") <= 2


def test_values_have_one_line_each_whatever_the_group(big):
    known = big.where("k IS NOT NULL")
    listed = aggregates.grouped_values(known, "k", "id", "id")
    want = known.select("k", F.row_number().over(W.partitionBy("k").orderBy("id")).cast("long").alias("position"), F.col("id").alias("value"))
    assert rows(listed) == rows(want)


def test_positions_ranks_and_neighbours(big):
    order = [F.desc("v"), F.asc("id")]
    got = ordering.with_position(big, order)
    assert rows(got, "id", "position") == rows(big.select("id", F.row_number().over(W.orderBy(*order)).cast("long")))
    ranked = ordering.rank_in_group(big, ["k"], order)
    assert rows(ranked, "id", "rank") == rows(big.select("id", F.row_number().over(W.partitionBy("k").orderBy(*order)).cast("long")))
    before = ordering.with_previous(big, ["k", "v", "id"], ["id"])
    want = big.select("id", F.lag("id").over(W.orderBy("k", "v", "id")))
    assert rows(before.select("id", "previous.id")) == rows(want)


def test_total_order_has_even_sorted_partitions(big):
    run = ordering.sorted_run(big, ["k", "id"], 4)
    parts = run.where("k IS NOT NULL").groupBy("_part").agg(
        F.min(F.struct("k", "id")).alias("low"), F.max(F.struct("k", "id")).alias("high"), F.count("*").alias("n")
    ).orderBy("_part").collect()
    assert all(tuple(a.high) < tuple(b.low) for a, b in zip(parts, parts[1:]))
    assert max(p.n for p in parts) < 0.6 * N  # the hot key is cut by its ids


def test_top_of_a_large_group_in_parts(big):
    order = [F.desc("v"), F.asc("id")]
    want = rows(ordering.top_per_group(big, ["k"], order, 40), "k", "id", "rank")
    assert rows(ordering.top_per_group(big, ["k"], order, 40, spread=["id"], salts=8), "k", "id", "rank") == want


def test_top_of_very_many(big):
    with pytest.raises(ValueError):
        ordering.top_per_group(big, ["k"], [F.desc("v")], 1500)
    many = ordering.top_per_group(big, ["k"], [F.desc("v")], 1500, spread=["id"])
    want = big.withColumn("rank", F.row_number().over(W.partitionBy("k").orderBy(F.desc("v"), "id")).cast("long")).where("rank <= 1500")
    assert rows(many, "k", "id", "rank") == rows(want, "k", "id", "rank")


def test_cogroup(spark):
    a = spark.createDataFrame([(1, 10, 0), (1, 11, 1), (2, 20, 2)], "k int, v int, id int")
    b = spark.createDataFrame([(1, 5, 0), (3, 6, 1)], "k int, w int, id int")
    got = joins.cogroup_values(a, b, "k", "v", "w", ("id", "id"))
    assert rows(got) == sorted([(1, "left", 1, 10), (1, "left", 2, 11), (2, "left", 1, 20), (1, "right", 1, 5), (3, "right", 1, 6)], key=repr)


def test_skew_join_is_split_at_run_time(spark, big, small_side):
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for name, value in changed.items():
        spark.conf.set(name, value)
    try:
        assert "skew=true" in final_plan(joins.inner(big, small_side, ["k"]))
        joined = joins.left_outer(big, small_side, ["k"])  # salted, as not every outer join is split at run time
        assert joined.where("k = 7").select(F.spark_partition_id()).distinct().count() > 1
    finally:
        for name in changed:
            spark.conf.unset(name)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
