"""Split-block Bloom filters: membership, merging, saving, and what a join shuffles."""

import pytest
from pyspark.sql import functions as F

from clickweave.operators import bloom, filters
from clickweave.operators.bloom import BlockBloom
from clickweave.workspace import fresh_dir
from conftest import rows


def docs_and_words(spark):
    docs = spark.createDataFrame([(i, f"alpha{i} beta{i % 7} common") for i in range(400)], "id int, text string")
    words = spark.createDataFrame([(f"alpha{i}",) for i in range(0, 400, 20)] + [("beta3",), (None,)], "word string")
    return docs, words, F.split("text", " ")


def test_size_keeps_the_stated_rate():
    for values, rate in ((1, 0.5), (50, 0.01), (20_000, 0.0001), (10**6, 0.001), (100, 1e-9)):
        blocks = bloom.blocks_for(values, rate)
        assert bloom.expected_rate(values, blocks) <= rate
        assert blocks == max(1, values // 400) or bloom.expected_rate(values, blocks - 1) > rate


def test_measured_rate_of_a_full_filter(spark):
    known = BlockBloom.trained(spark.range(5000).selectExpr("concat('in', id) AS v"), "v", 5000, 0.02)
    inside = known.keep(spark.range(5000).selectExpr("concat('in', id) AS v"), "v")
    outside = known.keep(spark.range(20_000).selectExpr("concat('out', id) AS v"), "v")
    assert inside.count() == 5000 and 200 < outside.count() < 600


@pytest.mark.parametrize("max_bytes", [64 << 20, 0])  # copied to every task, and joined by block
def test_members_stay_and_few_others(spark, max_bytes):
    docs, words, tokens = docs_and_words(spark)
    exact = set(rows(filters.keep_by_join(docs, tokens, words, "word", "id"), "id"))
    kept = BlockBloom.trained(words, "word", 50, 0.01).keep_any(docs, tokens, "id", max_bytes)
    assert kept.columns == docs.columns and kept.count() == len(set(rows(kept, "id")))
    assert exact <= set(rows(kept, "id")) and len(set(rows(kept, "id")) - exact) <= 40
    few = BlockBloom.trained(words, "word", 2, 0.01)  # more words than declared lose no member
    assert exact <= set(rows(few.keep_any(docs, tokens, "id", max_bytes), "id"))
    nothing = BlockBloom.trained(words.where("false"), "word", 50, 0.01)
    assert nothing.keep_any(docs, tokens, "id", max_bytes).count() == 0


def test_repeated_and_null_values_stay_as_often_as_they_come(spark):
    values = spark.createDataFrame([("a",)] * 5 + [("b",), (None,), ("",)], "v string")
    known = BlockBloom.trained(spark.createDataFrame([("a",), ("",), (None,)], "v string"), "v", 10, 1e-6)
    for max_bytes in (64 << 20, 0):
        assert rows(known.keep(values, "v", max_bytes)) == [("",)] + [("a",)] * 5


@pytest.mark.parametrize("max_bytes", [64 << 20, 0])
def test_a_token_is_hashed_once(spark, max_bytes):
    docs, words, tokens = docs_and_words(spark)
    known = BlockBloom.trained(words, "word", 50, 0.01)
    kept = known.keep(docs.select("id", F.explode(tokens).alias("token")), "token", max_bytes)
    kept = kept._jdf.queryExecution().optimizedPlan().toString()
    assert kept.count("md5(") == 1 and kept.count("conv(") == 2  # a block and the bits in it


def test_merged_saved_and_loaded(spark):
    half = lambda i: spark.range(300).where(f"id % 2 = {i}").selectExpr("CAST(id AS string) AS v")
    path = fresh_dir(spark, "saved")
    BlockBloom.trained(half(0), "v", 300, 0.001).merged(BlockBloom.trained(half(1), "v", 300, 0.001)).save(path)
    loaded = BlockBloom.load(spark, path)
    whole = BlockBloom.trained(spark.range(300).selectExpr("CAST(id AS string) AS v"), "v", 300, 0.001)
    assert rows(loaded.table) == rows(whole.table) and loaded.blocks == whole.blocks
    with pytest.raises(ValueError):
        loaded.merged(BlockBloom.trained(half(0), "v", 3000, 0.001))
    empty = fresh_dir(spark, "saved")
    BlockBloom.trained(half(5), "v", 300, 0.001).save(empty)
    assert BlockBloom.load(spark, empty).keep(half(0), "v").count() == 0


def shuffled_rows(df):
    """Rows each shuffle of a finished query has written, largest first."""
    df.collect()
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        else:
            if name == "ShuffleExchangeExec":
                found.append(node.metrics().apply("shuffleRecordsWritten").value())
            todo += [node.children().apply(i) for i in range(node.children().size())]
    return sorted(found, reverse=True)


def test_the_big_side_is_cut_before_the_shuffle(spark):
    big = spark.range(20_000).selectExpr("id AS n", "IF(id % 3 = 0, 7, id) AS k", "IF(id % 50 = 0, NULL, 'x') AS part")
    small = spark.range(0, 20_000, 200).selectExpr("id AS k", "'x' AS part", "id * 2 AS twice").unionByName(
        spark.createDataFrame([(7, "x", 1), (None, "x", 2)], "k long, part string, twice long")
    )
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plain = big.where("k <> 7").join(small, ["k", "part"])
        cut = bloom.joined_through_filter(big.where("k <> 7"), small, ["k", "part"], 200)
        wanted = rows(plain)
        assert rows(cut) == wanted
        assert shuffled_rows(plain)[0] > 13_000 and shuffled_rows(cut)[0] < 600
        assert rows(bloom.joined_through_filter(big, small, ["k", "part"], 200)) == rows(big.join(small, ["k", "part"]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
