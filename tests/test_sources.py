"""Sharded store as a data source, months chosen while a query runs, XML dumps, JSON without a schema."""

import os

import pytest
from pyspark.sql import functions as F

from clickweave.sinks import writers
from clickweave.sources import readers, sharded
from clickweave.workspace import fresh_dir
from conftest import final_plan, rows


def pairs_of(spark, n):
    return spark.range(n).select(F.col("id").cast("string").alias("key"), (F.col("id") * 2).cast("string").alias("value"))


def files_of(path):
    return sorted(f for _, _, names in os.walk(path) for f in names)


@pytest.fixture(scope="module")
def store(spark):
    path = fresh_dir(spark, "store")
    sharded.save(pairs_of(spark, 500), path, 5)
    return path


def test_one_partition_per_shard(spark, store):
    whole = sharded.load(spark, store, 5)
    assert whole.rdd.getNumPartitions() == 5
    assert rows(whole, "key", "value") == rows(pairs_of(spark, 500))
    assert {s for (s,) in rows(whole, "shard")} == set(range(5))
    assert whole.where(F.col("shard") != sharded.shard_column("key", 5)).count() == 0


def test_python_and_spark_agree_on_shards(spark):
    keys = ["", "a", "ü", "漢字", "\U0001f600", "x" * 10_000, None]
    df = spark.createDataFrame([(k,) for k in keys], "key string")
    got = {r["key"]: r["s"] for r in df.select("key", sharded.shard_column("key", 7).alias("s")).collect()}
    assert got == {k: sharded.shard_of(k, 7) for k in keys}


def test_keys_open_only_their_shards(spark, store):
    found = sharded.load(spark, store, 5, ["17"])
    assert found.rdd.getNumPartitions() == 1 and rows(found, "key", "value") == [("17", "34")]
    keys = ["17", "18", "none"]
    some = sharded.load(spark, store, 5, keys)
    assert some.rdd.getNumPartitions() == len({sharded.shard_of(k, 5) for k in keys})
    assert rows(some, "key", "value") == [("17", "34"), ("18", "36")]
    assert sharded.load(spark, store, 5, []).count() == 0


def test_where_is_pushed_down(spark, store):
    spark.conf.set(sharded.PUSHDOWN, "true")
    try:
        one = sharded.load(spark, store, 5).where("key = '17'")
        assert one.rdd.getNumPartitions() == 1 and rows(one, "key", "value") == [("17", "34")]
        some = sharded.load(spark, store, 5).where("key in ('17', '18') and value > '34'")
        assert rows(some, "key", "value") == [("18", "36")]
        assert sharded.load(spark, store, 5).where("key = '17' and key = '18'").count() == 0
        assert sharded.load(spark, store, 5, ["17"]).where("key in ('17', '18')").count() == 1
        assert sharded.load(spark, store, 5).where("key is null").count() == 0
    finally:
        spark.conf.unset(sharded.PUSHDOWN)


def test_a_hot_shard_is_read_by_several_tasks(spark):
    path = fresh_dir(spark, "hot")
    hot = spark.range(40_000).select(F.lit("hot").alias("key"), F.col("id").cast("string").alias("value"))
    sharded.save(hot.coalesce(1), path, 4, file_rows=10_000)
    read = sharded.load(spark, path, 4, ["hot"], partition_bytes=1)
    assert read.rdd.getNumPartitions() > 1
    assert read.count() == read.select("value").distinct().count() == 40_000


def test_nulls_repeats_and_empty_tables(spark):
    path = fresh_dir(spark, "odd")
    data = [(None, "1"), ("a", None), ("a", None), ("", "")]
    sharded.save(spark.createDataFrame(data, "key string, value string"), path, 3)
    assert rows(sharded.load(spark, path, 3), "key", "value") == sorted(data, key=repr)
    sharded.save(spark.createDataFrame([], "key string, value string"), path, 3)
    assert sharded.load(spark, path, 3).count() == 4
    empty = fresh_dir(spark, "nothing")
    sharded.save(spark.createDataFrame([], "key string, value string"), empty, 3)
    assert sharded.load(spark, empty, 3).count() == 0


def test_append_and_overwrite(spark):
    path = fresh_dir(spark, "modes")
    for _ in range(2):
        sharded.save(pairs_of(spark, 20), path, 3)
    assert sharded.load(spark, path, 3).count() == 40
    sharded.save(pairs_of(spark, 5), path, 3, mode="overwrite")
    assert rows(sharded.load(spark, path, 3), "key", "value") == rows(pairs_of(spark, 5))
    assert not [name for name in os.listdir(path) if name.startswith("_staging")]


def test_an_aborted_write_leaves_nothing(spark, store):
    before = files_of(store)
    stops = F.when(F.col("id") == 399, F.raise_error(F.lit("stop"))).otherwise(F.col("id").cast("string"))
    bad = spark.range(0, 400, 1, 4).select(F.col("id").cast("string").alias("key"), stops.alias("value"))
    spark.dataSource.register(sharded.ShardedStore)
    for mode in ("append", "overwrite"):
        with pytest.raises(Exception, match="stop"):
            bad.write.format(sharded.NAME).options(path=store, shards=5).mode(mode).save()
        assert files_of(store) == before and not [n for n in os.listdir(store) if n.startswith("_staging")]


def test_months_chosen_while_running_prune_folders(spark):
    path, calendar = fresh_dir(spark, "months"), fresh_dir(spark, "calendar")
    days = spark.range(120).select("id", F.expr("date'2024-01-01' + CAST(id AS INT)").alias("d"))
    writers.save_by_month(days, "d", path)
    months = [("2024-01", 5), ("2024-02", 9), ("2024-03", 1), ("2024-04", 2)]
    writers.save(spark.createDataFrame(months, "month string, score int"), calendar)
    # files of other months that are no Parquet would stop a read that opened them
    for name in os.listdir(f"{path}/month=2024-03"):
        if name.endswith(".parquet"):
            with open(f"{path}/month=2024-03/{name}", "wb") as file:
                file.write(b"no parquet")
    chosen = spark.read.parquet(calendar).where("score > 4")
    found = readers.months_of(spark, path, chosen, "id long")
    assert "dynamicpruning" in final_plan(found)
    assert rows(found, "id") == [(i,) for i in sorted(range(60), key=lambda i: repr((i,)))]


def test_xml_dump_of_several_files(spark):
    path = fresh_dir(spark, "xml")
    os.makedirs(path)
    head = '<?xml version="1.0" encoding="utf-8"?>\n<users>\n'
    files = {
        "a.xml": head + '  <row Id="1" Name="A &amp; B" />\n  <row Id="2" />\n</users>\n',
        "b.xml": head + '<row Id="3" Name="bare & sign" />\n<row Id="x" Name="no number" />\n<row Id="4" Name="" Extra="1" /></users>',
        "c.xml": head + "</users>",
    }
    for name, text in files.items():
        with open(f"{path}/{name}", "w") as file:
            file.write(text)
    got = readers.xml_files(spark, path, {"Id": "long", "Name": "string"})
    sound = rows(got.where("_broken is null"), "Id", "Name")
    assert sound == [(1, "A & B"), (2, None), (4, "")]
    broken = rows(got.where("_broken is not null"))
    assert broken == [(None, None, '<row Id="3" Name="bare & sign" />'), (None, None, '<row Id="x" Name="no number" />')]


def test_json_variant_keeps_what_no_schema_names(spark):
    data = [(1, '{"k": 3, "deep": {"list": [1, "two"]}}'), (2, "bad {"), (3, None), (4, '{"k": "word"}'), (5, "[1]")]
    parsed = readers.json_variant(spark.createDataFrame(data, "id int, props string"), "props")
    fields = {"k": ("$.k", "int"), "second": ("$.deep.list[1]", "string")}
    got = readers.variant_fields(parsed, "props", fields).withColumn("props", F.to_json("props"))
    assert rows(got) == [
        (1, '{"deep":{"list":[1,"two"]},"k":3}', 3, "two"), (2, None, None, None), (3, None, None, None),
        (4, '{"k":"word"}', None, None), (5, "[1]", None, None),
    ]


def test_schema_of_variants(spark):
    data = [("a", '{"x": 1}'), ("a", '{"y": "t"}'), ("b", '{"x": 1.5}'), ("b", "bad")]
    parsed = readers.json_variant(spark.createDataFrame(data, "key string, j string"), "j")
    assert dict(rows(readers.variant_schema(parsed, "j", "key"))) == {"a": "OBJECT<x: BIGINT, y: STRING>", "b": "OBJECT<x: DECIMAL(2,1)>"}
