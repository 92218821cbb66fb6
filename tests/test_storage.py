import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from clickweave.sinks import writers
from clickweave.sources import readers
from clickweave.workspace import fresh_dir, scope, shared_root, stored
from conftest import plan, rows


def test_save_modes(spark):
    path, df = fresh_dir(spark, "modes"), spark.range(3)
    writers.save(df, path)
    with pytest.raises(AnalysisException):
        writers.save(df, path)
    writers.save(df, path, mode="ignore")
    assert spark.read.parquet(path).count() == 3
    writers.save(df, path, mode="append")
    assert spark.read.parquet(path).count() == 6
    writers.save(df, path, mode="overwrite")
    assert spark.read.parquet(path).count() == 3


def test_xml_rows_escape_and_miss(spark):
    df = spark.createDataFrame([(1, 'a & "b" <c>'), (2, None)], "id int, t string")
    lines = df.select(readers.xml_row({"Id": F.col("id"), "Text": F.col("t")}).alias("line"))
    assert rows(lines)[1][0] == '<row Id="2" />'
    got = readers.xml_rows(lines, "line", {"Id": "int", "Text": "string", "Score": "int"})
    assert rows(got) == [(1, 'a & "b" <c>', None), (2, None, None)]


def test_batch_log(spark):
    log = writers.BatchLog(spark, fresh_dir(spark, "log"), "k string, n long", ["k"])
    assert log.latest().count() == 0 and log.totals().count() == 0
    first = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n long")
    second = spark.createDataFrame([("b", 10)], "k string, n long")
    log.write(first, 0)
    for _ in range(2):  # a retried batch counts once
        log.write(second, 1)
    assert rows(log.totals()) == [("a", 1), ("b", 12)]
    assert rows(log.latest()) == [("a", 1), ("b", 10)]
    assert rows(log.before(1), "k", "n") == [("a", 1), ("b", 2)]
    assert "batches/0" in plan(log.before(1)) and "batches/1" not in plan(log.before(1))


def test_replace_only_touched_partitions(spark):
    path = fresh_dir(spark, "replace")
    rows_of = lambda data: spark.createDataFrame(data, "n long, d string, p string")
    writers.replace_partitions(rows_of([(1, "d1", "p1"), (2, "d1", "p2"), (3, "d2", "p1")]), path, ["d", "p"])
    writers.replace_partitions(rows_of([(9, "d1", "p1")]), path, ["d", "p"])
    assert rows(spark.read.parquet(path), "n", "d", "p") == [(2, "d1", "p2"), (3, "d2", "p1"), (9, "d1", "p1")]


def test_sharded_store_reads_one_shard(spark):
    path = fresh_dir(spark, "shards")
    pairs = spark.range(200).select(F.col("id").cast("string").alias("key"), (F.col("id") * 2).alias("value"))
    writers.save_sharded(pairs, path, 5)
    found = readers.sharded(spark, path, 5, F.lit("17"))
    assert rows(found, "key", "value") == [("17", 34)]
    assert "PartitionFilters: [isnotnull(shard" in plan(found)
    assert readers.sharded(spark, path, 5).count() == 200


def test_months_are_pruned(spark):
    path = fresh_dir(spark, "months")
    days = spark.range(120).select("id", F.expr("date'2024-01-01' + CAST(id AS INT)").alias("d"))
    writers.save_by_month(days, "d", path)
    chosen = readers.months(spark, path, ["2024-02"])
    assert chosen.count() == 29 and "PartitionFilters: [month" in plan(chosen).replace("isnotnull(month#", "month#")


def test_jdbc_reads_in_ranges():
    got = readers.jdbc_options("jdbc:x:y", "t", ("id", 0, 100, 8), driver="d")
    assert got == {
        "url": "jdbc:x:y", "dbtable": "t", "driver": "d", "partitionColumn": "id", "lowerBound": "0", "upperBound": "100", "numPartitions": "8",
    }
    assert readers.jdbc_options("u", "t") == {"url": "u", "dbtable": "t"}


def test_good_students(spark):
    students = spark.createDataFrame([("leo", 18), ("tom", 19)], "name string, age int")
    scores = spark.createDataFrame([("leo", 88), ("tom", 80), ("ann", 99)], "name string, score int")
    assert rows(readers.good_students(students, scores, 80), "name", "age", "score") == [("leo", 18, 88)]


def test_json_without_and_with_schema(spark):
    path = fresh_dir(spark, "json")
    writers.save(spark.createDataFrame([("leo", 1)], "name string, n long"), path, "json")
    assert readers.json_table(spark, path).schema.simpleString() == "struct<n:bigint,name:string>"
    assert readers.json_table(spark, path, "name string").columns == ["name"]


def test_bad_json_strings_give_null(spark):
    df = spark.createDataFrame([(1, '{"k": 3}'), (2, "bad")], "id int, j string")
    assert rows(readers.json_strings(df, "j", "k int")) == [(1, 3), (2, None)]


class _Unset:
    class conf:
        @staticmethod
        def get(name, default=None):
            return "hdfs://shared/warehouse/" if name == "spark.sql.warehouse.dir" else default


def test_intermediate_tables_go_to_a_shared_folder(spark):
    assert shared_root(_Unset) == "hdfs://shared/warehouse"
    assert fresh_dir(spark, "x").startswith(shared_root(spark))


def test_a_scope_leaves_nothing_behind(spark):
    def there():
        root = f"{shared_root(spark)}/clickweave"
        folders = set(os.listdir(root)) if os.path.isdir(root) else set()
        return folders, {t.name for t in spark.catalog.listTables()}

    before = there()
    with scope(spark):
        name, path = writers.new_table(spark, "scoped")
        writers.append_table(spark.range(3), name, path)
        kept = stored(spark.table(name), "scoped")
        assert kept.count() == 3 and there() != before
    assert there() == before
