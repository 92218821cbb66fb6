"""Round trips through every source and sink."""

from dataclasses import dataclass

from pyspark.sql import functions as F

from clickweave.plans import views
from clickweave.plans.registry import query
from clickweave.plans.views import table
from clickweave.sinks import writers
from clickweave.sources import readers, sharded
from clickweave.workspace import fresh_dir, stored


@query(
    "src_text_total_chars",
    "SELECT CAST(sum(length(replace(text, chr(10), ''))) AS BIGINT) AS chars, count(*) AS docs FROM documents",
)
def src_text_total_chars(spark, folder):
    documents = table(spark, folder, "documents").select("text")
    path = fresh_dir(spark, "text")
    writers.save_text(documents, path)
    docs = documents.agg(F.count("*")).scalar()
    return readers.text_lines(spark, path).agg(F.sum(F.length("value")).alias("chars")).withColumn("docs", docs)


WEIGHTS = [("1-URGENT", 5), ("2-HIGH", 4), ("3-MEDIUM", 3), ("4-NOT SPECIFIED", 2), ("5-LOW", 1)]


@query(
    "src_collection_sum",
    f"""WITH w(priority, weight) AS (VALUES {', '.join(f"('{p}', {w})" for p, w in WEIGHTS)})
    SELECT CAST(sum(weight) AS BIGINT) AS weight, count(*) AS n FROM orders JOIN w ON o_orderpriority = priority""",
)
def src_collection_sum(spark, folder):
    weights = readers.collection(spark, WEIGHTS, "priority string, weight long", 2)
    orders = table(spark, folder, "orders").groupBy(F.col("o_orderpriority").alias("priority")).agg(F.count("*").alias("n"))
    return orders.join(weights, "priority").agg(F.sum(F.col("n") * F.col("weight")).alias("weight"), F.sum("n").alias("n"))


@query("src_json_roundtrip", "SELECT c_custkey, c_name, c_acctbal, CAST(c_nationkey AS BIGINT) AS c_nationkey FROM customer")
def src_json_roundtrip(spark, folder):
    path = fresh_dir(spark, "json")
    writers.save(table(spark, folder, "customer"), path, "json")
    return readers.json_table(spark, path).select("c_custkey", "c_name", "c_acctbal", "c_nationkey")


@query("src_json_strings", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def src_json_strings(spark, folder):
    return readers.json_strings(table(spark, folder, "events").select("event_id", "props"), "props", "k int")


@query("src_parquet_sql", "SELECT c_name, c_acctbal >= 5000 AS rich FROM customer")
def src_parquet_sql(spark, folder):
    return spark.sql("SELECT c_name, c_acctbal >= 5000 AS rich FROM {file}", file=table(spark, folder, "customer"))


@query("src_generic_load_save", "SELECT s_name, s_nationkey FROM supplier")
def src_generic_load_save(spark, folder):
    first, second = fresh_dir(spark, "default"), fresh_dir(spark, "orc")
    spark.read.load(f"{folder}/supplier.parquet").select("s_name", "s_nationkey").write.save(first)
    writers.save(spark.read.format("parquet").load(first), second, "orc")
    return spark.read.format("orc").load(second)


@query(
    "src_partition_discovery",
    "SELECT c_mktsegment, count(*) AS n, round(sum(c_acctbal), 2) AS balance FROM customer GROUP BY 1",
)
def src_partition_discovery(spark, folder):
    path = fresh_dir(spark, "segments")
    table(spark, folder, "customer").write.partitionBy("c_mktsegment").parquet(path)
    found = spark.read.parquet(path)
    return found.groupBy("c_mktsegment").agg(F.count("*").alias("n"), F.round(F.sum("c_acctbal"), 2).alias("balance"))


@query(
    "src_merge_schema",
    """SELECT p_partkey, p_name, p_size FROM (SELECT p_partkey, p_name FROM part
       UNION ALL BY NAME SELECT p_partkey + 1000000 AS p_partkey, p_size FROM part)""",
)
def src_merge_schema(spark, folder):
    part, path = table(spark, folder, "part"), fresh_dir(spark, "merge")
    writers.save(part.select("p_partkey", "p_name"), path, mode="append")
    writers.save(part.select((F.col("p_partkey") + 1000000).alias("p_partkey"), "p_size"), path, mode="append")
    return readers.merged_schema(spark, path).select("p_partkey", "p_name", "p_size")


@query(
    "join_scores_filter",
    """SELECT c_name AS name, c_nationkey AS age, o_orderkey % 100 AS score FROM customer JOIN orders ON c_custkey = o_custkey
       WHERE o_orderkey % 100 > 80""",
)
def join_scores_filter(spark, folder):
    students = table(spark, folder, "customer").select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("age"))
    name = F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")).alias("name")
    scores = table(spark, folder, "orders").select(name, (F.col("o_orderkey") % 100).alias("score"))
    return readers.good_students(students, scores, 80)


@query("src_catalog_table", "SELECT s_name, s_acctbal, s_nationkey FROM supplier WHERE s_nationkey >= 5")
def src_catalog_table(spark, folder):
    name, path = writers.new_table(spark, "suppliers")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} (s_name STRING, s_acctbal DOUBLE, s_nationkey INT) "
        f"USING parquet PARTITIONED BY (s_nationkey) LOCATION '{path}'"
    )
    rows = table(spark, folder, "supplier").select("s_name", "s_acctbal", "s_nationkey")
    spark.sql(f"INSERT INTO {name} SELECT * FROM {{rows}}", rows=rows)
    return spark.table(name).where("s_nationkey >= 5")


@query("src_csv_schema_filter", "SELECT c_custkey AS id, c_name AS name, c_nationkey AS age FROM customer WHERE c_nationkey > 18")
def src_csv_schema_filter(spark, folder):
    path = fresh_dir(spark, "csv")
    writers.save(table(spark, folder, "customer").select("c_custkey", "c_name", "c_nationkey"), path, "csv")
    return readers.delimited(spark, path, "id long, name string, age int").where("age > 18")


@dataclass
class Student:
    id: int
    name: str
    balance: float


@query("src_typed_rows", "SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer WHERE c_acctbal > 100")
def src_typed_rows(spark, folder):
    customers = table(spark, folder, "customer").toDF(*["id", "name", "nation", "balance", "segment"])
    return readers.typed(customers, Student).where(F.col("balance") > 100)


@query(
    "src_xml_rows",
    """SELECT c_custkey AS "Id", c_name || ' & "Co" <' || c_mktsegment || '>' AS "Name",
              CASE WHEN c_nationkey > 3 THEN c_acctbal END AS "Reputation" FROM customer""",
)
def src_xml_rows(spark, folder):
    name = F.concat(F.col("c_name"), F.lit(' & "Co" <'), F.col("c_mktsegment"), F.lit(">"))
    reputation = F.when(F.col("c_nationkey") > 3, F.col("c_acctbal"))
    row = readers.xml_row({"Id": F.col("c_custkey"), "Name": name, "Reputation": reputation})
    path = fresh_dir(spark, "xml")
    writers.save_text(table(spark, folder, "customer").select(row.alias("value")), path)
    return readers.xml_rows(readers.text_lines(spark, path), "value", {"Id": "long", "Name": "string", "Reputation": "double"})


@query(
    "src_xml_dump",
    """SELECT CASE WHEN c_custkey % 50 > 0 THEN c_custkey END AS "Id", CASE WHEN c_custkey % 50 > 0 THEN c_name || ' & Co' END AS "Name",
              CASE WHEN c_custkey % 50 = 0 THEN c_custkey END AS broken_id FROM customer""",
)
def src_xml_dump(spark, folder):
    """A dump in which every 50th row has a bare ampersand and so is no XML."""
    name = F.concat(F.col("c_name"), F.lit(" & Co"))
    sound = readers.xml_row({"Id": F.col("c_custkey"), "Name": name})
    row = F.when(F.col("c_custkey") % 50 == 0, F.replace(sound, F.lit("&amp;"), F.lit("&"))).otherwise(sound)
    path = fresh_dir(spark, "dump")
    writers.save_text(table(spark, folder, "customer").select(row.alias("value")), path)
    rows = readers.xml_files(spark, path, {"Id": "long", "Name": "string"})
    id_of = F.regexp_extract("_broken", 'Id="([0-9]+)"', 1).cast("long")
    return rows.select("Id", "Name", id_of.alias("broken_id"))


@query(
    "src_json_variant",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CAST(NULL AS VARCHAR) AS other,
              CAST(json(props) AS VARCHAR) AS props FROM events""",
)
def src_json_variant(spark, folder):
    events = readers.json_variant(table(spark, folder, "events").select("event_id", "props"), "props")
    found = readers.variant_fields(events, "props", {"k": ("$.k", "int"), "other": ("$.other", "string")})
    return found.withColumn("props", F.to_json("props"))


@query(
    "src_json_variant_schema",
    """SELECT event_type, 'OBJECT<' || string_agg(DISTINCT name || ': BIGINT', ', ' ORDER BY name || ': BIGINT') || '>' AS fields
       FROM (SELECT event_type, unnest(json_keys(props)) AS name FROM events) GROUP BY 1""",
)
def src_json_variant_schema(spark, folder):
    events = readers.json_variant(table(spark, folder, "events").select("event_type", "props"), "props")
    return readers.variant_schema(events, "props", "event_type")


SHARDS = 6


@query("sink_sharded_kv", "SELECT CAST(c_custkey AS VARCHAR) AS key, c_name AS value FROM customer")
def sink_sharded_kv(spark, folder):
    return readers.sharded(spark, _sharded(spark, folder), SHARDS).select("key", "value")


def _sharded(spark, folder):
    path = fresh_dir(spark, "shards")
    pairs = table(spark, folder, "customer").select(F.col("c_custkey").cast("string").alias("key"), F.col("c_name").alias("value"))
    writers.save_sharded(pairs, path, SHARDS)
    return path


@query("src_sharded_kv", "SELECT CAST(c_custkey AS VARCHAR) AS key, c_name AS value FROM customer WHERE c_custkey = 77")
def src_sharded_kv(spark, folder):
    return readers.sharded(spark, _sharded(spark, folder), SHARDS, F.lit("77")).select("key", "value")


def _order_store(spark, folder):
    path = fresh_dir(spark, "order-store")
    orders = table(spark, folder, "orders")
    sharded.save(orders.select(F.col("o_orderkey").alias("key"), F.col("o_orderpriority").alias("value")), path, SHARDS)
    return path


@query(
    "sink_shard_source",
    """SELECT CAST(o_orderkey AS VARCHAR) AS key, o_orderpriority AS value FROM orders
       UNION ALL SELECT CAST(c_custkey AS VARCHAR), c_mktsegment FROM customer""",
)
def sink_shard_source(spark, folder):
    path = _order_store(spark, folder)
    more = table(spark, folder, "customer").select(F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("value"))
    sharded.save(more, path, SHARDS)
    return sharded.load(spark, path, SHARDS).select("key", "value")


@query(
    "src_shard_source",
    "SELECT CAST(o_orderkey AS VARCHAR) AS key, o_orderpriority AS value FROM orders WHERE o_orderkey IN (7, 77, 777)",
)
def src_shard_source(spark, folder):
    return sharded.load(spark, _order_store(spark, folder), SHARDS, ["7", "77", "777"]).select("key", "value")


@query(
    "src_month_dynamic",
    """WITH months AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n,
                              count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS urgent FROM orders GROUP BY 1)
    SELECT month, o_orderkey, n, urgent FROM orders JOIN months ON strftime(o_orderdate, '%Y-%m') = month WHERE urgent * 4 > n""",
)
def src_month_dynamic(spark, folder):
    """Orders of the months in which more than a quarter were urgent; only the folders of those are read."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    path = fresh_dir(spark, "months")
    writers.save_by_month(orders, "o_orderdate", path)
    month = F.date_format("o_orderdate", "yyyy-MM").alias("month")
    counts = orders.groupBy(month).agg(F.count("*").alias("n"), F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("urgent"))
    chosen = stored(counts, "calendar").where(F.col("urgent") * 4 > F.col("n"))
    return readers.months_of(spark, path, chosen, "o_orderkey long").select("month", "o_orderkey", "n", "urgent")


@query(
    "src_month_pruned",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS month FROM orders WHERE strftime(o_orderdate, '%Y-%m') IN ('1996-03', '1998-11')""",
)
def src_month_pruned(spark, folder):
    path = fresh_dir(spark, "months")
    writers.save_by_month(table(spark, folder, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate", path)
    return readers.months(spark, path, ["1996-03", "1998-11"]).select("o_orderkey", "month")


@query(
    "src_tagged_union",
    """SELECT 'user' AS origin, c_custkey AS id, c_name AS name, NULL AS price FROM customer
       UNION ALL SELECT 'order', o_orderkey, NULL, o_totalprice FROM orders""",
)
def src_tagged_union(spark, folder):
    users = table(spark, folder, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price"))
    return readers.tagged({"user": users, "order": orders})


@query("sink_append_twice", "SELECT s_suppkey, 2 * count(*) AS copies FROM supplier GROUP BY 1")
def sink_append_twice(spark, folder):
    path = fresh_dir(spark, "append")
    for _ in range(2):
        writers.save(table(spark, folder, "supplier"), path, mode="append")
    return spark.read.parquet(path).groupBy("s_suppkey").agg(F.count("*").alias("copies"))


@query("sink_text", "SELECT s_suppkey || ' ' || s_name AS value FROM supplier")
def sink_text(spark, folder):
    path = fresh_dir(spark, "lines")
    writers.save_text(table(spark, folder, "supplier").select(F.concat_ws(" ", "s_suppkey", "s_name").alias("value")), path)
    return readers.text_lines(spark, path)


@query(
    "sink_table_append",
    "SELECT c_custkey AS user_id FROM customer WHERE c_acctbal < 0 UNION ALL SELECT c_custkey FROM customer WHERE c_acctbal >= 0",
)
def sink_table_append(spark, folder):
    name, path = writers.new_table(spark, "blacklist")
    customers = table(spark, folder, "customer")
    for condition in ("c_acctbal < 0", "c_acctbal >= 0"):
        writers.append_table(customers.where(condition).select(F.col("c_custkey").alias("user_id")), name, path)
    return spark.table(name)


_CLICKS = "date, province, city, ad_id"


def _clicks(spark, folder):
    return views.ad_clicks(spark, folder).withColumn("date", F.date_format("ts", "yyyy-MM-dd"))


def _stat(clicks):
    return clicks.groupBy("date", "province", "city", "ad_id").agg(F.count("*").alias("clicks"))


_AD_STAT = "date string, province string, city string, ad_id int, clicks long"
_AD_KEYS = ["date", "province", "city", "ad_id"]


@query(
    "sink_upsert_set",
    views.sql("ad_clicks") + "SELECT strftime(ts, '%Y-%m-%d') AS date, province, city, ad_id, count(*) AS clicks FROM ad_clicks GROUP BY ALL",
)
def sink_upsert_set(spark, folder):
    log = writers.BatchLog(spark, fresh_dir(spark, "ad-stat"), _AD_STAT, _AD_KEYS)
    clicks = _clicks(spark, folder)
    noon = views.ntz("2024-01-15 12:00:00")
    log.write(_stat(clicks.where(F.col("ts") < noon)), 0)
    log.write(_stat(clicks.where(F.col("ts") >= views.ntz("2024-01-15"))), 1)
    return log.latest()


@query(
    "sink_upsert_add",
    views.sql("ad_clicks") + "SELECT strftime(ts, '%Y-%m-%d') AS date, user_id, ad_id, count(*) AS clicks FROM ad_clicks GROUP BY ALL",
)
def sink_upsert_add(spark, folder):
    keys = ["date", "user_id", "ad_id"]
    log = writers.BatchLog(spark, fresh_dir(spark, "ad-user"), "date string, user_id long, ad_id int, clicks long", keys)
    clicks = _clicks(spark, folder)
    noon = views.ntz("2024-01-15 12:00:00")
    parts = [clicks.where(F.col("ts") < noon), clicks.where(F.col("ts") >= noon)]
    for batch_id in (0, 1, 1):  # the second batch is tried twice
        log.write(parts[batch_id].groupBy(*keys).agg(F.count("*").alias("clicks")), batch_id)
    return log.totals()


@query(
    "sink_replace_partitions",
    views.sql("ad_clicks") + """SELECT strftime(ts, '%Y-%m-%d') AS date, province, ad_id,
    CASE WHEN ts >= TIMESTAMP '2024-01-15' THEN 2 ELSE 1 END * count(*) AS clicks FROM ad_clicks
    GROUP BY date, province, ad_id, ts >= TIMESTAMP '2024-01-15'""",
)
def sink_replace_partitions(spark, folder):
    counts = _clicks(spark, folder).groupBy("date", "province", "ad_id").agg(F.count("*").alias("clicks"))
    path = fresh_dir(spark, "province-top")
    writers.replace_partitions(counts, path, ["date", "province"])
    doubled = counts.where("date >= '2024-01-15'").withColumn("clicks", F.col("clicks") * 2)
    writers.replace_partitions(doubled, path, ["date", "province"])
    return spark.read.schema(counts.schema).parquet(path)
