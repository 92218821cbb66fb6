"""Business tables derived from the given tables, once as DataFrames and once as SQL.

=============  ==========================================================================
actions        one row per event: search, click, order or pay action of a user session
users          customers with age, profession, city, sex and reputation
cities         nations with their region as area
products       parts with a JSON ``extend_info``
ad_clicks      click events with province, city, user and ad
employees      suppliers with salary, deductions and address
stocks         closing price per day and symbol, from orders
dividends      dividend per day and symbol, from finished orders
=============  ==========================================================================
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


# Columns of the given tables. Stated, no job has to open files to find them.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
    "o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "pages": "page_id long, url string, html string",
    "benchmark": "item_id long, text string",
    "conversations": "conv_id long, turn long, role string, text string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")


def ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def action_columns(events: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    day = F.date_format("ts", "yyyy-MM-dd")
    pair = F.concat_ws(",", k, F.pmod(k + 7, F.lit(100)))
    kind = F.col("event_type")
    return events.select(
        "event_id",
        day.alias("date"),
        "user_id",
        F.concat_ws("_", "user_id", day).alias("session_id"),
        F.pmod(k, F.lit(10)).cast("long").alias("page_id"),
        F.col("ts").alias("action_time"),
        F.when(kind == "view", F.concat(F.lit("kw"), F.pmod(k, F.lit(10)))).alias("search_keyword"),
        F.when(kind == "click", k.cast("long")).alias("click_category_id"),
        F.when(kind == "click", F.col("event_id") % 100).alias("click_product_id"),
        F.when(kind == "signup", pair).alias("order_category_ids"),
        F.when(kind == "purchase", pair).alias("pay_category_ids"),
        (F.col("user_id") % 25).alias("city_id"),
    )


def actions(
    spark: SparkSession, folder: str, first: str | None = None, last: str | None = None, kind: str | None = None
) -> DataFrame:
    """Actions, between two days (both included) or of one kind if given; both reach the scan."""
    events = table(spark, folder, "events")
    if kind is not None:
        events = events.where(F.col("event_type") == kind)
    if first is not None:
        events = events.where(F.col("ts") >= ntz(first))
    if last is not None:
        events = events.where(F.col("ts") < ntz(last) + F.expr("INTERVAL 1 DAY"))
    return action_columns(events)


def cities(spark: SparkSession, folder: str) -> DataFrame:
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").cast("long").alias("city_id"),
        F.col("n_name").alias("city_name"),
        F.col("r_name").alias("area"),
    )


def users(spark: SparkSession, folder: str) -> DataFrame:
    customer, nation = table(spark, folder, "customer"), table(spark, folder, "nation")
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_name").alias("username"),
        (F.col("c_custkey") % 50 + 18).cast("int").alias("age"),
        F.col("c_mktsegment").alias("professional"),
        F.col("n_name").alias("city"),
        F.when(F.col("c_custkey") % 2 == 0, "male").otherwise("female").alias("sex"),
        F.col("c_acctbal").alias("reputation"),
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.format_string('{"product_status": %d}', F.col("p_partkey") % 2).alias("extend_info"),
    )


def ad_click_columns(events: DataFrame, city: DataFrame) -> DataFrame:
    clicks = events.where(F.col("event_type") == "click").select(
        "event_id",
        "ts",
        "user_id",
        (F.get_json_object("props", "$.k").cast("int") % 10).alias("ad_id"),
        (F.col("user_id") % 25).alias("city_id"),
    )
    return clicks.join(city, "city_id").select(
        "event_id", "ts", F.col("area").alias("province"), F.col("city_name").alias("city"), "user_id", "ad_id"
    )


def ad_clicks(spark: SparkSession, folder: str) -> DataFrame:
    return ad_click_columns(table(spark, folder, "events"), cities(spark, folder))


def employees(spark: SparkSession, folder: str) -> DataFrame:
    supplier, nation = table(spark, folder, "supplier"), table(spark, folder, "nation")
    federal = F.when(F.col("s_suppkey") % 3 == 0, 0.3).otherwise(0.2).cast("float")
    return supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).select(
        F.col("s_suppkey").alias("employee_id"),
        F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("salary"),
        F.create_map(
            F.lit("income"), federal, F.lit("pension"), F.lit(0.05).cast("float")
        ).alias("deductions"),
        F.struct(
            F.concat(
                F.col("s_suppkey").cast("string"), F.when(F.col("s_suppkey") % 2 == 0, " Harbour Lane").otherwise(" Miller Road")
            ).alias("street"),
            F.col("n_name").alias("city"),
            F.substring("n_name", 1, 2).alias("state"),
            F.lit(60000).alias("zip"),
        ).alias("address"),
    )


def stocks(spark: SparkSession, folder: str) -> DataFrame:
    """One closing price per day and symbol; every symbol is listed at one exchange."""
    symbol = F.col("o_orderpriority")
    return (
        table(spark, folder, "orders")
        .groupBy(F.to_date("o_orderdate").alias("ymd"), symbol.alias("symbol"))
        .agg(
            F.max_by("o_totalprice", "o_orderkey").alias("price_close"),
            F.max("o_totalprice").alias("price_high"),
        )
        .withColumn("exchange", F.when(F.substring("symbol", 1, 1).isin("1", "3", "5"), "NASDAQ").otherwise("NYSE"))
    )


def dividends(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "orders")
        .where(F.col("o_orderstatus") == "F")
        .groupBy(F.to_date("o_orderdate").alias("ymd"), F.col("o_orderpriority").alias("symbol"))
        .agg(F.round(F.sum("o_totalprice"), 2).alias("dividend"))
    )


_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"

SQL = {
    "actions": f"""
        SELECT event_id, strftime(ts, '%Y-%m-%d') AS date, user_id,
               user_id || '_' || strftime(ts, '%Y-%m-%d') AS session_id,
               CAST(k % 10 AS BIGINT) AS page_id, ts AS action_time,
               CASE WHEN event_type = 'view' THEN 'kw' || (k % 10) END AS search_keyword,
               CASE WHEN event_type = 'click' THEN CAST(k AS BIGINT) END AS click_category_id,
               CASE WHEN event_type = 'click' THEN event_id % 100 END AS click_product_id,
               CASE WHEN event_type = 'signup' THEN k || ',' || ((k + 7) % 100) END AS order_category_ids,
               CASE WHEN event_type = 'purchase' THEN k || ',' || ((k + 7) % 100) END AS pay_category_ids,
               user_id % 25 AS city_id
        FROM (SELECT *, {_K} AS k FROM events)""",
    "cities": """
        SELECT CAST(n_nationkey AS BIGINT) AS city_id, n_name AS city_name, r_name AS area
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "users": """
        SELECT c_custkey AS user_id, c_name AS username, CAST(18 + c_custkey % 50 AS INTEGER) AS age,
               c_mktsegment AS professional, n_name AS city,
               CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex, c_acctbal AS reputation
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "products": """
        SELECT p_partkey AS product_id, p_name AS product_name,
               '{"product_status": ' || (p_partkey % 2) || '}' AS extend_info
        FROM part""",
    "ad_clicks": f"""
        SELECT event_id, ts, r_name AS province, n_name AS city, user_id, {_K} % 10 AS ad_id
        FROM events JOIN nation ON user_id % 25 = n_nationkey JOIN region ON n_regionkey = r_regionkey
        WHERE event_type = 'click'""",
    "employees": """
        SELECT s_suppkey AS employee_id, s_name AS name, s_acctbal AS salary,
               CAST(CASE WHEN s_suppkey % 3 = 0 THEN 0.3 ELSE 0.2 END AS FLOAT) AS federal_taxes,
               CAST(0.05 AS FLOAT) AS state_taxes,
               s_suppkey || CASE WHEN s_suppkey % 2 = 0 THEN ' Harbour Lane' ELSE ' Miller Road' END AS street,
               n_name AS city, substr(n_name, 1, 2) AS state
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "stocks": """
        SELECT CAST(o_orderdate AS DATE) AS ymd, o_orderpriority AS symbol,
               arg_max(o_totalprice, o_orderkey) AS price_close, max(o_totalprice) AS price_high,
               CASE WHEN substr(o_orderpriority, 1, 1) IN ('1', '3', '5') THEN 'NASDAQ' ELSE 'NYSE' END AS exchange
        FROM orders GROUP BY 1, 2""",
    "dividends": """
        SELECT CAST(o_orderdate AS DATE) AS ymd, o_orderpriority AS symbol,
               round(sum(o_totalprice), 2) AS dividend
        FROM orders WHERE o_orderstatus = 'F' GROUP BY ALL""",
}


def sql(*names: str, extra: str = "") -> str:
    """``WITH`` clause for the named views; ``extra`` adds further ones."""
    parts = [f"{name} AS ({SQL[name]})" for name in names]
    if extra:
        parts.append(extra.strip().rstrip(","))
    return "WITH " + ", ".join(parts) + " "
