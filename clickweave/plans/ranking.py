"""Sorts, ranks and top-N. Positions are part of the rows, so that the order itself is compared."""

from pyspark.sql import functions as F

from clickweave.operators import ordering
from clickweave.plans.registry import query
from clickweave.plans.views import table


@query(
    "row_number_rank",
    """SELECT o_orderpriority, o_orderkey, o_totalprice,
       row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders""",
)
def row_number_rank(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderpriority", "o_orderkey", "o_totalprice")
    return ordering.rank_in_group(orders, ["o_orderpriority"], [F.desc("o_totalprice"), F.asc("o_orderkey")])


@query(
    "top3_per_category",
    """WITH sales AS (SELECT p_type AS category, p_partkey AS product, round(sum(l_extendedprice), 2) AS revenue
                      FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)
    SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY category ORDER BY revenue DESC, product) AS INTEGER) AS rank
                   FROM sales) WHERE rank <= 3""",
)
def top3_per_category(spark, folder):
    revenue = (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_partkey").alias("product"))
        .agg(F.round(F.sum("l_extendedprice"), 2).alias("revenue"))
    )
    parts = table(spark, folder, "part").select(F.col("p_partkey").alias("product"), F.col("p_type").alias("category"))
    return ordering.top_per_group(revenue.join(parts, "product"), ["category"], [F.desc("revenue"), F.asc("product")], 3)


@query(
    "group_top3_list",
    """SELECT o_custkey, string_agg(o_totalprice, ',' ORDER BY o_totalprice DESC) AS prices FROM (
       SELECT o_custkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn
       FROM orders) WHERE rn <= 3 GROUP BY 1""",
)
def group_top3_list(spark, folder):
    best = ordering.top_values(table(spark, folder, "orders"), "o_custkey", "o_totalprice", 3, ["o_orderkey"])
    return best.select("o_custkey", F.array_join("values", ",").alias("prices"))


@query(
    "sort_by_key",
    "SELECT o_totalprice, o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS position FROM orders",
)
def sort_by_key(spark, folder):
    orders = table(spark, folder, "orders").select("o_totalprice", "o_orderkey")
    return ordering.with_position(orders, [F.desc("o_totalprice"), F.asc("o_orderkey")])


@query(
    "secondary_sort",
    "SELECT user_id, ts, event_id, row_number() OVER (ORDER BY user_id, ts DESC, event_id) AS position FROM events",
)
def secondary_sort(spark, folder):
    events = table(spark, folder, "events").select("user_id", "ts", "event_id")
    return ordering.with_position(events, [F.asc("user_id"), F.desc("ts"), F.asc("event_id")])


@query("top3_global", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 3")
def top3_global(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return ordering.top_rows(orders, [F.desc("o_totalprice"), F.asc("o_orderkey")], 3)


@query("top_ten", "SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 10")
def top_ten(spark, folder):
    users = table(spark, folder, "customer").select("c_custkey", "c_name", "c_acctbal")
    return ordering.top_rows(users, [F.desc("c_acctbal"), F.asc("c_custkey")], 10)


@query(
    "total_order_sort",
    """SELECT o_orderdate, o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS position FROM orders""",
)
def total_order_sort(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderdate", "o_orderkey")
    return ordering.with_position(orders, ["o_orderdate", "o_orderkey"])
