"""Join queries. The key of the orders is shifted, so customers and orders both have rows without a partner."""

from pyspark.sql import functions as F

from clickweave.operators import bloom, joins, skew
from clickweave.plans import views
from clickweave.plans.registry import query
from clickweave.plans.views import table

_SIDES = """WITH people AS (SELECT c_custkey AS user_id, c_name AS name, c_acctbal AS reputation FROM customer),
    deals AS (SELECT o_orderkey AS deal_id, o_custkey + 100 AS user_id, o_totalprice AS price FROM orders) """


def people(spark, folder):
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("reputation")
    )


def deals(spark, folder):
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("deal_id"), (F.col("o_custkey") + 100).alias("user_id"), F.col("o_totalprice").alias("price")
    )


def _both(spark, folder):
    return people(spark, folder), deals(spark, folder), ["user_id"]


_COLUMNS = "user_id, name, reputation, deal_id, price"


@query("join_inner", _SIDES + f"SELECT {_COLUMNS} FROM people JOIN deals USING (user_id)")
def join_inner(spark, folder):
    return joins.inner(*_both(spark, folder))


@query("join_left", _SIDES + f"SELECT {_COLUMNS} FROM people LEFT JOIN deals USING (user_id)")
def join_left(spark, folder):
    return joins.left_outer(*_both(spark, folder))


@query("join_right", _SIDES + f"SELECT {_COLUMNS} FROM people RIGHT JOIN deals USING (user_id)")
def join_right(spark, folder):
    return joins.right_outer(*_both(spark, folder))


@query("join_full", _SIDES + f"SELECT {_COLUMNS} FROM people FULL JOIN deals USING (user_id)")
def join_full(spark, folder):
    return joins.full_outer(*_both(spark, folder))


@query(
    "join_anti_symmetric",
    _SIDES + f"""SELECT {_COLUMNS} FROM people FULL JOIN deals USING (user_id)
    WHERE user_id NOT IN (SELECT p.user_id FROM people p JOIN deals d ON p.user_id = d.user_id)""",
)
def join_anti_symmetric(spark, folder):
    return joins.anti_both(*_both(spark, folder))


@query("join_semi", _SIDES + "SELECT user_id, name, reputation FROM people WHERE user_id IN (SELECT user_id FROM deals)")
def join_semi(spark, folder):
    return joins.with_partner(*_both(spark, folder))


@query(
    "join_broadcast",
    "SELECT c_custkey, c_name, c_nationkey, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey + 3",
)
def join_broadcast(spark, folder):
    small = table(spark, folder, "nation").select((F.col("n_nationkey") + 3).alias("c_nationkey"), "n_name")
    big = table(spark, folder, "customer").select("c_custkey", "c_name", "c_nationkey")
    return joins.replicated(big, small, ["c_nationkey"], "left")


BUCKETS = 8  # one task's work each, at the size of the test tables


@query(
    "join_bucketed",
    """SELECT o_orderkey AS order_id, o_custkey, l_partkey, l_quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def join_bucketed(spark, folder):
    lines = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("order_id"), "l_partkey", "l_quantity")
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("order_id"), "o_custkey")
    return joins.bucketed(lines, orders, "order_id", BUCKETS)


@query("join_bucketed_full", _SIDES + f"SELECT {_COLUMNS} FROM people FULL JOIN deals USING (user_id)")
def join_bucketed_full(spark, folder):
    left, right, (key,) = _both(spark, folder)
    return joins.bucketed(left, right, key, BUCKETS, "full")


EXPECTED_USERS = 100_000  # size of the filter, whatever the tables hold


@query(
    "join_bloom_prefilter",
    """SELECT c_custkey AS user_id, c_acctbal, o_orderkey, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey
       WHERE c_acctbal > 1500""",
)
def join_bloom_prefilter(spark, folder):
    users = table(spark, folder, "customer").select(F.col("c_custkey").alias("user_id"), "c_acctbal")
    orders = table(spark, folder, "orders").select(F.col("o_custkey").alias("user_id"), "o_orderkey", "o_totalprice")
    return bloom.joined_through_filter(orders, users.where("c_acctbal > 1500"), ["user_id"], EXPECTED_USERS)


@query(
    "cogroup_lists",
    """SELECT n_nationkey AS key, 'left' AS side, row_number() OVER (PARTITION BY n_nationkey ORDER BY s_acctbal, s_suppkey) AS position,
           s_acctbal AS value FROM supplier JOIN nation ON s_nationkey = n_nationkey
    UNION ALL SELECT c_nationkey, 'right', row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal, c_custkey), c_acctbal FROM customer""",
)
def cogroup_lists(spark, folder):
    suppliers = table(spark, folder, "supplier").select(F.col("s_nationkey").alias("key"), "s_suppkey", "s_acctbal")
    customers = table(spark, folder, "customer").select(F.col("c_nationkey").alias("key"), "c_custkey", "c_acctbal")
    return joins.cogroup_values(suppliers, customers, "key", "s_acctbal", "c_acctbal", ("s_suppkey", "c_custkey"))


def _symbol(stocks, symbol, name):
    return stocks.where(F.col("symbol") == symbol).select("ymd", F.col("price_close").alias(name))


@query(
    "join_self_date",
    views.sql("stocks") + """SELECT a.ymd, a.price_close AS price_a, b.price_close AS price_b FROM stocks a
    JOIN stocks b ON a.ymd = b.ymd WHERE a.symbol = '1-URGENT' AND b.symbol = '2-HIGH'""",
)
def join_self_date(spark, folder):
    stocks = views.stocks(spark, folder)
    return _symbol(stocks, "1-URGENT", "price_a").join(_symbol(stocks, "2-HIGH", "price_b"), "ymd")


@query(
    "join_three_way",
    views.sql("stocks") + """SELECT a.ymd, a.price_close AS price_a, b.price_close AS price_b, c.price_close AS price_c
    FROM stocks a JOIN stocks b ON a.ymd = b.ymd JOIN stocks c ON a.ymd = c.ymd
    WHERE a.symbol = '1-URGENT' AND b.symbol = '2-HIGH' AND c.symbol = '5-LOW'""",
)
def join_three_way(spark, folder):
    stocks = views.stocks(spark, folder)
    first = _symbol(stocks, "1-URGENT", "price_a").join(_symbol(stocks, "2-HIGH", "price_b"), "ymd")
    return first.join(_symbol(stocks, "5-LOW", "price_c"), "ymd")


@query(
    "join_two_keys",
    views.sql("stocks", "dividends") + """SELECT s.ymd, s.symbol, s.price_close, d.dividend FROM stocks s
    LEFT JOIN dividends d ON s.ymd = d.ymd AND s.symbol = d.symbol""",
)
def join_two_keys(spark, folder):
    stocks = views.stocks(spark, folder).select("ymd", "symbol", "price_close")
    return stocks.join(views.dividends(spark, folder), ["ymd", "symbol"], "left")


_SKEW_SQL = "SELECT l_suppkey AS supp, l_orderkey, l_quantity, s_name FROM lineitem JOIN supplier ON l_suppkey = s_suppkey"


def _skew_sides(spark, folder):
    lines = table(spark, folder, "lineitem").select(F.col("l_suppkey").alias("supp"), "l_orderkey", "l_quantity")
    suppliers = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("supp"), "s_name")
    return lines, suppliers


@query("join_skew_split", _SKEW_SQL)
def join_skew_split(spark, folder):
    lines, suppliers = _skew_sides(spark, folder)
    return skew.split_join(lines, suppliers, "supp", ["l_orderkey", "l_quantity"], salts=8)


@query("join_salted", _SKEW_SQL)
def join_salted(spark, folder):
    lines, suppliers = _skew_sides(spark, folder)
    return skew.salted_join(lines, suppliers, "supp", ["l_orderkey", "l_quantity"], salts=10)
