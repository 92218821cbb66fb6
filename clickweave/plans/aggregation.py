"""Aggregations, word counts and the link index."""

from pyspark.sql import functions as F

from clickweave.functions import scalars
from clickweave.operators import aggregates, filters, sketches, skew, text
from clickweave.operators.ordering import top_rows, with_position
from clickweave.plans import views
from clickweave.plans.projection import SALE_LOG_SQL, sale_log
from clickweave.plans.registry import query
from clickweave.plans.views import table
from clickweave.workspace import fresh_dir


@query("reduce_sum", "SELECT CAST(sum(o_custkey) AS BIGINT) AS total, count(*) AS n FROM orders")
def reduce_sum(spark, folder):
    return table(spark, folder, "orders").agg(F.sum("o_custkey").alias("total"), F.count("*").alias("n"))


@query("take_n", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 3")
def take_n(spark, folder):
    return top_rows(table(spark, folder, "orders").select("o_orderkey", "o_custkey"), ["o_orderkey"], 3)


@query("count_by_key", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def count_by_key(spark, folder):
    return table(spark, folder, "events").groupBy("event_type").agg(F.count("*").alias("n"))


@query("sum_by_key", "SELECT l_suppkey, sum(l_quantity) AS quantity FROM lineitem GROUP BY 1")
def sum_by_key(spark, folder):
    return table(spark, folder, "lineitem").groupBy("l_suppkey").agg(F.sum("l_quantity").alias("quantity"))


@query(
    "group_values",
    "SELECT event_type, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS position, event_id AS value FROM events",
)
def group_values(spark, folder):
    events = table(spark, folder, "events").select("event_type", "event_id")
    return aggregates.grouped_values(events, "event_type", "event_id", "event_id")


_ENTITIES = "MAP {" + ", ".join(f"'{name}': chr({ord(char)})" for name, char in sorted(scalars.ENTITIES.items())) + "}"


def _sql_unescape(text: str) -> str:
    """SQL for HTML entities as characters."""
    name = "regexp_extract(p, '^(#?[0-9a-zA-Z]{1,9});', 1)"
    code = f"""CASE WHEN regexp_full_match({name}, '#[0-9]{{1,7}}') THEN CAST({name}[2:] AS BIGINT)
        WHEN regexp_full_match({name}, '#[xX][0-9a-fA-F]{{1,6}}') THEN CAST('0x' || {name}[3:] AS BIGINT) END"""
    char = f"CASE WHEN {code} BETWEEN 1 AND 1114111 AND NOT {code} BETWEEN 55296 AND 57343 THEN chr(CAST({code} AS INTEGER)) ELSE {_ENTITIES}[{name}] END"
    return f"""(string_split({text}, '&')[1] || array_to_string([coalesce({char} || p[length({name}) + 2:], '&' || p) FOR p IN string_split({text}, '&')[2:]], ''))"""


_CLEAN = f"replace({_sql_unescape('lower(text)')}, '''', '')"


def _clean_words(source: str) -> str:
    return f"""words AS (SELECT unnest(string_split(regexp_replace({_CLEAN}, '[^a-zA-Z]', ' ', 'g'), ' ')) AS word FROM {source})"""


_CLEAN_WORDS = _clean_words("documents")


@query(
    "wordcount_pages",
    f"WITH {_clean_words('(SELECT html AS text FROM pages)')} SELECT word, count(*) AS n FROM words WHERE word <> '' GROUP BY 1",
)
def wordcount_pages(spark, folder):
    return text.word_counts(table(spark, folder, "pages"), text.clean_words("html"))


@query("wordcount_clean", f"WITH {_CLEAN_WORDS} SELECT word, count(*) AS n FROM words WHERE word <> '' GROUP BY 1")
def wordcount_clean(spark, folder):
    return text.word_counts(table(spark, folder, "documents"), text.clean_words("text"))


@query(
    "wordcount_plain",
    """SELECT word, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents)
       WHERE word <> '' GROUP BY 1""",
)
def wordcount_plain(spark, folder):
    return text.word_counts(table(spark, folder, "documents"), F.split("text", " "))


@query(
    "wordcount_sorted",
    f"""WITH {_CLEAN_WORDS} SELECT word, n, row_number() OVER (ORDER BY n DESC, word) AS position
        FROM (SELECT word, count(*) AS n FROM words WHERE word <> '' GROUP BY 1)""",
)
def wordcount_sorted(spark, folder):
    counts = text.word_counts(table(spark, folder, "documents"), text.clean_words("text"))
    return with_position(counts, [F.desc("n"), F.asc("word")])


@query(
    "line_count",
    "SELECT line, count(*) AS n FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY 1",
)
def line_count(spark, folder):
    return text.line_counts(table(spark, folder, "documents"), "text")


@query(
    "minmaxcount_by_user",
    "SELECT user_id, min(ts) AS first_ts, max(ts) AS last_ts, count(*) AS n FROM events GROUP BY 1",
)
def minmaxcount_by_user(spark, folder):
    return table(spark, folder, "events").groupBy("user_id").agg(
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.count("*").alias("n")
    )


@query(
    "avg_len_by_hour",
    """SELECT CAST(hour(ts) AS INTEGER) AS hour, count(*) AS n, round(CAST(sum(length(props)) AS BIGINT) / count(*), 6) AS avg_length
       FROM events GROUP BY 1""",
)
def avg_len_by_hour(spark, folder):
    return table(spark, folder, "events").groupBy(F.hour("ts").alias("hour")).agg(
        F.count("*").alias("n"), F.round(F.sum(F.length("props")) / F.count("*"), 6).alias("avg_length")
    )


_STATES = ", ".join(f"'{s}'" for s in text.STATES)


@query(
    "dictionary_counts",
    f"""SELECT state, count(*) AS n FROM (SELECT CASE WHEN coalesce(text, '') = '' THEN 'Null or Empty' ELSE
        coalesce(list_filter(regexp_split_to_array(upper(text), '\\s'), lambda t: t IN ({_STATES}))[1], 'Unknown') END AS state
        FROM documents) GROUP BY 1""",
)
def dictionary_counts(spark, folder):
    state = text.first_known("text").alias("state")
    return table(spark, folder, "documents").select(state).groupBy("state").agg(F.count("*").alias("n"))


_HREF = 'href="([^"]+)"'


@query(
    "inverted_index_links",
    f"""WITH hits AS (SELECT page_id, unnest(list_distinct(regexp_extract_all({_sql_unescape('lower(html)')}, 'href="([^"]+)"', 1))) AS link
                      FROM pages)
    SELECT link, row_number() OVER (PARTITION BY link ORDER BY page_id) AS position, page_id FROM hits""",
)
def inverted_index_links(spark, folder):
    return text.link_index(table(spark, folder, "pages"), "page_id", "html", _HREF)


@query(
    "agg_global",
    """SELECT count(*) AS n, round(avg(c_acctbal), 4) AS mean, min(c_acctbal) AS low, max(c_acctbal) AS high FROM customer""",
)
def agg_global(spark, folder):
    return table(spark, folder, "customer").agg(*_summary())


def _summary():
    balance = F.col("c_acctbal")
    return (
        F.count("*").alias("n"), F.round(F.avg(balance), 4).alias("mean"),
        F.min(balance).alias("low"), F.max(balance).alias("high"),
    )


@query(
    "agg_by_group",
    """SELECT c_nationkey, count(*) AS n, round(avg(c_acctbal), 4) AS mean, min(c_acctbal) AS low, max(c_acctbal) AS high
       FROM customer GROUP BY 1""",
)
def agg_by_group(spark, folder):
    return table(spark, folder, "customer").groupBy("c_nationkey").agg(*_summary())


_YEARLY = """SELECT CAST(year(ymd) AS INTEGER) AS year, round(avg(price_close), 4) AS mean FROM stocks
    WHERE exchange = 'NASDAQ' AND symbol = '1-URGENT' GROUP BY 1"""


@query("group_year", views.sql("stocks") + _YEARLY)
def group_year(spark, folder):
    return spark.sql(
        """SELECT year(ymd) AS year, round(avg(price_close), 4) AS mean FROM {stocks}
           WHERE exchange = 'NASDAQ' AND symbol = '1-URGENT' GROUP BY year(ymd)""",
        stocks=views.stocks(spark, folder),
    )


@query("group_having", views.sql("stocks") + _YEARLY + " HAVING avg(price_close) > 250000")
def group_having(spark, folder):
    return spark.sql(
        """SELECT year(ymd) AS year, round(avg(price_close), 4) AS mean FROM {stocks}
           WHERE exchange = 'NASDAQ' AND symbol = '1-URGENT' GROUP BY year(ymd) HAVING avg(price_close) > 250000""",
        stocks=views.stocks(spark, folder),
    )


@query(
    "daily_sale",
    f"""WITH {SALE_LOG_SQL} SELECT split_part(line, ',', 1) AS date, round(sum(CAST(split_part(line, ',', 2) AS DOUBLE)), 2) AS amount
        FROM sale_log WHERE line NOT LIKE '%,' GROUP BY 1""",
)
def daily_sale(spark, folder):
    lines = filters.well_formed(sale_log(spark, folder), "line", 3)
    parts = F.split("line", ",")
    sales = lines.select(parts[0].alias("date"), parts[1].try_cast("double").alias("amount"))
    return sales.groupBy("date").agg(F.round(F.sum("amount"), 2).alias("amount"))


@query(
    "daily_uv",
    "SELECT strftime(ts, '%Y-%m-%d') AS date, count(DISTINCT user_id) AS uv FROM events GROUP BY 1",
)
def daily_uv(spark, folder):
    visits = table(spark, folder, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("date"), "user_id")
    return aggregates.distinct_per_group(visits, ["date"], "user_id", "uv")


UV_ERROR = 0.02


@query(
    "daily_uv_approx",
    "SELECT strftime(ts, '%Y-%m-%d') AS date, count(DISTINCT user_id) AS exact, TRUE AS within_error FROM events GROUP BY 1",
)
def daily_uv_approx(spark, folder):
    """The estimate beside the exact count: whether it is within five standard errors."""
    day = F.date_format("ts", "yyyy-MM-dd").alias("date")
    counts = table(spark, folder, "events").groupBy(day).agg(
        F.approx_count_distinct("user_id", UV_ERROR).alias("estimate"), F.countDistinct("user_id").alias("exact")
    )
    near = F.abs(F.col("estimate") - F.col("exact")) <= F.ceil(5 * UV_ERROR * F.col("exact"))
    return counts.select("date", "exact", near.alias("within_error"))


@query(
    "period_uv_sketch",
    """WITH visits AS (SELECT strftime(ts, '%Y-%m') AS month, strftime(date_trunc('week', ts), '%Y-%m-%d') AS week, user_id FROM events)
    SELECT 'month' AS kind, month AS period, count(DISTINCT user_id) AS exact, TRUE AS within_error FROM visits GROUP BY 2
    UNION ALL SELECT 'week', week, count(DISTINCT user_id), TRUE FROM visits GROUP BY 2""",
)
def period_uv_sketch(spark, folder):
    """Visitors of weeks and months from sketches stored by day, beside exact counts: within five standard errors?

    The events of every seventh id arrive late, in a second batch, and are merged into their days.
    """
    events = table(spark, folder, "events")
    log = sketches.sketch_log(spark, fresh_dir(spark, "uv-sketches"))
    for i, arrived in enumerate(("event_id % 7 <> 0", "event_id % 7 = 0")):
        log.write(sketches.daily_sketches(events.where(arrived), F.date_format("ts", "yyyy-MM-dd"), "user_id"), i)
    near = F.abs(F.col("estimate") - F.col("exact")) <= F.ceil(5 * sketches.standard_error() * F.col("exact"))
    out = None
    for kind, of_day, of_event in (
        ("month", F.substring("day", 1, 7), F.date_format("ts", "yyyy-MM")),
        ("week", F.date_format(F.date_trunc("week", F.col("day").cast("timestamp_ntz")), "yyyy-MM-dd"), F.date_format(F.date_trunc("week", "ts"), "yyyy-MM-dd")),
    ):
        exact = events.groupBy(of_event.alias("period")).agg(F.countDistinct("user_id").alias("exact"))
        both = exact.join(sketches.distinct_in(log.rows(), of_day, "estimate"), "period", "left")
        lines = both.select(F.lit(kind).alias("kind"), "period", "exact", F.coalesce(near, F.lit(False)).alias("within_error"))
        out = lines if out is None else out.unionByName(lines)
    return out


@query("agg_salted", "SELECT l_returnflag, sum(l_quantity) AS quantity, count(*) AS n FROM lineitem GROUP BY 1")
def agg_salted(spark, folder):
    lines = table(spark, folder, "lineitem")
    sums = {"quantity": F.col("l_quantity"), "n": F.lit(1).cast("long")}
    return skew.salted_sum(lines, ["l_returnflag"], sums, ["l_orderkey", "l_partkey"])


@query("observe_sum", "SELECT CAST(sum(o_custkey) AS BIGINT) AS total, count(*) AS n FROM orders")
def observe_sum(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    counters = aggregates.observed(orders, {"total": F.sum("o_custkey"), "n": F.count(F.lit(1))})
    return spark.createDataFrame([(counters["total"], counters["n"])], "total long, n long")


@query(
    "category_counts",
    views.sql("actions") + """, hits AS (
        SELECT 'click' AS kind, click_category_id AS category_id FROM actions WHERE click_category_id IS NOT NULL
        UNION ALL SELECT 'order', CAST(unnest(string_split(order_category_ids, ',')) AS BIGINT) FROM actions
        UNION ALL SELECT 'pay', CAST(unnest(string_split(pay_category_ids, ',')) AS BIGINT) FROM actions)
    SELECT category_id, count(*) FILTER (kind = 'click') AS click_count, count(*) FILTER (kind = 'order') AS order_count,
           count(*) FILTER (kind = 'pay') AS pay_count FROM hits GROUP BY 1""",
)
def category_counts(spark, folder):
    kinds = {
        "click_count": aggregates.one_id("click_category_id"),
        "order_count": aggregates.id_list("order_category_ids"),
        "pay_count": aggregates.id_list("pay_category_ids"),
    }
    return aggregates.counts_per_kind(views.actions(spark, folder), kinds, "category_id")
