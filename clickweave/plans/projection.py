"""Projection, filters, scalar functions and named functions."""

from pyspark.sql import functions as F

from clickweave.functions import registered, scalars
from clickweave.functions.hashing import sql_hash_number
from clickweave.operators import bloom, filters
from clickweave.plans import views
from clickweave.plans.registry import query
from clickweave.plans.views import table
from clickweave.workspace import fresh_dir

FACTOR = 3


@query(
    "map_select",
    f"""SELECT l_orderkey AS order_id, l_linenumber AS line, l_quantity * 2 AS doubled,
               round(l_extendedprice * {FACTOR}, 2) AS scaled, l_quantity + 1 AS plus_one FROM lineitem""",
)
def map_select(spark, folder):
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line"),
        (F.col("l_quantity") * 2).alias("doubled"),
        F.round(F.col("l_extendedprice") * FACTOR, 2).alias("scaled"),
        (F.col("l_quantity") + 1).alias("plus_one"),
    )


@query(
    "filter_even",
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
       WHERE o_orderkey % 2 = 0 AND o_custkey > 18 AND o_totalprice IS NOT NULL""",
)
def filter_even(spark, folder):
    return (
        table(spark, folder, "orders")
        .where((F.col("o_orderkey") % 2 == 0) & (F.col("o_custkey") > 18) & F.col("o_totalprice").isNotNull())
        .select("o_orderkey", "o_custkey", "o_totalprice")
    )


@query(
    "flatmap_words",
    """SELECT conv_id, turn, word FROM (SELECT conv_id, turn, unnest(string_split(text, ' ')) AS word FROM conversations)
       WHERE word <> ''""",
)
def flatmap_words(spark, folder):
    words = F.explode(F.split("text", " ")).alias("word")
    return table(spark, folder, "conversations").select("conv_id", "turn", words).where("word <> ''")


@query(
    "where_eq_and",
    views.sql("employees") + "SELECT employee_id, name, city, state FROM employees WHERE city = 'NATION_7' AND state = 'NA'"
    " OR city > 'NATION_3' AND salary > 5000",
)
def where_eq_and(spark, folder):
    return spark.sql(
        "SELECT employee_id, name, address.city AS city, address.state AS state FROM {people} "
        "WHERE address.city = 'NATION_7' AND address.state = 'NA' OR address.city > 'NATION_3' AND salary > 5000",
        people=views.employees(spark, folder),
    )


@query(
    "where_like",
    views.sql("employees") + """SELECT employee_id, street, city, street LIKE '%Lane' AS suffix, city LIKE 'NATION_1%' AS prefix,
       street LIKE '%Mill%' AS infix FROM employees
       WHERE street LIKE '%Lane' OR city LIKE 'NATION_1%' OR street LIKE '%Mill%'""",
)
def where_like(spark, folder):
    street, city = F.col("address.street"), F.col("address.city")
    return views.employees(spark, folder).where(
        street.like("%Lane") | city.like("NATION_1%") | street.like("%Mill%")
    ).select(
        "employee_id", street.alias("street"), city.alias("city"),
        street.like("%Lane").alias("suffix"), city.like("NATION_1%").alias("prefix"), street.like("%Mill%").alias("infix"),
    )


@query(
    "where_rlike",
    views.sql("employees") + """SELECT employee_id, name, street FROM employees
       WHERE regexp_matches(street, '.*(Miller|Harbour).*')""",
)
def where_rlike(spark, folder):
    return (
        views.employees(spark, folder)
        .where(F.col("address.street").rlike(".*(Miller|Harbour).*"))
        .select("employee_id", "name", F.col("address.street").alias("street"))
    )


@query(
    "where_float_cast",
    views.sql("employees") + """SELECT employee_id, federal_taxes > CAST(0.2 AS DOUBLE) AS over_double,
       federal_taxes > CAST(0.2 AS FLOAT) AS over_float FROM employees WHERE CAST(federal_taxes AS DOUBLE) > CAST(0.2 AS DOUBLE)""",
)
def where_float_cast(spark, folder):
    taxes = F.col("deductions")["income"]
    return (
        views.employees(spark, folder)
        .where(taxes > F.lit(0.2))
        .select(
            "employee_id",
            (taxes > F.lit(0.2)).alias("over_double"),
            (taxes > F.lit(0.2).cast("float")).alias("over_float"),
        )
    )


@query(
    "where_subquery",
    views.sql("employees") + """SELECT name, ded, net FROM (SELECT name, federal_taxes AS ded,
       round(salary * (1 - federal_taxes), 2) AS net FROM employees) e WHERE round(e.net) > 4000""",
)
def where_subquery(spark, folder):
    return spark.sql(
        """SELECT name, ded, net FROM (SELECT name, deductions['income'] AS ded,
           round(salary * (1 - deductions['income']), 2) AS net FROM {people}) e WHERE round(e.net) > 4000""",
        people=views.employees(spark, folder),
    )


@query("select_regex_cols", views.sql("stocks") + "SELECT ymd, symbol, price_close, price_high FROM stocks")
def select_regex_cols(spark, folder):
    stocks = views.stocks(spark, folder)
    return stocks.select("ymd", "symbol", stocks.colRegex("`price.*`"))


@query(
    "select_nested",
    views.sql("employees") + """SELECT name, state_taxes, city, 60000 AS zip FROM employees""",
)
def select_nested(spark, folder):
    return views.employees(spark, folder).select(
        "name",
        F.col("deductions")["pension"].alias("state_taxes"),
        F.col("address.city").alias("city"),
        F.col("address.zip").alias("zip"),
    )


@query(
    "select_limit",
    views.sql("employees") + """SELECT upper(name) AS upper_name, salary, federal_taxes AS fed_taxes FROM employees
       ORDER BY name LIMIT 2""",
)
def select_limit(spark, folder):
    return (
        views.employees(spark, folder)
        .orderBy("name")
        .limit(2)
        .select(F.upper("name").alias("upper_name"), "salary", F.col("deductions")["income"].alias("fed_taxes"))
    )


BLOOM_WORDS, BLOOM_RATE = 20_000, 0.0001
_BLOCK_BITS = f"""bits AS (SELECT word, ((h % {bloom.blocks_for(BLOOM_WORDS, BLOOM_RATE)}) * 8 + i) * 32 + ((b >> (5 * i)) & 31) AS bit
        FROM (SELECT word, CAST('0x' || substr(md5(word), 1, 12) AS BIGINT) AS h, CAST('0x' || substr(md5(word), 13, 10) AS BIGINT) AS b,
            unnest(range(8)) AS i FROM {{0}}))"""
_HOT_WORDS = f"""hot AS (SELECT DISTINCT word FROM (SELECT unnest(string_split(replace(text, chr(10), ' '), ' ')) AS word
    FROM benchmark)),
    doc_words AS (SELECT DISTINCT doc_id, word FROM (SELECT doc_id,
    unnest(string_split(replace(text, chr(10), ' '), ' ')) AS word FROM documents))"""


def _hot_words(spark, folder):
    return table(spark, folder, "benchmark").select(F.explode(scalars.words_of("text")).alias("word"))


@query(
    "bloom_filter_docs",
    f"""WITH {_HOT_WORDS},
    {_BLOCK_BITS.format('(SELECT word FROM hot UNION SELECT word FROM doc_words)')},
    member AS (SELECT word FROM bits GROUP BY word
        HAVING bool_and(bit IN (SELECT bit FROM bits JOIN hot USING (word))))
    SELECT doc_id, n_chars FROM documents
    WHERE doc_id IN (SELECT doc_id FROM doc_words JOIN member USING (word))""",
)
def bloom_filter_docs(spark, folder):
    documents = table(spark, folder, "documents")
    known = bloom.BlockBloom.trained(_hot_words(spark, folder), "word", BLOOM_WORDS, BLOOM_RATE)
    return known.keep_any(documents, scalars.words_of("text"), "doc_id").select("doc_id", "n_chars")


@query(
    "bloom_saved_pages",
    f"""WITH {_HOT_WORDS}, trained AS (SELECT word FROM hot UNION SELECT lang FROM documents),
    asked AS (SELECT DISTINCT page_id, word FROM (SELECT page_id, unnest(string_split(replace(html, chr(10), ' '), ' ')) AS word FROM pages)),
    {_BLOCK_BITS.format('(SELECT word FROM trained UNION SELECT word FROM asked)')},
    member AS (SELECT word FROM bits GROUP BY word HAVING bool_and(bit IN (SELECT bit FROM bits JOIN trained USING (word))))
    SELECT page_id, count(*) AS n_known FROM asked JOIN member USING (word) GROUP BY 1""",
)
def bloom_saved_pages(spark, folder):
    """Two filters trained apart, merged and saved; loaded again, they tell how many words of a page are known."""
    words = bloom.BlockBloom.trained(_hot_words(spark, folder), "word", BLOOM_WORDS, BLOOM_RATE)
    langs = bloom.BlockBloom.trained(table(spark, folder, "documents").select("lang"), "lang", BLOOM_WORDS, BLOOM_RATE)
    path = fresh_dir(spark, "bloom-saved")
    words.merged(langs).save(path)
    asked = table(spark, folder, "pages").select("page_id", F.explode(F.array_distinct(scalars.words_of("html"))).alias("word"))
    known = bloom.BlockBloom.load(spark, path).keep(asked, "word")
    return known.groupBy("page_id").agg(F.count("*").alias("n_known"))


@query(
    "semi_filter_exact",
    f"""WITH {_HOT_WORDS} SELECT doc_id, n_chars FROM documents
        WHERE doc_id IN (SELECT doc_id FROM doc_words JOIN hot USING (word))""",
)
def semi_filter_exact(spark, folder):
    documents = table(spark, folder, "documents")
    kept = filters.keep_by_join(documents, scalars.words_of("text"), _hot_words(spark, folder), "word", "doc_id")
    return kept.select("doc_id", "n_chars")


LINE_PATTERN = "[A-Z][a-z]+ [a-z ,]+[.]"


@query(
    "grep_fullmatch",
    f"""SELECT doc_id, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
        WHERE regexp_full_match(line, '{LINE_PATTERN}')""",
)
def grep_fullmatch(spark, folder):
    lines = table(spark, folder, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    return lines.where(filters.full_match(F.col("line"), LINE_PATTERN))


@query("sample_bernoulli", "SELECT 0 AS unknown, 0 AS twice, TRUE AS near_share FROM (SELECT count(*) FROM orders)")
def sample_bernoulli(spark, folder):
    """Facts about the sample: rows that are not in the table, rows drawn twice, and whether its size is within
    four standard deviations of a tenth."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    drawn = filters.sample_percent(orders, 10, 9).select("o_orderkey", F.lit(1).alias("_n"))
    times = drawn.groupBy("o_orderkey").agg(F.count("*").alias("n"))
    both = orders.select("o_orderkey", F.lit(True).alias("known")).join(times, "o_orderkey", "full")
    n, drawn_rows = F.count_if("known"), F.coalesce(F.sum("n"), F.lit(0))
    return both.agg(
        F.count_if(F.col("known").isNull()).cast("int").alias("unknown"), F.count_if(F.col("n") > 1).cast("int").alias("twice"),
        (F.abs(drawn_rows - n * 0.1) <= 4 * F.sqrt(n * 0.09) + 1).alias("near_share"),
    )


@query(
    "sample_hash",
    f"SELECT o_orderkey, o_custkey FROM orders WHERE {sql_hash_number('CAST(o_orderkey AS VARCHAR)')} % 100 < 10",
)
def sample_hash(spark, folder):
    return filters.sample_percent_by_key(table(spark, folder, "orders").select("o_orderkey", "o_custkey"), 10, "o_orderkey")


@query("distinct_users", "SELECT DISTINCT user_id FROM events WHERE user_id IS NOT NULL")
def distinct_users(spark, folder):
    return table(spark, folder, "events").where("user_id IS NOT NULL").select("user_id").distinct()


SALE_LOG_SQL = """sale_log AS (SELECT strftime(o_orderdate, '%Y-%m-%d') || ',' || o_totalprice || ',' ||
    CASE WHEN o_orderkey % 10 = 0 THEN '' ELSE CAST(o_custkey AS VARCHAR) END AS line FROM orders)"""


def sale_log(spark, folder):
    """Sale log lines ``date,amount,user``; every tenth has lost its user."""
    user = F.when(F.col("o_orderkey") % 10 == 0, "").otherwise(F.col("o_custkey").cast("string"))
    return table(spark, folder, "orders").select(
        F.concat_ws(",", F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_totalprice"), user).alias("line")
    )


@query("valid_log_filter", f"WITH {SALE_LOG_SQL} SELECT line FROM sale_log WHERE line NOT LIKE '%,'")
def valid_log_filter(spark, folder):
    return filters.well_formed(sale_log(spark, folder), "line", 3)


# ---- scalar functions


@query(
    "expr_upper_round",
    views.sql("employees") + """SELECT upper(name) AS upper_name, salary, federal_taxes AS fed_taxes,
       round(salary * (1 - federal_taxes)) AS net FROM employees""",
)
def expr_upper_round(spark, folder):
    fed = F.col("deductions")["income"]
    return views.employees(spark, folder).select(
        F.upper("name").alias("upper_name"), "salary", fed.alias("fed_taxes"),
        F.round(scalars.net_of("salary", fed)).alias("net"),
    )


@query(
    "date_interval",
    """SELECT o_orderkey, CAST(o_orderdate - INTERVAL 5 DAY AS DATE) AS minus_5_days,
              CAST(o_orderdate - INTERVAL 5 YEAR AS DATE) AS minus_5_years FROM orders""",
)
def date_interval(spark, folder):
    day = F.to_date("o_orderdate")
    return (
        table(spark, folder, "orders")
        .select(
            "o_orderkey",
            (day - F.expr("INTERVAL 5 DAY")).alias("minus_5_days"),
            (day - F.expr("INTERVAL 5 YEAR")).alias("minus_5_years"),
        )
    )


@query(
    "date_diff",
    """SELECT o_custkey, date_diff('day', CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE)) AS days
       FROM orders GROUP BY o_custkey""",
)
def date_diff(spark, folder):
    days = F.datediff(F.max("o_orderdate"), F.min("o_orderdate")).cast("long").alias("days")
    return table(spark, folder, "orders").groupBy("o_custkey").agg(days)


NOON = "2024-01-15 12:00:00"


@query(
    "date_keys",
    f"""SELECT event_id, strftime(ts, '%Y-%m-%d_%H') AS date_hour, strftime(ts, '%Y%m%d') AS date_key,
               strftime(ts, '%Y%m%d%H%M') AS minute_key, CAST(ts AS DATE) AS parsed_date,
               date_trunc('minute', ts) AS parsed_minute, ts < TIMESTAMP '{NOON}' AS before_noon,
               CAST(trunc((epoch_us(ts) - epoch_us(TIMESTAMP '{NOON}')) / 1000000) AS BIGINT) AS seconds,
               CAST(CAST(ts AS DATE) - INTERVAL 1 DAY AS DATE) AS day_before FROM events""",
)
def date_keys(spark, folder):
    noon = views.ntz(NOON)
    return table(spark, folder, "events").select(
        "event_id",
        scalars.date_hour("ts").alias("date_hour"),
        scalars.date_key("ts").alias("date_key"),
        scalars.minute_key("ts").alias("minute_key"),
        scalars.parse_date_key(scalars.date_key("ts")).alias("parsed_date"),
        scalars.parse_minute_key(scalars.minute_key("ts")).alias("parsed_minute"),
        (F.col("ts") < noon).alias("before_noon"),
        scalars.seconds_between("ts", noon).alias("seconds"),
        F.date_sub("ts", 1).alias("day_before"),
    )


_SCORE = "CAST(json_extract_string(props, '$.k') AS INTEGER)"


@query(
    "case_grade",
    f"""SELECT event_id, CASE WHEN k >= 90 THEN 'A' WHEN k >= 80 THEN 'B' WHEN k >= 70 THEN 'C' WHEN k >= 60 THEN 'D'
        ELSE 'E' END AS grade FROM (SELECT event_id, {_SCORE} AS k FROM events)""",
)
def case_grade(spark, folder):
    score = scalars.json_field("props", "k").cast("int")
    return table(spark, folder, "events").select("event_id", scalars.grade(score).alias("grade"))


@query(
    "if_grade",
    f"SELECT event_id, CASE WHEN {_SCORE} >= 80 THEN 'GOOD' ELSE 'BAD' END AS grade FROM events",
)
def if_grade(spark, folder):
    score = scalars.json_field("props", "k").cast("int")
    return table(spark, folder, "events").select("event_id", scalars.good_or_bad(score).alias("grade"))


@query(
    "string_helpers",
    """SELECT event_id, keyword IS NULL OR keyword = '' AS is_empty, CAST(user_id AS VARCHAR) || ',x' AS trimmed,
              CASE WHEN length(hour) = 2 THEN hour ELSE '0' || hour END AS padded
       FROM (SELECT event_id, user_id, CASE WHEN event_type = 'view' THEN 'kw' WHEN event_type = 'click' THEN '' END AS keyword,
                    CAST(hour(ts) AS VARCHAR) AS hour FROM events)""",
)
def string_helpers(spark, folder):
    kind = F.col("event_type")
    return table(spark, folder, "events").select(
        "event_id",
        scalars.is_empty(F.when(kind == "view", "kw").when(kind == "click", "")).alias("is_empty"),
        scalars.trim_comma(F.concat(F.lit(","), F.col("user_id").cast("string"), F.lit(",x,"))).alias("trimmed"),
        scalars.two_digits(F.hour("ts").cast("string")).alias("padded"),
    )


@query(
    "kv_string_field",
    """SELECT event_id, CAST(user_id AS VARCHAR) AS user_field, CASE WHEN event_type = 'view' THEN 'kw' END AS keyword_field,
              'user=' || user_id || '|keyword=' || CASE WHEN event_type = 'view' THEN 'kw' ELSE '' END || '|kind=seen' AS changed
       FROM events""",
)
def kv_string_field(spark, folder):
    keyword = F.when(F.col("event_type") == "view", "kw").otherwise("")
    packed = F.concat(
        F.lit("user="), F.col("user_id").cast("string"), F.lit("|keyword="), keyword, F.lit("|kind="), F.col("event_type")
    )
    return table(spark, folder, "events").select(
        "event_id",
        scalars.packed_field(packed, "user").alias("user_field"),
        scalars.packed_field(packed, "keyword").alias("keyword_field"),
        scalars.with_packed_field(packed, "kind", F.lit("seen")).alias("changed"),
    )


@query("json_field", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_field(spark, folder):
    return table(spark, folder, "events").select("event_id", scalars.json_field("props", "k").alias("k"))


# ---- named functions


@query("udf_strlen", "SELECT doc_id, CAST(length(text) AS INTEGER) AS by_sql FROM documents")
def udf_strlen(spark, folder):
    registered.register(spark)
    return table(spark, folder, "documents").select(
        "doc_id", F.call_function("strLen", F.col("text")).alias("by_sql")
    )


@query("udaf_strcount", "SELECT n_name AS name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")
def udaf_strcount(spark, folder):
    users = views.users(spark, folder)
    return users.groupBy(F.col("city").alias("name")).agg(registered.str_count("n"))


@query(
    "udf_concat",
    "SELECT c_custkey, coalesce(CAST(nullif(c_nationkey, 0) AS VARCHAR), 'null') || ':' || c_mktsegment AS joined FROM customer",
)
def udf_concat(spark, folder):
    registered.register(spark)
    return spark.sql(
        "SELECT c_custkey, concat_long_string(nullif(c_nationkey, 0), c_mktsegment, ':') AS joined FROM {people}",
        people=table(spark, folder, "customer"),
    )


@query("udf_salt_roundtrip", "SELECT o_orderkey, o_orderpriority AS plain, TRUE AS in_range FROM orders")
def udf_salt_roundtrip(spark, folder):
    registered.register(spark)
    return spark.sql(
        """SELECT o_orderkey, remove_random_prefix(salted) AS plain,
                  CAST(split_part(salted, '_', 1) AS INT) BETWEEN 0 AND 9 AS in_range
           FROM (SELECT o_orderkey, random_prefix(o_orderpriority, o_orderkey, 10) AS salted FROM {deals})""",
        deals=table(spark, folder, "orders"),
    )


@query(
    "group_concat_distinct",
    """SELECT c_mktsegment, string_agg(DISTINCT n_nationkey || ':' || n_name, ',' ORDER BY n_nationkey || ':' || n_name) AS cities
       FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""",
)
def group_concat_distinct(spark, folder):
    customer, nation = table(spark, folder, "customer"), table(spark, folder, "nation")
    joined = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    label = F.concat_ws(":", "n_nationkey", "n_name")
    return joined.groupBy("c_mktsegment").agg(registered.group_concat_distinct(label).alias("cities"))
