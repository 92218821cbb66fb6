"""Streaming queries. Each reads a given table as a stream, runs the job to the end of what has arrived, and reads
the tables the job left. What depends on several batches is tested with arrivals in parts."""

from pyspark.sql import functions as F

from clickweave.plans import views
from clickweave.plans.registry import query
from clickweave.plans.views import table
from clickweave.sinks.writers import BatchLog
from clickweave.streaming import ads, feeds, state, words
from clickweave.workspace import fresh_dir

THRESHOLD = 2


def _log(spark, label, schema, keys, how="totals", day=None):
    return BatchLog(spark, fresh_dir(spark, label), schema, keys, how, day=day)


def _table_stream(spark, folder, name):
    return feeds.table_stream(spark, folder, name, views.TABLES[name])


_PLAIN_WORDS = "SELECT unnest(string_split(text, ' ')) AS word FROM documents"


@query("st_file_wordcount", f"SELECT word, count(*) AS n FROM ({_PLAIN_WORDS}) WHERE word <> '' GROUP BY 1")
def st_file_wordcount(spark, folder):
    log = _log(spark, "words", "word string, n long", ["word"])
    stream = _table_stream(spark, folder, "documents")
    words.count_per_batch(stream, F.split("text", " "), log, fresh_dir(spark, "checkpoint"))
    return log.totals()


@query(
    "st_kafka_decode",
    views.sql("ad_clicks") + """SELECT date_trunc('millisecond', ts) AS ts, replace(province, ' ', '_') AS province, city, user_id, ad_id
    FROM ad_clicks""",
)
def st_kafka_decode(spark, folder):
    line = F.concat_ws(
        " ", F.unix_millis(F.col("ts").cast("timestamp")), F.replace("province", F.lit(" "), F.lit("_")), "city", "user_id", "ad_id"
    )
    records = views.ad_clicks(spark, folder).select(
        F.col("event_id").cast("string").cast("binary").alias("key"), line.cast("binary").alias("value"), F.lit("ads").alias("topic"),
        F.lit(0).alias("partition"), F.col("event_id").alias("offset"), F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
    arrived, out = fresh_dir(spark, "kafka"), fresh_dir(spark, "decoded")
    records.write.parquet(arrived)
    stream = feeds.files(spark, arrived, feeds.KAFKA_SCHEMA)
    decoded = feeds.parse_ad_log(feeds.decode_kafka(stream)).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    words.append_files(decoded, out, fresh_dir(spark, "checkpoint"))
    return spark.read.schema(decoded.schema).parquet(out)


_RUNNING = "SELECT event_type, user_id, count(*) AS n FROM events GROUP BY 1, 2"


@query("st_running_count", _RUNNING)
def st_running_count(spark, folder):
    log = _log(spark, "running", "event_type string, user_id long, n long", ["event_type", "user_id"], "latest")
    words.running_counts(_table_stream(spark, folder, "events"), ["event_type", "user_id"], log, fresh_dir(spark, "checkpoint"))
    return log.latest()


@query("st_running_count_sink", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def st_running_count_sink(spark, folder):
    log = _log(spark, "running", "event_type string, n long", ["event_type"], "latest")
    words.running_counts(_table_stream(spark, folder, "events"), ["event_type"], log, fresh_dir(spark, "checkpoint"))
    return log.latest()


_SEARCHES = """searches AS (SELECT ts, 'kw' || (CAST(json_extract_string(props, '$.k') AS INTEGER) % 10) AS word FROM events
    WHERE event_type = 'view')"""
# 60-second windows that start every 10 seconds: each row is in six of them.
_WINDOWS = """(SELECT make_timestamp((epoch_us(ts) // 10000000 - i) * 10000000) AS window_start, *
    FROM {0}, (SELECT unnest(range(6)) AS i))"""
_WINDOW_COUNTS = f"""counts AS (SELECT window_start, word, count(*) AS n FROM {_WINDOWS.format('searches')} GROUP BY 1, 2)"""


def _searches(stream):
    k = F.get_json_object("props", "$.k").cast("int")
    return stream.where("event_type = 'view'").select("ts", F.concat(F.lit("kw"), k % 10).alias("word"))


@query("st_window_counts", f"WITH {_SEARCHES}, {_WINDOW_COUNTS} SELECT * FROM counts")
def st_window_counts(spark, folder):
    log = _log(spark, "windows", "window_start timestamp_ntz, word string, n long", ["window_start", "word"], "latest", "window_start")
    stream = _searches(_table_stream(spark, folder, "events"))
    counts = words.windowed_counts(stream, "ts", ["word"], "60 seconds", "10 seconds", "10 minutes")
    feeds.each_batch(counts, log.write, fresh_dir(spark, "checkpoint"), "update")
    return log.latest()


@query(
    "st_window_top3",
    f"""WITH {_SEARCHES}, {_WINDOW_COUNTS} SELECT * FROM (SELECT *, CAST(row_number() OVER
    (PARTITION BY window_start ORDER BY n DESC, word) AS INTEGER) AS rank FROM counts) WHERE rank <= 3""",
)
def st_window_top3(spark, folder):
    schema = "window_start timestamp_ntz, word string, n long"
    log = _log(spark, "windows", schema, ["window_start", "word"], "latest", "window_start")
    top = _log(spark, "window-top", f"{schema}, rank int", ["window_start", "rank"], "latest", "window_start")
    stream = _searches(_table_stream(spark, folder, "events"))
    counts = words.windowed_counts(stream, "ts", ["word"], "60 seconds", "10 seconds", "10 minutes")
    words.windowed_top(counts, [], "word", 3, log, top, fresh_dir(spark, "checkpoint"))
    return top.latest()


_PRODUCT_CLICKS = """clicks AS (SELECT ts, event_id % 100 AS product_id,
    CAST(json_extract_string(props, '$.k') AS INTEGER) % 5 AS category_id FROM events WHERE event_type = 'click')"""


@query(
    "st_top3_product",
    f"""WITH {_PRODUCT_CLICKS}, counts AS (SELECT window_start, category_id, product_id, count(*) AS n
        FROM {_WINDOWS.format('clicks')} GROUP BY 1, 2, 3)
    SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY window_start, category_id ORDER BY n DESC, product_id) AS INTEGER)
        AS rank FROM counts) WHERE rank <= 3""",
)
def st_top3_product(spark, folder):
    schema = "window_start timestamp_ntz, category_id int, product_id long, n long"
    log = _log(spark, "product-windows", schema, ["window_start", "category_id", "product_id"], "latest", "window_start")
    top = _log(spark, "product-top", f"{schema}, rank int", ["window_start", "category_id", "rank"], "latest", "window_start")
    k = F.get_json_object("props", "$.k").cast("int")
    clicks = _table_stream(spark, folder, "events").where("event_type = 'click'").select(
        "ts", (k % 5).alias("category_id"), (F.col("event_id") % 100).alias("product_id")
    )
    counts = words.windowed_counts(clicks, "ts", ["category_id", "product_id"], "60 seconds", "10 seconds", "10 minutes")
    words.windowed_top(counts, ["category_id"], "product_id", 3, log, top, fresh_dir(spark, "checkpoint"))
    return top.latest()


@query(
    "st_blacklist_static",
    "SELECT event_id, user_id FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)",
)
def st_blacklist_static(spark, folder):
    listed = table(spark, folder, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("user_id"))
    stream = _table_stream(spark, folder, "events").select("event_id", "user_id")
    log = _log(spark, "kept", "event_id long, user_id long", ["event_id"], "rows")
    words.drop_listed(stream, listed, "user_id", log, fresh_dir(spark, "checkpoint"))
    return log.rows().select("event_id", "user_id")


# All clicks arrive in one batch, so users over the threshold are listed for the next one and their clicks count.
_ARRIVED = f"""dated AS (SELECT *, strftime(ts, '%Y-%m-%d') AS date FROM ad_clicks),
    over AS (SELECT DISTINCT user_id FROM (SELECT user_id FROM dated GROUP BY user_id, date, ad_id HAVING count(*) >= {THRESHOLD}))"""


def _click_stream(spark, folder):
    return views.ad_click_columns(_table_stream(spark, folder, "events"), views.cities(spark, folder))


def _ad_tables(spark, folder):
    tables = ads.AdTables.under(spark, fresh_dir(spark, "ads"))
    ads.ad_job(_click_stream(spark, folder), tables, THRESHOLD, fresh_dir(spark, "checkpoint"))
    return tables


@query("st_blacklist_dynamic", views.sql("ad_clicks", extra=_ARRIVED) + "SELECT user_id FROM over")
def st_blacklist_dynamic(spark, folder):
    return _ad_tables(spark, folder).blacklist.rows().select("user_id")


@query(
    "st_user_ad_counts",
    views.sql("ad_clicks", extra=_ARRIVED) + "SELECT date, user_id, ad_id, count(*) AS clicks FROM dated GROUP BY ALL",
)
def st_user_ad_counts(spark, folder):
    return _ad_tables(spark, folder).user_counts.totals()


@query(
    "st_ad_stat",
    views.sql("ad_clicks", extra=_ARRIVED) + "SELECT date, province, city, ad_id, count(*) AS clicks FROM dated GROUP BY ALL",
)
def st_ad_stat(spark, folder):
    return _ad_tables(spark, folder).ad_stat.totals()


@query(
    "st_province_top3",
    views.sql("ad_clicks", extra=_ARRIVED) + """SELECT * FROM (SELECT *, CAST(row_number() OVER
    (PARTITION BY date, province ORDER BY clicks DESC, ad_id) AS INTEGER) AS rank FROM
    (SELECT date, province, ad_id, count(*) AS clicks FROM dated GROUP BY ALL)) WHERE rank <= 3""",
)
def st_province_top3(spark, folder):
    return _ad_tables(spark, folder).province_top.latest()


PARTS = 3  # arrivals of whole days
_ARRIVALS = f"""dated AS (SELECT *, strftime(ts, '%Y-%m-%d') AS date, least(CAST(floor(date_diff('day', (SELECT min(ts) FROM ad_clicks)::DATE, ts::DATE)
        / ceil((1 + date_diff('day', (SELECT min(ts) FROM ad_clicks)::DATE, (SELECT max(ts) FROM ad_clicks)::DATE)) / {PARTS}.0)) AS BIGINT), {PARTS - 1}) AS part
        FROM ad_clicks),
    over AS (SELECT user_id, date, part FROM dated GROUP BY user_id, date, part, ad_id HAVING count(*) >= {THRESHOLD}),
    first AS (SELECT user_id, min(part) AS part FROM over GROUP BY 1),
    listed AS (SELECT user_id, part, min(date) AS listed_on FROM over JOIN first USING (user_id, part) GROUP BY 1, 2)"""


@query(
    "st_blacklist_state",
    views.sql("ad_clicks", extra=_ARRIVALS) + """SELECT user_id, listed_on, count(*) FILTER (listed.part IS NULL OR dated.part <= listed.part) AS kept
    FROM dated LEFT JOIN listed USING (user_id) GROUP BY 1, 2""",
)
def st_blacklist_state(spark, folder):
    """The clicks arrive in three parts of whole days, so users listed by a part are dropped from the next ones."""
    clicks = views.ad_clicks(spark, folder)
    arrived, checkpoint = fresh_dir(spark, "arrived"), fresh_dir(spark, "checkpoint")
    decided = _log(spark, "decided", state.DECISION, ["kind", "event_id"], "rows")
    low, high = clicks.agg(F.min(F.to_date("ts")), F.max(F.to_date("ts"))).first()
    days = -(-((high - low).days + 1) // PARTS) if low else 1
    part = F.floor(F.date_diff(F.to_date("ts"), F.lit(low).cast("date")) / days)
    for i in range(PARTS):
        clicks.where(part == i).write.mode("append").parquet(arrived)
        stream = feeds.files(spark, arrived, clicks.schema)
        with state.rocksdb_state(spark):
            feeds.each_batch(state.judged(stream, THRESHOLD), decided.write, checkpoint)
    made = decided.rows()
    listed_on = F.max(F.when(F.col("kind") == "listed", F.col("date"))).alias("listed_on")
    return made.groupBy(F.col("user_id").cast("long").alias("user_id")).agg(listed_on, F.count_if(F.col("kind") == "kept").alias("kept"))


def _clicks_log(spark, label):
    return _log(spark, label, "window_start timestamp_ntz, ad_id int, n long", ["window_start", "ad_id"], "latest", "window_start")


@query(
    "st_click_trend",
    views.sql("ad_clicks") + """SELECT strftime(ts, '%Y%m%d') AS date, strftime(ts, '%H') AS hour, strftime(ts, '%M') AS minute,
    ad_id, count(*) AS clicks FROM ad_clicks GROUP BY ALL""",
)
def st_click_trend(spark, folder):
    log = _clicks_log(spark, "trend")
    ads.click_trend(_click_stream(spark, folder), log, fresh_dir(spark, "checkpoint"))
    parts = {"date": "yyyyMMdd", "hour": "HH", "minute": "mm"}
    return log.latest().select(
        *[F.date_format("window_start", pattern).alias(name) for name, pattern in parts.items()], "ad_id", F.col("n").alias("clicks")
    )


@query(
    "st_click_hour_total",
    views.sql("ad_clicks") + """, slides AS (SELECT make_timestamp((epoch_us(ts) // 10000000 + 1) * 10000000) AS e, ad_id FROM ad_clicks),
    changes AS (SELECT e AS window_end, ad_id, 1 AS change FROM slides UNION ALL SELECT e + INTERVAL 1 HOUR, ad_id, -1 FROM slides),
    per_end AS (SELECT window_end, ad_id, sum(change) AS change FROM changes GROUP BY ALL)
    SELECT window_end, ad_id, CAST(sum(change) OVER (PARTITION BY ad_id ORDER BY window_end) AS BIGINT) AS clicks FROM per_end""",
)
def st_click_hour_total(spark, folder):
    log = _clicks_log(spark, "slides")
    ads.clicks_per(_click_stream(spark, folder), log, fresh_dir(spark, "checkpoint"), "10 seconds")
    return ads.hour_totals(log.latest())


# A table's end closes the windows that end ten minutes before its last click.
@query(
    "st_click_sliding",
    views.sql("ad_clicks") + """, panes AS (SELECT make_timestamp((epoch_us(ts) // 10000000) * 10000000) AS p, ad_id, count(*) AS n FROM ad_clicks GROUP BY ALL),
    sums AS (SELECT p + to_seconds(10 * i) AS window_end, ad_id, CAST(sum(n) AS BIGINT) AS clicks
        FROM panes, (SELECT unnest(range(1, 361)) AS i) GROUP BY ALL)
    SELECT * FROM sums WHERE window_end <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM ad_clicks)""",
)
def st_click_sliding(spark, folder):
    log = _log(spark, "sliding", ads.SLIDING_SCHEMA, ["window_end", "ad_id"], "rows", "window_end")
    ads.sliding_totals(_click_stream(spark, folder), log, fresh_dir(spark, "checkpoint"))
    return log.rows().drop("batch_id")


@query("st_restart_exactly_once", "SELECT event_type AS word, count(*) AS n FROM events GROUP BY 1")
def st_restart_exactly_once(spark, folder):
    log = _log(spark, "restarts", "word string, n long", ["word"])
    checkpoint = fresh_dir(spark, "checkpoint")
    for _ in range(2):  # the second run finds nothing new
        words.count_per_batch(_table_stream(spark, folder, "events"), F.split("event_type", " "), log, checkpoint)
    return log.totals()
