"""Nesting, binning, partitioning, anonymising and chained jobs. Users' keys are shifted, so some posts have no known user."""

from pyspark.sql import functions as F

from clickweave.operators import organize
from clickweave.plans.registry import query
from clickweave.plans.views import table

PAGE_LINES = 5
_LINE_ID = "l_linenumber || '|' || l_partkey || '|' || l_suppkey"


@query(
    "hierarchy_order_lines",
    f"""WITH paged AS (SELECT *, (row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1) // {PAGE_LINES} AS page
                       FROM lineitem),
    lists AS (SELECT l_orderkey, page, string_agg({_LINE_ID}, ',' ORDER BY l_linenumber, l_partkey, l_suppkey) AS lines
              FROM paged GROUP BY 1, 2)
    SELECT o_orderkey, coalesce(page, 0) AS page, o_orderstatus, coalesce(lines, '') AS lines
    FROM orders LEFT JOIN lists ON o_orderkey = l_orderkey""",
)
def hierarchy_order_lines(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    child = ["l_linenumber", "l_partkey", "l_suppkey"]
    lines = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), *child)
    nested = organize.nest_children(orders, lines, "o_orderkey", child, child, PAGE_LINES, "lines")
    as_text = F.transform("lines", lambda s: F.concat_ws("|", *[s[c] for c in child]))
    return nested.select("o_orderkey", "page", "o_orderstatus", F.array_join(as_text, ",").alias("lines"))


_BINS = {
    "en-tag": "lower(lang) = 'en'",
    "fr-tag": "lower(lang) = 'fr'",
    "de-tag": "lower(lang) = 'de'",
    "es-tag": "lower(lang) = 'es'",
    "die-post": "contains(lower(text), 'die')",
}


@query(
    "binning_multi",
    " UNION ALL ".join(f"SELECT doc_id, '{name}' AS bin FROM documents WHERE {test}" for name, test in _BINS.items()),
)
def binning_multi(spark, folder):
    documents = table(spark, folder, "documents")
    bins = {name: F.expr(test) for name, test in _BINS.items()}
    return organize.binned(documents, bins).select("doc_id", "bin")


@query("partition_by_year", "SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders")
def partition_by_year(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"))
    return organize.by_folder(orders, "year", "years", gather=True)


@query(
    "anonymize_shuffle",
    "SELECT CAST(ts AS DATE) AS ts, event_type, value, props FROM events",
)
def anonymize_shuffle(spark, folder):
    return organize.shuffled(organize.anonymized(table(spark, folder, "events"), ["user_id", "event_id"], ["ts"]), 7)


PAGE_ANSWERS = 4


@query(
    "qa_hierarchy",
    f"""WITH q AS (SELECT conv_id, text AS question FROM conversations WHERE turn = 0),
    a AS (SELECT *, (row_number() OVER (PARTITION BY conv_id ORDER BY turn, text) - 1) // {PAGE_ANSWERS} AS page FROM conversations WHERE turn <> 0),
    lists AS (SELECT conv_id, page, string_agg(turn || ':' || text, chr(10) ORDER BY turn, text) AS answers FROM a GROUP BY 1, 2)
    SELECT conv_id, coalesce(page, 0) AS page, question, coalesce(answers, '') AS answers FROM q LEFT JOIN lists USING (conv_id)""",
)
def qa_hierarchy(spark, folder):
    posts = table(spark, folder, "conversations").select("conv_id", "turn", "text")
    nested = organize.question_answers(posts, "conv_id", F.col("turn") == 0, ["turn", "text"], ["conv_id", "turn"], PAGE_ANSWERS)
    answers = F.array_join(F.transform("answers", lambda a: F.concat_ws(":", a["turn"], a["text"])), "\n")
    return nested.select("conv_id", "page", F.col("text").alias("question"), answers.alias("answers"))


@query("coalesced_write", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 450000")
def coalesced_write(spark, folder):
    rare = table(spark, folder, "orders").where("o_totalprice > 450000").select("o_orderkey", "o_totalprice")
    return organize.in_few_files(rare)


_AGAINST = """counts AS (SELECT o_custkey AS user_id, count(*) AS posts FROM orders GROUP BY 1),
    known AS (SELECT c_custkey + 100 AS user_id, c_acctbal AS reputation FROM customer),
    binned AS (SELECT user_id, posts, reputation,
        CASE WHEN posts < (SELECT avg(posts) FROM counts) THEN 'below' ELSE 'above' END AS bin FROM counts LEFT JOIN known USING (user_id))"""


def _posts_and_users(spark, folder):
    posts = table(spark, folder, "orders").select(F.col("o_custkey").alias("user_id"))
    users = table(spark, folder, "customer").select(
        (F.col("c_custkey") + 100).alias("user_id"), F.col("c_acctbal").alias("reputation")
    )
    return posts, users, "user_id"


@query("posts_vs_average", f"WITH {_AGAINST} SELECT * FROM binned")
def posts_vs_average(spark, folder):
    return organize.posts_against_mean(*_posts_and_users(spark, folder))


@query(
    "avg_reputation_by_bin",
    f"WITH {_AGAINST} SELECT bin, count(*) AS users, round(avg(reputation), 4) AS mean_reputation FROM binned GROUP BY 1",
)
def avg_reputation_by_bin(spark, folder):
    return organize.reputation_by_bin(organize.posts_against_mean(*_posts_and_users(spark, folder)))


@query(
    "fold_chain_bins",
    f"""WITH {_AGAINST} SELECT posts, reputation, CAST(sum(posts) AS BIGINT) AS total,
        CASE WHEN reputation < 5000 THEN 'below' ELSE 'above' END AS bin
        FROM counts JOIN known USING (user_id) GROUP BY posts, reputation""",
)
def fold_chain_bins(spark, folder):
    return organize.folded_chain(*_posts_and_users(spark, folder))


@query(
    "merged_anonymize_distinct",
    """SELECT 'anonymized' AS output, '{"ts":"' || strftime(ts, '%Y-%m-%d') || '","event_type":"' || event_type || '"}' AS value FROM events
       UNION ALL SELECT DISTINCT 'distinct', CAST(user_id AS VARCHAR) FROM events WHERE user_id IS NOT NULL""",
)
def merged_anonymize_distinct(spark, folder):
    events = table(spark, folder, "events").select("event_id", "ts", "user_id", "event_type")
    return organize.anonymized_and_distinct(events, "user_id", ["user_id", "event_id"], ["ts"])
