"""Session analysis and page flow."""

from pyspark.sql import functions as F

from clickweave.operators import funnel, sessions
from clickweave.plans import views
from clickweave.plans.registry import query
from clickweave.plans.views import table
from clickweave.workspace import stored

FIRST, LAST = "2024-01-02", "2024-01-28"
AGES = {"startAge": "20", "endAge": "60"}
FILTER = AGES | {"professionals": "BUILDING,MACHINERY,HOUSEHOLD", "sex": "male", "keywords": "kw1,kw3,kw5,kw7"}
VISIT_UNIT = 30  # seconds per unit of the visit-length buckets
EXTRACT_TOTAL = 3000
FLOW = [1, 2, 3, 4, 5, 6]
# Names of task parameters.
PARAMETERS = (
    "startDate", "endDate", "startAge", "endAge", "professionals", "cities", "sex", "keywords", "categoryIds", "targetPageFlow"
)

_ROLLUP = """rolled AS (SELECT session_id, min(user_id) AS user_id,
        list_sort(list(DISTINCT search_keyword) FILTER (search_keyword IS NOT NULL)) AS keywords,
        list_sort(list(DISTINCT click_category_id) FILTER (click_category_id IS NOT NULL)) AS categories,
        min(action_time) AS start_time, max(action_time) AS end_time, count(*) AS step_length
    FROM actions GROUP BY session_id),
    sessions AS (SELECT r.*, (epoch_us(end_time) - epoch_us(start_time)) // 1000000 AS visit_length,
        age, professional, city, sex FROM rolled r JOIN users USING (user_id))"""
_SESSION_COLUMNS = """session_id, user_id, coalesce(array_to_string(keywords, ','), '') AS search_keywords,
    coalesce(array_to_string(categories, ','), '') AS click_category_ids, start_time, end_time, visit_length, step_length,
    age, professional, city, sex"""
_AGED = "aged AS (SELECT * FROM sessions WHERE age BETWEEN 20 AND 60)"


def _sql(*more: str) -> str:
    return views.sql("actions", "users", extra=", ".join([_ROLLUP, *more]))


def _rolled(spark, folder):
    return sessions.roll_up(views.actions(spark, folder), views.users(spark, folder))


def _aged(spark, folder):
    return sessions.matching_sessions(_rolled(spark, folder), AGES)


def _flat(rolled):
    return rolled.withColumn("search_keywords", F.array_join("search_keywords", ",")).withColumn(
        "click_category_ids", F.array_join("click_category_ids", ",")
    )


@query("actions_by_date", views.sql("actions") + f"SELECT * FROM actions WHERE date BETWEEN '{FIRST}' AND '{LAST}'")
def actions_by_date(spark, folder):
    return views.actions(spark, folder, FIRST, LAST)


_TASKS = """tasks AS (SELECT n_nationkey AS task_id, '{"startAge":["' || (20 + n_nationkey % 3) || '"],"endAge":["50"],"cities":["' ||
    n_name || '","other"]' || CASE WHEN n_nationkey % 2 = 0 THEN ',"sex":["male"]' ELSE ',"keywords":[]' END || '}' AS task_param
    FROM nation)"""


def tasks(spark, folder):
    """One analysis task per nation, its parameters as JSON."""
    return table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("task_id"),
        F.concat(
            F.lit('{"startAge":["'), (F.col("n_nationkey") % 3 + 20).cast("string"), F.lit('"],"endAge":["50"],"cities":["'),
            F.col("n_name"), F.lit('","other"]'),
            F.when(F.col("n_nationkey") % 2 == 0, ',"sex":["male"]').otherwise(',"keywords":[]'), F.lit("}"),
        ).alias("task_param"),
    )


@query(
    "task_params",
    f"WITH {_TASKS} SELECT task_id, " + ", ".join(
        f"json_extract_string(task_param, '$.{p}[0]') AS \"{p}\"" for p in PARAMETERS
    ) + " FROM tasks",
)
def task_params(spark, folder):
    return sessions.task_parameters(tasks(spark, folder), PARAMETERS)


@query("session_rollup", _sql() + f"SELECT {_SESSION_COLUMNS} FROM sessions")
def session_rollup(spark, folder):
    return _flat(_rolled(spark, folder))


@query(
    "session_filter",
    _sql() + f"""SELECT {_SESSION_COLUMNS} FROM sessions WHERE age BETWEEN 20 AND 60 AND sex = 'male'
    AND professional IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD') AND list_has_any(keywords, ['kw1', 'kw3', 'kw5', 'kw7'])""",
)
def session_filter(spark, folder):
    return _flat(sessions.matching_sessions(_rolled(spark, folder), FILTER))


@query(
    "task_sessions",
    _sql() + f"""SELECT {_SESSION_COLUMNS} FROM sessions WHERE age BETWEEN 21 AND 50 AND city IN ('NATION_4') AND sex = 'male'""",
)
def task_sessions(spark, folder):
    params = sessions.parameters_of(tasks(spark, folder), 4, PARAMETERS)
    return _flat(sessions.matching_sessions(_rolled(spark, folder), params))


def _sql_share(value, low, high):
    inside = f"{value} >= {low}" if high is None else f"{value} BETWEEN {low} AND {high}"
    return f"round(count(*) FILTER ({inside}) / count(*), 2)"


@query(
    "session_stats",
    _sql(_AGED) + "SELECT count(*) AS session_count, "
    + ", ".join(
        [f'{_sql_share(f"(visit_length // {VISIT_UNIT})", a, b)} AS "visit_{n}"' for n, a, b in sessions.VISIT_BUCKETS]
        + [f'{_sql_share("step_length", a, b)} AS "step_{n}"' for n, a, b in sessions.STEP_BUCKETS]
    ) + " FROM aged",
)
def session_stats(spark, folder):
    return sessions.statistics(_aged(spark, folder), F.floor(F.col("visit_length") / VISIT_UNIT))


_EXTRACT = f"""timed AS (SELECT *, strftime(start_time, '%Y-%m-%d') AS date, strftime(start_time, '%H') AS hour FROM aged),
    hours AS (SELECT date, hour, count(*) AS in_hour FROM timed GROUP BY 1, 2),
    quotas AS (SELECT date, hour, least(CAST(floor(in_hour / sum(in_hour) OVER (PARTITION BY date)
        * ({EXTRACT_TOTAL} // (SELECT count(DISTINCT date) FROM hours))) AS BIGINT), in_hour) AS quota FROM hours),
    drawn AS (SELECT t.* FROM (SELECT *, row_number() OVER (PARTITION BY date, hour ORDER BY md5(session_id), session_id) AS rn
        FROM timed) t JOIN quotas q ON t.date = q.date AND t.hour = q.hour WHERE rn <= quota)"""


@query("session_extract", _sql(_AGED, _EXTRACT) + f"SELECT date, hour, {_SESSION_COLUMNS} FROM drawn")
def session_extract(spark, folder):
    return _flat(sessions.stratified_extract(_aged(spark, folder), EXTRACT_TOTAL))


@query(
    "session_extract_detail",
    _sql(_AGED, _EXTRACT) + "SELECT * FROM actions WHERE session_id IN (SELECT session_id FROM drawn)",
)
def session_extract_detail(spark, folder):
    drawn = sessions.stratified_extract(_aged(spark, folder), EXTRACT_TOTAL)
    return sessions.details(views.actions(spark, folder), drawn)


_MATCHED = "matched AS (SELECT * FROM actions WHERE session_id IN (SELECT session_id FROM aged))"


@query("session_detail", _sql(_AGED, _MATCHED) + "SELECT * FROM matched")
def session_detail(spark, folder):
    return _matched(spark, folder)


def _matched(spark, folder):
    return sessions.details(views.actions(spark, folder), _aged(spark, folder))


_TOP = """hits AS (SELECT 'click' AS kind, click_category_id AS category_id FROM matched WHERE click_category_id IS NOT NULL
        UNION ALL SELECT 'order', CAST(unnest(string_split(order_category_ids, ',')) AS BIGINT) FROM matched
        UNION ALL SELECT 'pay', CAST(unnest(string_split(pay_category_ids, ',')) AS BIGINT) FROM matched),
    top AS (SELECT category_id, count(*) FILTER (kind = 'click') AS click_count, count(*) FILTER (kind = 'order') AS order_count,
        count(*) FILTER (kind = 'pay') AS pay_count FROM hits GROUP BY 1 ORDER BY 2 DESC, 3 DESC, 4 DESC, 1 LIMIT 10)"""
_TOP_SESSIONS = """ranked AS (SELECT category_id, session_id, click_count,
        CAST(row_number() OVER (PARTITION BY category_id ORDER BY click_count DESC, session_id) AS INTEGER) AS rank
        FROM (SELECT click_category_id AS category_id, session_id, count(*) AS click_count FROM matched
              WHERE click_category_id IN (SELECT category_id FROM top) GROUP BY 1, 2))"""


@query("top10_category", _sql(_AGED, _MATCHED, _TOP) + "SELECT * FROM top")
def top10_category(spark, folder):
    return sessions.top_categories(_matched(spark, folder))


def _top_sessions(spark, folder):
    matched = stored(_matched(spark, folder), "matched")  # read for the categories and again for their sessions
    return sessions.top_sessions_per_category(matched, sessions.top_categories(matched))


@query("top10_session", _sql(_AGED, _MATCHED, _TOP, _TOP_SESSIONS) + "SELECT * FROM ranked WHERE rank <= 10")
def top10_session(spark, folder):
    return _top_sessions(spark, folder)


@query(
    "top10_session_detail",
    _sql(_AGED, _MATCHED, _TOP, _TOP_SESSIONS)
    + "SELECT * FROM actions WHERE session_id IN (SELECT session_id FROM ranked WHERE rank <= 10)",
)
def top10_session_detail(spark, folder):
    return sessions.details(views.actions(spark, folder), _top_sessions(spark, folder))


_FLOW = ", ".join(f"({i}, {a}, {b})" for i, (a, b) in enumerate(zip(FLOW, FLOW[1:]), start=1))
_RATES = f"""steps AS (SELECT page_id AS to_page, lag(page_id) OVER (PARTITION BY session_id ORDER BY action_time, event_id) AS from_page
        FROM actions),
    pairs AS (SELECT from_page, to_page, count(*) AS hits FROM steps WHERE from_page IS NOT NULL GROUP BY 1, 2),
    flow(step, a, b) AS (VALUES {_FLOW}),
    flow_hits AS (SELECT step, a || '_' || b AS pair, coalesce(hits, 0) AS hits FROM flow LEFT JOIN pairs ON a = from_page AND b = to_page),
    rates AS (SELECT step, pair, hits, round(hits / nullif(coalesce(lag(hits) OVER (ORDER BY step),
        (SELECT count(*) FROM actions WHERE page_id = {FLOW[0]})), 0), 2) AS rate FROM flow_hits)"""


@query("page_convert_rate", views.sql("actions", extra=_RATES) + "SELECT step, pair, hits, rate FROM rates")
def page_convert_rate(spark, folder):
    return funnel.conversion_rates(views.actions(spark, folder), FLOW)


@query(
    "page_convert_string",
    views.sql("actions", extra=_RATES) + "SELECT string_agg(pair || '=' || rate, '|' ORDER BY step) AS convert_rate FROM rates",
)
def page_convert_string(spark, folder):
    return funnel.rate_string(funnel.conversion_rates(views.actions(spark, folder), FLOW))
