"""Session analysis: roll-up, filter, statistics, stratified extract, hot categories."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from clickweave.functions.scalars import seconds_between
from clickweave.operators.aggregates import counts_per_kind, id_list, one_id
from clickweave.operators.joins import with_partner
from clickweave.operators.ordering import top_per_group, top_rows
from clickweave.workspace import stored

# Bucket name, lowest and highest whole second of a visit (no limit: None).
VISIT_BUCKETS = (
    ("1s_3s", 1, 3), ("4s_6s", 4, 6), ("7s_9s", 7, 9), ("10s_30s", 10, 30), ("30s_60s", 31, 60),
    ("1m_3m", 61, 180), ("3m_10m", 181, 600), ("10m_30m", 601, 1800), ("30m", 1801, None),
)
# Bucket name, fewest and most steps of a session.
STEP_BUCKETS = (("1_3", 1, 3), ("4_6", 4, 6), ("7_9", 7, 9), ("10_30", 10, 30), ("30_60", 31, 60), ("60", 61, None))


def roll_up(actions: DataFrame, users: DataFrame) -> DataFrame:
    """One row per session with its user: keywords, clicked categories, start, end, length, steps."""
    sessions = actions.groupBy("session_id").agg(
        F.min("user_id").alias("user_id"),
        F.array_sort(F.collect_set("search_keyword")).alias("search_keywords"),
        F.array_sort(F.collect_set("click_category_id")).alias("click_category_ids"),
        F.min("action_time").alias("start_time"),
        F.max("action_time").alias("end_time"),
        F.count("*").alias("step_length"),
    )
    lengths = sessions.withColumn("visit_length", seconds_between("end_time", "start_time"))
    return lengths.join(users.select("user_id", "age", "professional", "city", "sex"), "user_id")


def _items(value) -> list[str]:
    return [v for v in (value.split(",") if isinstance(value, str) else value) if v != ""]


def matches(params: Mapping[str, object]) -> Column:
    """Condition of the session filter. A parameter that is missing or empty does not restrict;
    a session without the value asked for does not match."""
    conditions = [F.lit(True)]
    low, high = params.get("startAge"), params.get("endAge")
    if low and high:
        conditions.append(F.col("age").between(int(low), int(high)))
    for name, column in (("professionals", "professional"), ("cities", "city")):
        if params.get(name):
            conditions.append(F.col(column).isin(_items(params[name])))
    if params.get("sex"):
        conditions.append(F.col("sex") == params["sex"])
    if params.get("keywords"):
        wanted = F.array(*[F.lit(k) for k in _items(params["keywords"])])
        conditions.append(F.arrays_overlap("search_keywords", wanted))
    if params.get("categoryIds"):
        wanted = F.array(*[F.lit(int(c)).cast("long") for c in _items(params["categoryIds"])])
        conditions.append(F.arrays_overlap("click_category_ids", wanted))
    out = conditions[0]
    for condition in conditions[1:]:
        out = out & condition
    return out


def matching_sessions(sessions: DataFrame, params: Mapping[str, object]) -> DataFrame:
    return sessions.where(matches(params))


def _share(value: Column, low: int, high: int | None) -> Column:
    inside = value >= low if high is None else value.between(low, high)
    return F.round(F.try_divide(F.count_if(inside), F.count("*")), 2)


def statistics(sessions: DataFrame, visit_length: Column | None = None) -> DataFrame:
    """One row: number of sessions and the share in each visit-length and step-length bucket.

    A visit of zero seconds is counted in the total but is in no bucket.
    """
    length = F.col("visit_length") if visit_length is None else visit_length
    return sessions.agg(
        F.count("*").alias("session_count"),
        *[_share(length, low, high).alias(f"visit_{name}") for name, low, high in VISIT_BUCKETS],
        *[_share(F.col("step_length"), low, high).alias(f"step_{name}") for name, low, high in STEP_BUCKETS],
    )


def hourly_quota(sessions: DataFrame, total: int) -> DataFrame:
    """How many sessions to draw per (date, hour): ``total`` split evenly over days, then by hour share.

    Both divisions are cut to whole numbers. The table has one row per hour of data.
    """
    counts = sessions.groupBy("date", "hour").agg(F.count("*").alias("in_hour"))
    days = counts.agg(F.countDistinct("date").alias("days")).scalar()
    per_day = F.floor(F.lit(total) / days)
    in_day = F.sum("in_hour").over(W.partitionBy("date"))
    quota = F.least(F.floor(F.col("in_hour") / in_day * per_day), F.col("in_hour"))
    return counts.select("date", "hour", quota.alias("quota")).where("quota > 0")


def stratified_extract(sessions: DataFrame, total: int) -> DataFrame:
    """Draw sessions hour by hour. The draw is by md5 of the session id, so it never changes on a retry.

    Sessions are stored once, as both the quotas and the draw read them. No quota exceeds ``total``, so
    ranking stops there, and a hot hour is ranked in parts.
    """
    timed = stored(
        sessions.withColumn("date", F.date_format("start_time", "yyyy-MM-dd")).withColumn(
            "hour", F.date_format("start_time", "HH")
        ),
        "sessions",
    )
    order = [F.md5("session_id"), F.asc("session_id")]
    draw = top_per_group(timed, ["date", "hour"], order, total, "rank", spread=["session_id"])
    chosen = draw.join(hourly_quota(timed, total), ["date", "hour"]).where(F.col("rank") <= F.col("quota"))
    return chosen.drop("quota", "rank")


def details(actions: DataFrame, sessions: DataFrame) -> DataFrame:
    """All actions of the given sessions."""
    return with_partner(actions, sessions, ["session_id"])


def category_counts(actions: DataFrame) -> DataFrame:
    """Click, order and pay counts per category."""
    kinds = {
        "click_count": one_id("click_category_id"),
        "order_count": id_list("order_category_ids"),
        "pay_count": id_list("pay_category_ids"),
    }
    return counts_per_kind(actions, kinds, "category_id")


def top_categories(actions: DataFrame, n: int = 10) -> DataFrame:
    order = [F.desc("click_count"), F.desc("order_count"), F.desc("pay_count"), F.asc("category_id")]
    return top_rows(category_counts(actions), order, n)


def top_sessions_per_category(actions: DataFrame, categories: DataFrame, n: int = 10) -> DataFrame:
    """The sessions with most clicks in each of ``categories``, a top list whose length is a parameter."""
    clicks = (
        actions.where(F.col("click_category_id").isNotNull())
        .groupBy(F.col("click_category_id").alias("category_id"), "session_id")
        .agg(F.count("*").alias("click_count"))
    )
    wanted = clicks.join(F.broadcast(categories.select("category_id")), "category_id")
    return top_per_group(wanted, ["category_id"], [F.desc("click_count"), F.asc("session_id")], n)


def task_parameters(tasks: DataFrame, names: Sequence[str]) -> DataFrame:
    """Parameters of each task: every value of the JSON object is an array, its first element counts."""
    schema = ", ".join(f"{name} array<string>" for name in names)
    parsed = tasks.withColumn("_p", F.from_json("task_param", schema))
    return parsed.select("task_id", *[F.get(F.col("_p")[name], F.lit(0)).alias(name) for name in names])


def parameters_of(tasks: DataFrame, task_id: int, names: Sequence[str]) -> dict[str, str]:
    """Parameters of one task, looked up by its id: a single row."""
    row = task_parameters(tasks.where(F.col("task_id") == task_id), names).first()
    return {} if row is None else {k: v for k, v in row.asDict().items() if k != "task_id" and v is not None}
