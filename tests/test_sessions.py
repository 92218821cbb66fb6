import datetime as dt

import pytest
from pyspark.sql import functions as F

from clickweave.operators import funnel, sessions
from clickweave.operators.products import area_top_products
from conftest import rows

T0 = dt.datetime(2024, 1, 1, 10, 0, 0)

ACTIONS = (
    "session_id string, user_id long, action_time timestamp_ntz, event_id long, page_id long, search_keyword string, "
    "click_category_id long, order_category_ids string, pay_category_ids string"
)


def action(session, second, event, page=1, keyword=None, click=None, order=None, pay=None, user=1):
    return (session, user, T0 + dt.timedelta(seconds=second), event, page, keyword, click, order, pay)


@pytest.fixture(scope="module")
def users(spark):
    return spark.createDataFrame(
        [(1, 30, "IT", "Rome", "male"), (2, 70, "farmer", "Oslo", "female")],
        "user_id long, age int, professional string, city string, sex string",
    )


def test_roll_up(spark, users):
    actions = spark.createDataFrame(
        [
            action("s1", 0, 1, keyword="cake"), action("s1", 12.9, 2, click=12), action("s1", 5, 3, click=1),
            action("s1", 6, 4, click=1), action("s1", 7, 5, keyword="cake"), action("s2", 3, 6, user=2), action("s3", 3, 7, user=9),
        ],
        ACTIONS,
    )
    got = {r.session_id: r for r in sessions.roll_up(actions, users).collect()}
    assert set(got) == {"s1", "s2"}  # a session of an unknown user is dropped
    s1, s2 = got["s1"], got["s2"]
    assert (list(s1.search_keywords), list(s1.click_category_ids)) == (["cake"], [1, 12])
    assert (s1.visit_length, s1.step_length, s2.visit_length, s2.step_length) == (12, 5, 0, 1)


SESSIONS = "session_id string, visit_length long, step_length long"


def test_bucket_edges(spark):
    lengths = [0, 1, 3, 4, 6, 7, 9, 10, 30, 31, 60, 61, 180, 181, 600, 601, 1800, 1801]
    steps = [1, 3, 4, 6, 7, 9, 10, 30, 31, 60, 61, 61, 61, 61, 61, 61, 61, 61]
    df = spark.createDataFrame([(str(i), a, b) for i, (a, b) in enumerate(zip(lengths, steps))], SESSIONS)
    got = sessions.statistics(df).first().asDict()
    assert got["session_count"] == 18
    assert all(got[f"visit_{name}"] == 0.11 for name, _, high in sessions.VISIT_BUCKETS if high)
    assert got["visit_30m"] == 0.06
    assert [got[f"step_{name}"] for name, _, high in sessions.STEP_BUCKETS if high] == [0.11] * 5
    assert got["step_60"] == 0.44


def test_statistics_of_no_session(spark):
    got = sessions.statistics(spark.createDataFrame([], SESSIONS)).first().asDict()
    assert got.pop("session_count") == 0 and set(got.values()) == {None}


def test_filter_parameters(spark):
    df = spark.createDataFrame(
        [
            ("a", 30, "IT", "Rome", "male", ["cake", "tea"], [1, 2]),
            ("b", 30, "IT", None, "male", [], []),
            ("c", None, "cook", "Oslo", "female", ["tea"], [2]),
        ],
        "session_id string, age int, professional string, city string, sex string, search_keywords array<string>, click_category_ids array<long>",
    )

    def kept(**params):
        return [r[0] for r in rows(sessions.matching_sessions(df, params), "session_id")]

    assert kept() == ["a", "b", "c"]
    assert kept(startAge="20") == ["a", "b", "c"]  # an open range does not restrict
    assert kept(startAge="20", endAge="30") == ["a", "b"]
    assert kept(cities="Rome,Oslo") == ["a", "c"]  # no city, no match
    assert kept(keywords="tea,beer") == ["a", "c"]
    assert kept(keywords="") == ["a", "b", "c"]
    assert kept(categoryIds="1", sex="male") == ["a"]
    assert kept(professionals=["cook"]) == ["c"]


def test_task_parameters(spark):
    tasks = spark.createDataFrame(
        [(1, '{"startAge":["10","x"],"sex":[]}'), (2, "broken"), (3, None)], "task_id int, task_param string"
    )
    got = {r.task_id: (r.startAge, r.sex) for r in sessions.task_parameters(tasks, ["startAge", "sex"]).collect()}
    assert got == {1: ("10", None), 2: (None, None), 3: (None, None)}
    assert sessions.parameters_of(tasks, 1, ["startAge", "sex"]) == {"startAge": "10"}
    assert sessions.parameters_of(tasks, 9, ["startAge"]) == {}


def test_extract_follows_the_hour_shares(spark):
    made = [(f"s{i}", T0 + dt.timedelta(hours=(0 if i < 60 else 1 if i < 90 else 26))) for i in range(100)]
    df = spark.createDataFrame(made, "session_id string, start_time timestamp_ntz")
    quota = {(r.date, r.hour): r.quota for r in sessions.hourly_quota(
        df.select(F.date_format("start_time", "yyyy-MM-dd").alias("date"), F.date_format("start_time", "HH").alias("hour")), 41
    ).collect()}
    assert quota == {("2024-01-01", "10"): 13, ("2024-01-01", "11"): 6, ("2024-01-02", "12"): 10}  # 20 a day, capped at 10
    drawn = sessions.stratified_extract(df, 41)
    assert {(r.date, r.hour): r.n for r in drawn.groupBy("date", "hour").agg(F.count("*").alias("n")).collect()} == quota
    assert rows(drawn, "session_id") == rows(sessions.stratified_extract(df, 41), "session_id")


def test_categories(spark):
    actions = spark.createDataFrame(
        [
            action("s1", 0, 1, click=5), action("s1", 1, 2, click=5), action("s2", 1, 3, click=5), action("s2", 1, 4, click=6),
            action("s2", 2, 5, order="6,7"), action("s2", 3, 6, pay="7"), action("s2", 4, 7, keyword="x"),
        ],
        ACTIONS,
    )
    assert rows(sessions.category_counts(actions)) == [(5, 3, 0, 0), (6, 1, 1, 0), (7, 0, 1, 1)]
    top = sessions.top_categories(actions, 2)
    assert [r.category_id for r in top.collect()] == [5, 6]
    assert rows(sessions.top_sessions_per_category(actions, top, 1), "category_id", "session_id", "click_count") == [
        (5, "s1", 2), (6, "s2", 1),
    ]


def test_page_flow(spark):
    visits = [("a", 1), ("a", 2), ("a", 3), ("b", 1), ("b", 2), ("b", 1), ("c", 2), ("c", 3), ("d", 1)]
    actions = spark.createDataFrame([action(s, i, i, page=p) for i, (s, p) in enumerate(visits)], ACTIONS)
    rates = funnel.conversion_rates(actions, [1, 2, 3, 4, 5])
    assert [(r.pair, r.hits, r.rate) for r in rates.orderBy("step").collect()] == [
        ("1_2", 2, 0.5), ("2_3", 2, 1.0), ("3_4", 0, 0.0), ("4_5", 0, None),
    ]
    assert funnel.rate_string(rates).first()[0] == "1_2=0.5|2_3=1.0|3_4=0.0|4_5=null"


def test_one_long_session_is_spread(spark):
    long = spark.range(0, 4000).select(
        F.lit("hot").alias("session_id"), F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, CAST(id div 3 AS DECIMAL(18,6)))").alias("action_time"),
        F.col("id").alias("event_id"), (F.col("id") % 3).alias("page_id"),
    )
    assert rows(funnel.page_pairs(long)) == [(0, 1, 1333), (1, 2, 1333), (2, 0, 1333)]


def test_area_top_products_ties_and_levels(spark):
    clicks = spark.createDataFrame([(1, 10), (1, 10), (2, 11), (2, 12), (1, 13), (3, 10), (1, None)], "city_id long, click_product_id long")
    cities = spark.createDataFrame([(1, "x", "North"), (2, "y", "North"), (3, "z", "South")], "city_id long, city_name string, area string")
    products = spark.createDataFrame(
        [(p, f"p{p}", '{"product_status": %d}' % (p % 2)) for p in range(10, 14)], "product_id long, product_name string, extend_info string"
    )
    top = area_top_products(clicks, cities, products, {"North": "A Level"}, "D Level")
    got = rows(top, "area", "area_level", "rank", "product_id", "click_count", "city_infos", "product_status")
    assert got == [
        ("North", "A Level", 1, 10, 2, "1:x", "Self"), ("North", "A Level", 2, 11, 1, "2:y", "Third Party"),
        ("North", "A Level", 3, 12, 1, "2:y", "Self"), ("South", "D Level", 1, 10, 1, "3:z", "Self"),
    ]
