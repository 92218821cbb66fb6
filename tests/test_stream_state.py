"""Clicks judged by the state of each user."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from clickweave.sinks.writers import BatchLog
from clickweave.streaming import ads, feeds, state
from clickweave.workspace import fresh_dir
from conftest import rows
from test_streaming import CLICK, add, click


@pytest.fixture(autouse=True)
def one_partition(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def job(spark):
    return (
        fresh_dir(spark, "in"), fresh_dir(spark, "cp"), ads.AdTables.under(spark, fresh_dir(spark, "ads")),
        state.decision_log(spark, fresh_dir(spark, "decided")),
    )


def test_state_gives_the_tables_of_batch_by_batch_counting_over_restarts(spark):
    batches = [
        [click(i, 1, 7) for i in range(2)] + [click(10, 1, 8), click(11, 1, None), click(12, 1, None)],
        [click(20, 1, 7), click(21, 1, 8, ad=2), click(22, 1, None), click(23, 1, 9, ad=None)],  # user 7 reaches 3 over two batches
        [click(30, 2, 7), click(31, 2, 8)],
        [click(40 + i, 3, 8 + i % 2, ad=i % 2) for i in range(12)] + [click(61, 3, 7)],
    ]
    path, checkpoint, tables, decisions = job(spark)
    counts, listed = {}, set()
    for batch in batches:  # every arrival is a run of its own, from the checkpoint
        add(spark, path, batch, CLICK)
        state.ad_job_by_state(feeds.files(spark, path, CLICK), tables, decisions, 3, checkpoint)
        for _, ts, _, _, user, ad in batch:
            if user not in listed:
                counts[str(ts.date()), user, ad] = counts.get((str(ts.date()), user, ad), 0) + 1
        listed |= {user for (_, user, _), n in counts.items() if n >= 3 and user is not None}
    assert rows(tables.blacklist.rows(), "user_id") == [(7,), (8,), (9,)] == [(u,) for u in sorted(listed)]
    assert rows(tables.user_counts.totals()) == sorted([(*k, n) for k, n in counts.items()], key=repr)
    assert tables.ad_stat.totals().agg(F.sum("clicks")).first()[0] == sum(counts.values())
    best = rows(tables.province_top.latest().where("date = '2024-01-01'"), "rank", "ad_id", "clicks")
    assert best == [(1, 1, 7), (2, 2, 1)]  # an ad without an id is counted, not ranked


def test_days_leave_the_state(spark):
    path, checkpoint, tables, decisions = job(spark)
    held = []
    for day in (1, 3, 5):
        add(spark, path, [click(100 * day + u, day, u) for u in range(6)], CLICK)
        state.ad_job_by_state(feeds.files(spark, path, CLICK), tables, decisions, 3, checkpoint)
        kept = spark.read.format("statestore").option("stateVarName", "counts").load(checkpoint)
        held.append(rows(kept.select("user_map_key.date").distinct()))
    assert held[-1] == [("2024-01-05",)] and all(len(days) <= 2 for days in held)
    # a click later than the watermark is dropped, as its day is gone
    add(spark, path, [click(999, 1, 3)], CLICK)
    state.ad_job_by_state(feeds.files(spark, path, CLICK), tables, decisions, 3, checkpoint)
    assert tables.user_counts.totals().agg(F.sum("clicks")).first()[0] == 18


def test_clicks_without_a_time_and_large_ids(spark):
    path, checkpoint = fresh_dir(spark, "in"), fresh_dir(spark, "cp")
    add(spark, path, [(1, None, "P", "C", 7, 1), (2**60 + 1, dt.datetime(2024, 1, 1), None, None, 7, None)], CLICK)
    log = BatchLog(spark, fresh_dir(spark, "decided"), state.DECISION, ["event_id"], "rows")
    with state.rocksdb_state(spark):
        feeds.each_batch(state.judged(feeds.files(spark, path, CLICK), 3), log.write, checkpoint)
    assert rows(log.rows(), "kind", "event_id", "user_id", "ad_id") == [("kept", str(2**60 + 1), "7", None)]


def test_state_has_a_row_per_bucket_and_day_not_per_user(spark):
    path, checkpoint = fresh_dir(spark, "in"), fresh_dir(spark, "cp")
    users = range(3 * state.BUCKETS)
    log = BatchLog(spark, fresh_dir(spark, "decided"), state.DECISION, ["event_id"], "rows")
    with state.rocksdb_state(spark):
        for first in (0, 10_000):
            add(spark, path, [click(first + u, 1, u) for u in users] + [click(first + 9000, 1, None)], CLICK)
            feeds.each_batch(state.judged(feeds.files(spark, path, CLICK), 2), log.write, checkpoint)
            if not first:
                held = spark.read.format("statestore").option("stateVarName", "counts").load(checkpoint)
                assert held.count() <= state.BUCKETS  # a day's users of a bucket are one row
    made = log.rows()
    assert made.where("kind = 'kept'").count() == 2 * len(users) + 2
    assert made.where("kind = 'listed'").select("user_id").distinct().count() == made.where("kind = 'listed'").count() == len(users)
