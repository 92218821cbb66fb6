import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from clickweave.operators.ordering import top_after_changes
from clickweave.sinks.writers import BatchLog
from clickweave.streaming import ads, feeds, words
from clickweave.workspace import fresh_dir
from conftest import plan, rows
from replay import replay

CLICK = "event_id long, ts timestamp_ntz, province string, city string, user_id long, ad_id int"


def click(event, day, user, ad=1, province="P", second=0):
    return (event, dt.datetime(2024, 1, day, 12) + dt.timedelta(seconds=second), province, "C", user, ad)


def add(spark, path, data, schema):
    spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(path)


def test_restart_counts_every_row_once(spark):
    path, checkpoint = fresh_dir(spark, "in"), fresh_dir(spark, "cp")
    log = BatchLog(spark, fresh_dir(spark, "log"), "word string, n long", ["word"])

    def run():
        words.count_per_batch(feeds.files(spark, path, "line string"), F.split("line", " "), log, checkpoint)

    add(spark, path, [("a b",), ("a",)], "line string")
    run()
    run()
    add(spark, path, [("a c",)], "line string")
    run()
    assert rows(log.totals()) == [("a", 3), ("b", 1), ("c", 1)]
    assert rows(log.rows().where("word = 'a'"), "batch_id", "n") == [(0, 2), (1, 1)]


def test_running_counts_go_on_after_a_restart(spark):
    path, checkpoint = fresh_dir(spark, "in"), fresh_dir(spark, "cp")
    log = BatchLog(spark, fresh_dir(spark, "log"), "k string, n long", ["k"], "latest")
    for data in ([("a",), ("b",)], [("a",)]):
        add(spark, path, data, "k string")
        words.running_counts(feeds.files(spark, path, "k string"), ["k"], log, checkpoint)
    assert rows(log.latest()) == [("a", 2), ("b", 1)]


def test_rows_later_than_the_watermark_are_dropped(spark):
    path, checkpoint = fresh_dir(spark, "in"), fresh_dir(spark, "cp")
    schema = "ts timestamp_ntz, k string"
    log = BatchLog(spark, fresh_dir(spark, "log"), "window_start timestamp_ntz, k string, n long", ["window_start", "k"], "latest")
    base = dt.datetime(2024, 1, 1)
    # The late row comes two batches after the row that moved the watermark past it.
    for hours in (0, 5, 9, 0.01):
        add(spark, path, [(base + dt.timedelta(hours=hours), "a")], schema)
        counts = words.windowed_counts(feeds.files(spark, path, schema), "ts", ["k"], "1 minute", None, "1 hour")
        feeds.each_batch(counts, log.write, checkpoint, "update")
    assert [n for _, n in rows(log.latest(), "window_start", "n")] == [1, 1, 1]


def test_windowed_top_over_two_batches(spark):
    path, checkpoint = fresh_dir(spark, "in"), fresh_dir(spark, "cp")
    schema = "window_start timestamp_ntz, word string, n long"
    log = BatchLog(spark, fresh_dir(spark, "log"), schema, ["window_start", "word"], "latest", day="window_start")
    top = BatchLog(spark, fresh_dir(spark, "top"), schema + ", rank int", ["window_start", "rank"], "latest", day="window_start")
    at = dt.datetime(2024, 1, 1, 0, 0, 30)
    for batch in (["a", "a", "b"], ["b", "b", "c", "d"]):
        add(spark, path, [(at, w) for w in batch], "ts timestamp_ntz, word string")
        counts = words.windowed_counts(feeds.files(spark, path, "ts timestamp_ntz, word string"), "ts", ["word"], "60 seconds", None, "1 hour")
        words.windowed_top(counts, [], "word", 3, log, top, checkpoint)
    assert rows(top.latest(), "rank", "word", "n") == [(1, "b", 3), (2, "a", 2), (3, "c", 1)]


@pytest.fixture()
def tables(spark):
    return ads.AdTables.under(spark, fresh_dir(spark, "ads"))


def test_a_user_over_the_threshold_is_dropped_from_the_next_batch(spark, tables):
    path, checkpoint = fresh_dir(spark, "in"), fresh_dir(spark, "cp")
    batches = [
        [click(i, 1, 7) for i in range(2)] + [click(10, 1, 8)],
        [click(20, 1, 7), click(21, 1, 8, ad=2)],  # user 7 reaches 3 on day 1 over two batches
        [click(30, 2, 7), click(31, 2, 8)],
    ]
    for batch in batches:
        add(spark, path, batch, CLICK)
        ads.ad_job(feeds.files(spark, path, CLICK), tables, 3, checkpoint)
    assert rows(tables.blacklist.rows(), "user_id", "batch_id") == [(7, 1)]
    assert rows(tables.user_counts.totals()) == [
        ("2024-01-01", 7, 1, 3), ("2024-01-01", 8, 1, 1), ("2024-01-01", 8, 2, 1), ("2024-01-02", 8, 1, 1),
    ]
    assert rows(tables.ad_stat.totals(), "date", "ad_id", "clicks") == [("2024-01-01", 1, 4), ("2024-01-01", 2, 1), ("2024-01-02", 1, 1)]


def test_a_batch_tried_again_leaves_the_same_tables(spark, tables):
    first = spark.createDataFrame([click(i, 1, 7, ad=i % 5) for i in range(40)], CLICK)
    second = spark.createDataFrame([click(100 + i, 1, i % 9, ad=i % 4) for i in range(40)], CLICK)
    ads.handle_batch(tables, first, 0, 5)
    ads.handle_batch(tables, second, 1, 5)
    outputs = lambda: [
        rows(tables.blacklist.rows()), rows(tables.user_counts.totals()), rows(tables.ad_stat.totals()),
        rows(tables.province_top.latest(), "rank", "date", "province", "ad_id", "clicks"),
    ]
    before = outputs()
    ads.handle_batch(tables, second, 1, 5)
    assert outputs() == before
    assert [r[0] for r in before[3]] == [1, 2, 3]


def test_top_of_growing_counts_is_the_full_ranking(spark):
    draw, n = random.Random(5), 3
    totals, old = {}, spark.createDataFrame([], "g string, item long, n long, rank int")
    for batch in range(50):
        changed = {}
        for _ in range(draw.randrange(1, 12)):
            key = (draw.choice("abcd"), draw.randrange(12))
            totals[key] = changed[key] = totals.get(key, 0) + draw.randrange(1, 4)
        now = spark.createDataFrame([(*k, c) for k, c in changed.items()], "g string, item long, n long").coalesce(1)
        ranked = top_after_changes(old, now, ["g"], "item", "n", n)
        got = [tuple(r) for r in ranked.select("g", "item", "n", "rank").collect()]
        want = []
        for g in {k[0] for k in changed}:
            best = sorted((-c, i) for (x, i), c in totals.items() if x == g)[:n]
            want += [(g, i, -c, place + 1) for place, (c, i) in enumerate(best)]
        assert sorted(got) == sorted(want)
        held = {(r.g, r["rank"]): tuple(r) for r in old.collect()} | {(r[0], r[3]): r for r in got}
        old = spark.createDataFrame(list(held.values()), "g string, item long, n long, rank int").coalesce(1)


def test_sliding_totals_come_out_of_the_stream_as_windows_close(spark):
    path, checkpoint = fresh_dir(spark, "in"), fresh_dir(spark, "cp")
    schema = "ts timestamp_ntz, ad_id int"
    at, second = dt.datetime(2024, 1, 1, 10), lambda n: dt.timedelta(seconds=n)
    log = BatchLog(spark, fresh_dir(spark, "log"), ads.SLIDING_SCHEMA, ["window_end", "ad_id"], "rows", day="window_end")
    draw, said, ended = random.Random(6), [], []
    for batch in range(4):
        now = [(at + second(batch * 40 + draw.randrange(40)), draw.randrange(3)) for _ in range(30)]
        said += now
        add(spark, path, now, schema)
        ads.sliding_totals(feeds.files(spark, path, schema), log, checkpoint, "1 minute", "10 seconds", "20 seconds")
        closed = max(t for t, _ in said) - second(20)
        want = {}
        for t, ad in said:
            first = t.replace(microsecond=0) - second(t.second % 10) + second(10)
            for end in (first + second(10 * i) for i in range(6)):
                if end <= closed:
                    want[end, ad] = want.get((end, ad), 0) + 1
        # a run ends with the watermark it has reached
        got = {(r.window_end, r.ad_id): r.clicks for r in log.rows().collect()}
        assert got == want
        ended.append(len(got))
    assert ended[0] < ended[-1]


def test_a_click_is_kept_for_runs_of_windows_not_for_each_window(spark, monkeypatch):
    path, checkpoint = fresh_dir(spark, "in"), fresh_dir(spark, "cp")
    log = BatchLog(spark, fresh_dir(spark, "log"), ads.SLIDING_SCHEMA, ["window_end", "ad_id"], "rows", day="window_end")
    updated = []

    def run(writer, checkpoint):
        query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
        updated.extend(op.numRowsUpdated for progress in query.recentProgress for op in progress.stateOperators)

    monkeypatch.setattr(feeds, "run_available", run)
    start, second = dt.datetime(2024, 1, 1, 22, 50), lambda n: dt.timedelta(seconds=n)
    draw, said = random.Random(4), []
    for first, last in ((0, 1500), (1400, 6000), (30_000, 30_100)):  # late clicks, and hours without any
        now = [(start + second(draw.randrange(first, last)), draw.choice([1, 2, None])) for _ in range(40)] + [(None, 1)]
        said += now[:-1]
        add(spark, path, now, "ts timestamp_ntz, ad_id int")
        ads.sliding_totals(feeds.files(spark, path, "ts timestamp_ntz, ad_id int"), log, checkpoint)
    want, closed = {}, max(t for t, _ in said) - second(600)
    for t, ad in said:
        pane = t - second(t.second % 10)
        for end in (pane + second(10 * i) for i in range(1, 361)):
            if end <= closed:
                want[end, ad] = want.get((end, ad), 0) + 1
    lines = log.rows().collect()
    assert {(r.window_end, r.ad_id): r.clicks for r in lines} == want and len(lines) == len(want)
    assert sum(updated) <= 4 * len(said)  # 360 windows hold each of them


def test_empty_batch(spark, tables):
    ads.handle_batch(tables, spark.createDataFrame([], CLICK), 0, 2)
    assert tables.user_counts.totals().count() == 0 and tables.blacklist.rows().count() == 0


def test_hour_totals(spark):
    at, second = dt.datetime(2024, 1, 1, 10, 0), lambda n: dt.timedelta(seconds=n)
    counts = spark.createDataFrame([(at, 1, 5), (at + second(3590), 1, 2), (at + second(3600), 1, 1)], "window_start timestamp_ntz, ad_id int, n long")
    got = {r.window_end: r.clicks for r in ads.hour_totals(counts).collect()}
    assert got == {at + second(10): 5, at + second(3600): 7, at + second(3610): 3, at + second(7190 + 10): 1, at + second(7210): 0}


def test_a_log_that_is_folded_and_tried_again_keeps_its_totals(spark):
    log = BatchLog(spark, fresh_dir(spark, "folded"), "k string, n long", ["k"], every=2)
    batch = lambda n: spark.createDataFrame([("a", n), ("b", 1)], "k string, n long")
    for i in range(6):
        log.write(batch(i), i)
        log.write(batch(i), i)  # tried again
    folded = log.folded()
    assert folded >= 3
    for i in range(folded + 1):  # retries of batches that the fold holds
        log.write(batch(100), i)
    assert rows(log.totals()) == [("a", 15), ("b", 6)]
    last = BatchLog(spark, fresh_dir(spark, "folded"), "k string, n long", ["k"], "latest", every=2)
    for i in range(6):
        last.write(batch(i), i)
    assert rows(last.latest()) == [("a", 5), ("b", 1)]


def test_a_batch_reads_as_many_folders_after_fifty_batches(spark):
    log = BatchLog(spark, fresh_dir(spark, "long"), "day string, n long", ["day"], every=4, day="day")
    only = BatchLog(spark, fresh_dir(spark, "only"), "day string, n long", ["day"], "batch", day="day")
    most = 0
    for i in range(50):
        row = spark.createDataFrame([(f"2024-01-{1 + i // 5:02d}", 1)], "day string, n long").coalesce(1)
        log.write(row, i)
        only.write(row, i)
        most = max(most, sum(map(len, log._tiers())))
    assert most <= 3 * 4 + 1 and len(only._ids(0)) <= 2
    assert rows(log.totals()) == [(f"2024-01-{d:02d}", 5) for d in range(1, 11)]
    assert "PartitionFilters: [isnotnull(_day" in plan(log.totals(("2024-01-03", "2024-01-04")))
    assert rows(log.totals(("2024-01-03", "2024-01-04"))) == [("2024-01-03", 5), ("2024-01-04", 5)]


def test_folds_write_each_row_once_a_tier(spark, monkeypatch):
    log = BatchLog(spark, fresh_dir(spark, "tiers"), "k long, n long", ["k"], every=3)
    written, save = [], log._save
    monkeypatch.setattr(log, "_save", lambda rows, path: (save(rows, path), written.append((path, spark.read.parquet(path).count()))))
    for i in range(28):  # different keys, so no fold makes rows fewer
        log.write(spark.range(i * 10, i * 10 + 10).selectExpr("id AS k", "1L AS n").coalesce(1), i)
    assert log.totals().count() == 280 and [len(ids) for ids in log._tiers()] == [1, 0, 0, 1]
    assert max(n for path, n in written if "tier-1" in path) == 30
    # every row is written once in each tier it reaches; rewriting the table at each fold would take 1,350 rows
    assert sum(n for _, n in written) == 280 + 3 * 270
    for i in range(28):  # nothing that a fold holds is added again
        if i <= log.folded():
            log.write(spark.range(10).selectExpr("id AS k", "100L AS n"), i)
    assert log.totals().agg(F.sum("n")).first()[0] == 280


def test_a_fold_that_was_interrupted(spark):
    log = BatchLog(spark, fresh_dir(spark, "torn"), "k string, n long", ["k"], every=2)
    batch = lambda n: spark.createDataFrame([("a", n)], "k string, n long").coalesce(1)
    for i in range(2):
        log.write(batch(1), i)
    fs, _ = log._fs(log.path)
    # the fold is complete but its sources are still there
    log._save(batch(2), f"{log.path}/tier-1/1")
    assert rows(log.totals()) == [("a", 2)]
    # a fold without its mark does not count
    log._save(batch(50), f"{log.path}/tier-2/1")
    fs.delete(log._fs(f"{log.path}/tier-2/1/_SUCCESS")[1], True)
    assert rows(log.totals()) == [("a", 2)] and log._ids(2) == []
    for i in range(2, 9):
        log.write(batch(1), i)
        log.write(batch(1), i)
    assert rows(log.totals()) == [("a", 9)]


def test_ad_tables_over_many_arrivals(spark):
    """The events of the smallest tables arrive ten days at a time; the same as counting batch by batch by hand."""
    from clickweave.plans import views

    clicks = views.ad_clicks(spark, "/root/testdata/sf0.001")
    tables, checkpoint = ads.AdTables.under(spark, fresh_dir(spark, "ads")), fresh_dir(spark, "cp")
    replay(clicks, "ts", 10, lambda path: ads.ad_job(feeds.files(spark, path, clicks.schema), tables, 2, checkpoint))
    all_clicks = clicks.collect()
    first = min(c.ts.date() for c in all_clicks)
    counts, listed, kept = {}, {}, []
    for c in sorted(all_clicks, key=lambda c: c.ts):
        batch = (c.ts.date() - first).days // 10
        if listed.get(c.user_id, batch) >= batch:
            key = (str(c.ts.date()), c.user_id, c.ad_id)
            counts[key] = counts.get(key, 0) + 1
            kept.append(c)
            if counts[key] >= 2:
                listed.setdefault(c.user_id, batch)
    assert rows(tables.user_counts.totals()) == sorted([(*k, n) for k, n in counts.items()], key=repr)
    assert {r.user_id for r in tables.blacklist.rows().collect()} == set(listed)
    assert sum(r.clicks for r in tables.ad_stat.totals().collect()) == len(kept)


def test_malformed_log_lines(spark):
    lines = spark.createDataFrame([("1704067200123 North Rome 7 3",), ("x North Rome seven",), ("",)], "value string")
    got = feeds.parse_ad_log(lines).collect()
    assert (got[0].ts, got[0].province, got[0].user_id, got[0].ad_id) == (dt.datetime(2024, 1, 1, 0, 0, 0, 123000), "North", 7, 3)
    assert (got[1].ts, got[1].user_id, got[1].ad_id) == (None, None, None)


def test_replay_of_an_empty_table_still_runs(spark):
    ran = []
    replay(spark.createDataFrame([], CLICK), "ts", 10, ran.append)
    assert len(ran) == 1
