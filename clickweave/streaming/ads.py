"""Real-time ad clicks: dynamic blacklist, running counts, top ads per province, click trend."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from clickweave.operators.joins import with_partner, without_partner
from clickweave.operators.ordering import top_after_changes
from clickweave.sinks.writers import BatchLog
from clickweave.streaming.feeds import each_batch
from clickweave.streaming.words import windowed_counts

TOP_SCHEMA = "date string, province string, ad_id int, clicks long, rank int"
SLIDING_SCHEMA = "window_end timestamp_ntz, ad_id int, clicks long"


@dataclass
class AdTables:
    """Tables the ad job keeps, all under one folder."""

    kept: BatchLog
    user_counts: BatchLog
    blacklist: BatchLog
    ad_stat: BatchLog
    province_top: BatchLog

    @classmethod
    def under(cls, spark: SparkSession, path: str) -> "AdTables":
        return cls(
            BatchLog(
                spark, f"{path}/kept", "event_id long, date string, province string, city string, user_id long, ad_id int",
                ["event_id"], "batch",
            ),
            BatchLog(spark, f"{path}/user_counts", "date string, user_id long, ad_id int, clicks long", ["date", "user_id", "ad_id"], day="date"),
            BatchLog(spark, f"{path}/blacklist", "user_id long", ["user_id"], "rows"),
            BatchLog(
                spark, f"{path}/ad_stat", "date string, province string, city string, ad_id int, clicks long",
                ["date", "province", "city", "ad_id"], day="date",
            ),
            BatchLog(spark, f"{path}/province_top", TOP_SCHEMA, ["date", "province", "rank"], "latest", day="date"),
        )


def handle_batch(tables: AdTables, batch: DataFrame, batch_id: int, threshold: int, n: int = 3) -> None:
    """One micro-batch of clicks.

    Users listed by earlier batches are dropped; a user who crosses the threshold in this batch is
    dropped from the next one on. Every output is keyed by the batch id or by the partitions it
    replaces, so a batch that is tried again leaves the same tables. Only the days of this batch are read back,
    from a bounded number of folders, and only ads that the batch has are ranked beside the top lists so far.
    """
    dated = batch.withColumn("date", F.date_format("ts", "yyyy-MM-dd"))
    listed = tables.blacklist.before(batch_id).select("user_id").distinct()
    tables.kept.write(without_partner(dated, listed, ["user_id"]), batch_id)
    kept = tables.kept.of(batch_id)
    low, high = kept.agg(F.min("date"), F.max("date")).first()
    if low is None:
        return
    user_counts(tables, kept, batch_id)
    so_far = tables.user_counts.totals((low, high))
    over = so_far.where(F.col("clicks") >= threshold).select("user_id").distinct()
    tables.blacklist.write(over.join(listed, "user_id", "left_anti"), batch_id)
    area_counts(tables, kept, batch_id, (low, high), n)


def user_counts(tables: AdTables, kept: DataFrame, batch_id: int) -> None:
    tables.user_counts.write(kept.groupBy("date", "user_id", "ad_id").agg(F.count("*").alias("clicks")), batch_id)


def area_counts(tables: AdTables, kept: DataFrame, batch_id: int, days: tuple[str, str], n: int) -> None:
    """Clicks per place and ad, and the top ads of each province."""
    tables.ad_stat.write(kept.groupBy("date", "province", "city", "ad_id").agg(F.count("*").alias("clicks")), batch_id)
    # Only ads that were clicked in this batch are counted again; the top lists hold all others that matter.
    grown = kept.select("date", "province", "ad_id").distinct()
    counted = with_partner(tables.ad_stat.rows(days), grown, ["date", "province", "ad_id"])
    changed = counted.groupBy("date", "province", "ad_id").agg(F.sum("clicks").alias("clicks"))
    old = tables.province_top.latest(days, below=batch_id)
    tables.province_top.write(top_after_changes(old, changed, ["date", "province"], "ad_id", "clicks", n), batch_id)


def ad_job(stream: DataFrame, tables: AdTables, threshold: int, checkpoint: str) -> None:
    each_batch(stream, lambda batch, batch_id: handle_batch(tables, batch, batch_id, threshold), checkpoint)


def click_trend(stream: DataFrame, log: BatchLog, checkpoint: str) -> None:
    """Clicks per minute and ad, of the unfiltered stream; a late click is added to its minute for an hour."""
    clicks_per(stream, log, checkpoint, "1 minute")


def clicks_per(stream: DataFrame, log: BatchLog, checkpoint: str, size: str, late: str = "1 hour") -> None:
    """Clicks per window of ``size`` and ad."""
    counts = windowed_counts(stream, "ts", ["ad_id"], size, None, late)
    each_batch(counts, log.write, checkpoint, "update")


def sliding_totals(stream: DataFrame, log: BatchLog, checkpoint: str, size: str = "1 hour", slide: str = "10 seconds", late: str = "10 minutes") -> None:
    """Clicks per ad in the window of ``size`` that slides by ``slide``, out of the stream itself.

    Clicks are counted in panes of ``slide``, first in every chunk of a task, so that a hot ad is not shuffled click by
    click. As many windows, one after the other, as a window has panes are a run; a pane goes to the one or two runs whose
    windows hold it, not to each of the windows. The state of a run and ad is its panes (less than twice those of a
    window), and the totals of its windows are differences of running sums. A line is logged once, when its window
    closes; clicks whose pane is later than ``late`` are dropped. Panes leave the state when the last window of the run
    that holds them closes, so the state holds those of ``size`` + ``late``, whatever has gone before.
    """
    step, length = _micros(stream.sparkSession, slide), _micros(stream.sparkSession, size)
    if step > length:
        raise ValueError("a window cannot slide by more than its size")
    per = length // step
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    clicks = stream.where("ts IS NOT NULL").select(F.col("ad_id").cast("string").alias("ad_id"), micros.alias("at"))
    clicks = clicks.withColumn("pane", F.expr(f"(at - pmod(at, {step}L)) div {step}L"))
    counts = clicks.mapInArrow(_per_pane, "ad_id string, pane long, at long, n long")
    timed = counts.withColumn("_ts", F.timestamp_micros("at")).withWatermark("_ts", late)
    # Whole panes are late or not, by the time they end.
    panes = timed.withColumn("_pane", F.window("_ts", slide)).select("ad_id", "pane", "n", F.window_time("_pane").alias("_ended"))

    def run_of(window):
        return window - F.pmod(window, F.lit(per))

    runs = F.explode(F.sequence(run_of(F.col("pane") - (per - 1)), run_of(F.col("pane")), F.lit(per).cast("long")))
    ended = panes.withColumn("run", runs).groupBy("run", "ad_id").applyInPandasWithState(
        _ended_windows(per, step, length), "window_end long, ad_id string, clicks long", "done int, panes array<int>, counts array<long>",
        "append", GroupStateTimeout.EventTimeTimeout,
    )
    lines = ended.select(F.timestamp_micros("window_end").cast("timestamp_ntz").alias("window_end"), "ad_id", "clicks")
    each_batch(lines, log.write, checkpoint, "append")


def _per_pane(chunks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunk in chunks:
        counted = pa.Table.from_batches([chunk]).group_by(["ad_id", "pane"]).aggregate([("at", "max"), ("at", "count")])
        yield from counted.rename_columns(["ad_id", "pane", "at", "n"]).to_batches()


def _micros(spark: SparkSession, interval: str) -> int:
    window = spark.range(1).select(F.window(F.timestamp_micros(F.lit(0)), interval).alias("w"))
    return window.select(F.unix_micros("w.end") - F.unix_micros("w.start")).first()[0]


def _ended_windows(per: int, step: int, length: int):
    """For one run of ``per`` windows and one ad: the lines of the windows that the watermark has passed since the last call.

    Panes and windows are numbered from the run's first one; window i holds the panes i to i + ``per`` - 1.
    """

    def ended(key: tuple, new: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        run, ad = int(key[0]), key[1]
        done, panes, counts = state.get if state.exists else (0, [], [])
        held = np.zeros(2 * per, dtype="int64")
        held[np.array(panes, dtype="int64")] = counts
        if not state.hasTimedOut:
            for part in new:
                np.add.at(held, part["pane"].to_numpy("int64") - run, part["n"].to_numpy("int64"))
        so_far = np.cumsum(held) - held  # of the panes before each one
        totals = so_far[per:] - so_far[:per]
        passed = state.getCurrentWatermarkMs() * 1000
        due = min(max((passed - length) // step - run + 1, done), per)
        kept = due + np.flatnonzero(held[due:])
        if due < per and len(kept):
            state.update((due, kept.tolist(), held[kept].tolist()))
            next_end = (run + due + int(np.argmax(totals[due:] > 0))) * step + length
            state.setTimeoutTimestamp((next_end - 1) // 1000)  # a watermark beyond it has reached that end
        elif state.exists:
            state.remove()
        lines = done + np.flatnonzero(totals[done:due])
        yield pd.DataFrame({"window_end": (run + lines) * step + length, "ad_id": [ad] * len(lines), "clicks": totals[lines]})

    return ended


def hour_totals(counts: DataFrame, slide: int = 10, size: int = 3600) -> DataFrame:
    """Clicks per ad in the window of ``size`` seconds that slides by ``slide``: (window_end, ad_id, clicks).

    ``counts`` has clicks per ``slide`` seconds (window_start, ad_id, n). A count enters the window that ends with
    its slide and leaves ``size`` later, so the total is a running sum of two changes per count, and a line tells
    the total from its window's end until the next line of the ad. No click is copied to the windows that hold it.
    """
    end = F.col("window_start") + F.make_dt_interval(secs=F.lit(slide))
    changes = counts.select("ad_id", F.explode(F.array(
        F.struct(end.alias("window_end"), F.col("n").alias("change")),
        F.struct((end + F.make_dt_interval(secs=F.lit(size))).alias("window_end"), (-F.col("n")).alias("change")),
    )).alias("c")).select("ad_id", "c.*")
    per_end = changes.groupBy("ad_id", "window_end").agg(F.sum("change").alias("change"))
    so_far = W.partitionBy("ad_id").orderBy("window_end").rowsBetween(W.unboundedPreceding, 0)
    return per_end.select("window_end", "ad_id", F.sum("change").over(so_far).alias("clicks"))
