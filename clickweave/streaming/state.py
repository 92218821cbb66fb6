"""Ad clicks judged by the state of each user, which the stream keeps itself."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor

from clickweave.sinks.writers import BatchLog
from clickweave.streaming.ads import AdTables, area_counts, user_counts
from clickweave.streaming.feeds import each_batch

DECISION = "kind string, event_id string, date string, province string, city string, user_id string, ad_id string"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, off the heap, with checkpoints of what changed."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)


# Fixed value: it decides the keys of the state, so a checkpoint goes on only with the number it began with.
BUCKETS = 512
_CELLS = "cells array<struct<user_id: string, ad_id: string, clicks: bigint>>"


class UserClicks(StatefulProcessor):
    """The clicks of a bucket of users per day, user and ad, and the day each of them was listed.

    Gives the clicks that count (kind ``kept``) and, once a user, the listing (kind ``listed``). A day's counts leave
    the state when the watermark has passed the day; the listing stays. State is read and written once per bucket and
    day, not per user, as every call of it goes from Python to the JVM and back.
    """

    def __init__(self, threshold: int) -> None:
        self._threshold = threshold

    def init(self, handle) -> None:
        self._handle = handle
        self._counts = handle.getMapState("counts", "date string", _CELLS)
        self._listed = handle.getListState("listed", "user_id string, date string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        listed = {user for user, _ in self._listed.get()}
        new: dict[str, Counter] = {}
        for clicks in rows:
            kept = clicks[~clicks["user_id"].isin(listed)]
            for date, user, ad in zip(kept["date"], kept["user_id"], kept["ad_id"]):
                if user:
                    new.setdefault(date, Counter())[user, None if pd.isna(ad) else ad] += 1
            if len(kept):
                yield self._decisions(kept, "kept")
        if not new:
            return
        held = {date: cells for (date,), (cells,) in self._counts.iterator()}
        over: dict[str, str] = {}
        for date in sorted(new):
            for user, ad, n in held.get(date, ()):
                new[date][user, ad] += n
            for (user, _), n in new[date].items():
                if n >= self._threshold and user not in listed:
                    over.setdefault(user, date)
        for date, cells in new.items():  # a listed user is not counted any more
            left = [(user, ad, n) for (user, ad), n in cells.items() if user not in over and user not in listed]
            self._counts.updateValue((date,), (left,))
        self._handle.registerTimer(_end_of(min(new)))  # moved on as long as there are days
        if over:
            self._listed.appendList(sorted(over.items()))
            lines = pd.DataFrame({"user_id": [*over], "date": [*over.values()]})
            yield self._decisions(lines.reindex(columns=["event_id", "date", "province", "city", "user_id", "ad_id"]), "listed")

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()
        days = sorted(date for (date,) in self._counts.keys())
        left = [date for date in days if _end_of(date) > passed]
        for date in days[: len(days) - len(left)]:
            self._counts.removeKey((date,))
        if left:
            self._handle.registerTimer(_end_of(left[0]))
        return iter(())

    def close(self) -> None:
        pass

    @staticmethod
    def _decisions(clicks: pd.DataFrame, kind: str) -> pd.DataFrame:
        out = clicks.assign(kind=kind, user_id=[user or None for user in clicks["user_id"]])
        out = out[["kind", "event_id", "date", "province", "city", "user_id", "ad_id"]].astype(object)
        return out.where(out.notna(), None)


def _end_of(date: str) -> int:
    """The first millisecond (UTC) after a day."""
    day = dt.datetime.fromisoformat(date).replace(tzinfo=dt.timezone.utc)
    return int((day + dt.timedelta(days=1)).timestamp() * 1000)


def judged(stream: DataFrame, threshold: int, late: str = "1 day") -> DataFrame:
    """Clicks that count and newly listed users, by the state of each user (see ``UserClicks``).

    A user listed by an earlier batch is dropped; one who crosses the threshold in this batch is dropped from the next
    one on. Nothing is read back: a batch costs the rows it brings. Clicks without a time, and those later than ``late``
    behind the latest click, are dropped; clicks without a user all count. Users are kept in ``BUCKETS`` buckets by
    hash, and clicks without one are dealt to all buckets by their id. The rows of a bucket pass through one task, a
    chunk at a time, so its memory depends on their days, users and ads, not on how many there are.
    """
    # Ids go through pandas as text: a null among numbers would turn all of them, and the state's key, into floats.
    user = F.coalesce(F.col("user_id").cast("string"), F.lit("")).alias("user_id")
    clicks = stream.where("ts IS NOT NULL").select(
        F.col("ts").cast("timestamp").alias("_ts"), F.col("event_id").cast("string").alias("event_id"),
        F.date_format("ts", "yyyy-MM-dd").alias("date"), "province", "city", user, F.col("ad_id").cast("string").alias("ad_id"),
        F.pmod(F.xxhash64(F.coalesce(F.col("user_id"), F.col("event_id"))), F.lit(BUCKETS)).cast("int").alias("bucket"),
    )
    buckets = clicks.withWatermark("_ts", late).groupBy("bucket")
    return buckets.transformWithStateInPandas(UserClicks(threshold), DECISION, "append", "eventTime")


def ad_job_by_state(
    stream: DataFrame, tables: AdTables, decisions: BatchLog, threshold: int, checkpoint: str, n: int = 3, late: str = "1 day"
) -> None:
    """The tables of ``ads.ad_job``, with the blacklist and the counts it depends on kept as state.

    Each batch is run through the state once, into ``decisions`` (a log that keeps only its last batch); all tables are
    written from there, under the batch id, so a batch that is tried again leaves the same tables.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        decisions.write(batch, batch_id)
        made = decisions.of(batch_id).select(
            "kind", "date", "province", "city", F.col("user_id").cast("long").alias("user_id"), F.col("ad_id").cast("int").alias("ad_id")
        )
        tables.blacklist.write(made.where("kind = 'listed'").select("user_id"), batch_id)
        kept = made.where("kind = 'kept'")
        low, high = kept.agg(F.min("date"), F.max("date")).first()
        if low is not None:
            user_counts(tables, kept, batch_id)
            area_counts(tables, kept, batch_id, (low, high), n)

    with rocksdb_state(stream.sparkSession):
        each_batch(judged(stream, threshold, late), handle, checkpoint)


def decision_log(spark: SparkSession, path: str) -> BatchLog:
    return BatchLog(spark, path, DECISION, ["event_id"], "batch")
