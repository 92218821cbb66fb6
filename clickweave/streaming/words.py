"""Word counts, running counts and windowed top lists on streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from clickweave.operators.joins import without_partner
from clickweave.operators.ordering import top_after_changes
from clickweave.operators.text import word_counts
from clickweave.sinks.writers import BatchLog
from clickweave.streaming.feeds import each_batch, run_available


def count_per_batch(stream: DataFrame, words: Column, log: BatchLog, checkpoint: str) -> None:
    """Words of each micro-batch, counted on their own and logged under the batch id."""
    each_batch(stream, lambda batch, batch_id: log.write(word_counts(batch, words), batch_id), checkpoint)


def running_counts(stream: DataFrame, keys: Sequence[str], log: BatchLog, checkpoint: str) -> None:
    """Counts per key since the start, kept as stream state; each batch logs the keys it changed."""
    counts = stream.groupBy(*keys).agg(F.count("*").alias("n"))
    each_batch(counts, log.write, checkpoint, "update")


def windowed_counts(
    stream: DataFrame, ts: str, keys: Sequence[str], size: str, slide: str | None, late: str
) -> DataFrame:
    """Count per sliding window and keys; rows later than ``late`` are dropped and old windows leave the state."""
    timed = stream.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", late)
    window = F.window("_ts", size, slide) if slide else F.window("_ts", size)
    counts = timed.groupBy(window.alias("w"), *keys).agg(F.count("*").alias("n"))
    return counts.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), *keys, "n")


def windowed_top(
    counts: DataFrame, groups: Sequence[str], item: str, n: int, log: BatchLog, top: BatchLog, checkpoint: str
) -> None:
    """The ``n`` most frequent items per window and group.

    A batch brings only the counts it changed. Counts only grow, so the new top of a window and group is found among
    its old top and those changes; nothing else is ranked, and of the log of top lists only the days of the changes
    are read. Ranks of a touched window replace the earlier ones; a window never loses items, so none go stale.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        log.write(batch, batch_id)
        changed = log.of(batch_id)
        day = F.date_format("window_start", "yyyy-MM-dd")
        low, high = changed.agg(F.min(day), F.max(day)).first()
        if low is None:
            return
        old = top.latest((low, high), below=batch_id)
        top.write(top_after_changes(old, changed, ["window_start", *groups], item, "n", n), batch_id)

    each_batch(counts, handle, checkpoint, "update")


def drop_listed(stream: DataFrame, listed: DataFrame, key: str, log: BatchLog, checkpoint: str) -> None:
    """Rows whose key is not in a static table; each batch is an anti join that spreads hot keys."""
    each_batch(stream, lambda batch, batch_id: log.write(without_partner(batch, listed, [key]), batch_id), checkpoint)


def append_files(stream: DataFrame, path: str, checkpoint: str) -> None:
    run_available(stream.writeStream.outputMode("append").format("parquet").option("path", path), checkpoint)
