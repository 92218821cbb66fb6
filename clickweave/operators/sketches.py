"""Distinct counts from stored sketches, which merge to any range of days without reading events again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickweave.sinks.writers import BatchLog

SKETCH_BITS = 12  # 4,096 registers, at most some 2.5 KB a sketch


def standard_error(bits: int = SKETCH_BITS) -> float:
    """Relative standard error of a sketch with two to the ``bits`` registers, merged ones included."""
    return 1.04 / 2 ** (bits / 2)


def daily_sketches(events: DataFrame, day: Column, value: str, bits: int = SKETCH_BITS) -> DataFrame:
    """A sketch of the distinct values of each day: (day, sketch). Values merge in every task; null counts as none."""
    return events.groupBy(day.alias("day")).agg(F.hll_sketch_agg(value, bits).alias("sketch"))


def sketch_log(spark: SparkSession, path: str, every: int = 8) -> BatchLog:
    """Daily sketches by arrival. A late event's day gets a further sketch, and folds merge those of a day."""
    return BatchLog(spark, path, "day string, sketch binary", ["day"], "sketches", every, day="day")


def distinct_in(sketches: DataFrame, period: Column, name: str = "distinct") -> DataFrame:
    """The estimate for each period, from the sketches of its days: (period, distinct)."""
    merged = sketches.groupBy(period.alias("period")).agg(F.hll_union_agg("sketch").alias("sketch"))
    return merged.select("period", F.hll_sketch_estimate("sketch").alias(name))
