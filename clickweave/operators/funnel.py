"""Page-flow conversion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from clickweave.operators.ordering import with_previous


def page_pairs(actions: DataFrame) -> DataFrame:
    """Visits of two pages in a row within a session, counted per pair.

    The table is sorted as a whole by session and time, so a session of any length is spread over tasks.
    """
    visits = actions.select("session_id", "action_time", "event_id", "page_id")
    steps = with_previous(visits, ["session_id", "action_time", "event_id"], ["session_id", "page_id"])
    inside = steps.where(F.col("previous.session_id") == F.col("session_id"))
    return inside.groupBy(F.col("previous.page_id").alias("from_page"), F.col("page_id").alias("to_page")).agg(
        F.count("*").alias("hits")
    )


def conversion_rates(actions: DataFrame, flow: Sequence[int]) -> DataFrame:
    """Rate of each step of ``flow``: its hits divided by those of the step before, the first by all visits
    to the first page. A pair never seen has 0 hits; without hits before it the rate is null."""
    spark = actions.sparkSession
    steps = [(i, a, b) for i, (a, b) in enumerate(zip(flow, flow[1:]), start=1)]
    plan = F.broadcast(spark.createDataFrame(steps, "step int, from_page long, to_page long"))
    pages = sorted(set(flow))
    counted = page_pairs(actions).where(F.col("from_page").isin(pages) & F.col("to_page").isin(pages))
    hits = (
        plan.join(counted, ["from_page", "to_page"], "left")
        .withColumn("hits", F.coalesce("hits", F.lit(0)))
    )
    start = actions.where(F.col("page_id") == flow[0]).agg(F.count("*").alias("n")).scalar()
    before = F.coalesce(F.lag("hits").over(W.orderBy("step")), start)  # one row per step of the flow
    pair = F.concat_ws("_", "from_page", "to_page")
    return hits.select(
        "step", pair.alias("pair"), "hits", F.round(F.try_divide(F.col("hits"), before), 2).alias("rate")
    )


def rate_string(rates: DataFrame) -> DataFrame:
    """One row: ``pair=rate|pair=rate|...`` in flow order."""
    part = F.concat(F.col("pair"), F.lit("="), F.coalesce(F.col("rate").cast("string"), F.lit("null")))
    ordered = F.array_sort(F.collect_list(F.struct("step", part.alias("text"))))
    return rates.agg(F.array_join(F.transform(ordered, lambda s: s["text"]), "|").alias("convert_rate"))
