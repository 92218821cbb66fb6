"""Lets a table arrive in parts, as the tests of streaming jobs need it."""

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, functions as F

from clickweave.workspace import fresh_dir


def replay(rows: DataFrame, ts: str, days: int, run: Callable[[str], None]) -> None:
    """Let a table arrive ``days`` days at a time in one folder and run the job after each arrival.

    The loop goes over periods of time, not over rows; each period is one distributed write.
    """
    spark = rows.sparkSession
    incoming = fresh_dir(spark, "incoming")
    start, last = rows.agg(F.min(F.to_date(ts)), F.max(F.to_date(ts))).first()
    if start is None:
        rows.write.mode("append").parquet(incoming)
        return run(incoming)
    kind = rows.schema[ts].dataType
    while start <= last:
        end = start + timedelta(days=days)
        low, high = (F.lit(day.isoformat()).cast(kind) for day in (start, end))
        rows.where((F.col(ts) >= low) & (F.col(ts) < high)).write.mode("append").parquet(incoming)
        run(incoming)
        start = end
