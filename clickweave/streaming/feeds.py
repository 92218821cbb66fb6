"""Streams from files, sockets and Kafka."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

# Columns of a Kafka record.
KAFKA_SCHEMA = "key binary, value binary, topic string, partition int, offset long, timestamp timestamp, timestampType int"


def files(spark: SparkSession, path: str, schema, format: str = "parquet", **options: str) -> DataFrame:
    """New files of a folder as they arrive."""
    return spark.readStream.schema(schema).format(format).options(**options).load(path)


def table_stream(spark: SparkSession, folder: str, name: str, schema: str) -> DataFrame:
    """A table in Parquet as a stream; the pattern matches a single file as well as a folder of files."""
    return files(spark, f"{folder}/{name}.parque[t]", schema)


def source(spark: SparkSession, format: str, **options: str) -> DataFrame:
    """Any other stream source, such as ``socket`` (host, port) or ``kafka`` (servers, topic)."""
    return spark.readStream.format(format).options(**options).load()


def decode_kafka(records: DataFrame) -> DataFrame:
    """Text of each Kafka record."""
    return records.select(F.col("value").cast("string").alias("value"))


def parse_ad_log(lines: DataFrame, column: str = "value") -> DataFrame:
    """``timestamp_ms province city user ad`` lines as columns; malformed fields become null."""
    parts = F.split(column, " ")
    return lines.select(
        F.timestamp_millis(F.get(parts, F.lit(0)).try_cast("long")).alias("ts"),
        F.get(parts, F.lit(1)).alias("province"),
        F.get(parts, F.lit(2)).alias("city"),
        F.get(parts, F.lit(3)).try_cast("long").alias("user_id"),
        F.get(parts, F.lit(4)).try_cast("int").alias("ad_id"),
    )


def run_available(writer: DataStreamWriter, checkpoint: str) -> None:
    """Process what has arrived, then stop. The checkpoint makes the next run go on from there."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def each_batch(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    run_available(stream.writeStream.outputMode(mode).foreachBatch(handle), checkpoint)
