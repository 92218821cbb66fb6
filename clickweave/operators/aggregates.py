"""Aggregations beyond a plain ``groupBy().agg()``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F

from clickweave.operators.ordering import rank_in_group


def grouped_values(df: DataFrame, key: str, value: str, row_id: str) -> DataFrame:
    """All values of each key in long form, sorted: one row per (key, position)."""
    rows = df.select(F.col(key), F.col(value).alias("value"), F.col(row_id).alias("_id"))
    return rank_in_group(rows, [key], ["value", "_id"], "position").select(key, "position", "value")


def observed(df: DataFrame, metrics: Mapping[str, Column], path: str | None = None) -> dict:
    """Write ``df`` to ``path``, counting ``metrics`` on the way; without a path the rows go nowhere."""
    counter = Observation()
    rows = df.observe(counter, *[column.alias(name) for name, column in metrics.items()])
    if path is None:
        rows.write.format("noop").mode("overwrite").save()
    else:
        rows.write.parquet(path)
    return counter.get


def _no_hits() -> Column:
    return F.array().cast("array<struct<kind:string,id:bigint>>")


def _tag(ids: Column, kind: str) -> Column:
    return F.transform(ids, lambda i: F.struct(F.lit(kind).alias("kind"), i.alias("id")))


def counts_per_kind(df: DataFrame, kinds: Mapping[str, Column], key: str) -> DataFrame:
    """How often each id occurs per kind, in one pass. ``kinds`` maps a count's name to an array of ids."""
    tagged = F.concat(*[F.coalesce(_tag(ids, name), _no_hits()) for name, ids in kinds.items()])
    hits = df.select(F.explode(tagged).alias("hit")).select("hit.kind", F.col("hit.id").alias(key))
    return hits.groupBy(key).agg(*[F.count_if(F.col("kind") == name).alias(name) for name in kinds])


def id_list(text: str) -> Column:
    """Ids of a comma list."""
    return F.split(text, ",").cast("array<bigint>")


def one_id(column: str) -> Column:
    """A single id as a list, empty if null."""
    return F.when(F.col(column).isNotNull(), F.array(F.col(column).cast("long")))


def distinct_per_group(df: DataFrame, keys: Sequence[str], column: str, name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.countDistinct(column).alias(name))
