"""Joins and aggregations for keys of very uneven weight."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from clickweave.functions.hashing import salt


def hot_keys(df: DataFrame, key: str, share: float = 0.01) -> list:
    """Every key that holds more than ``share`` of all rows, and perhaps a few others.

    One pass over the key column that keeps ``1 / share`` counters per task and shuffles no rows; the
    list has at most ``1 / share`` entries. Its users only spread work by it, so a key too many is harmless.
    """
    found = df.where(F.col(key).isNotNull()).select(key).freqItems([key], share).first()
    return [] if found is None or found[0] is None else list(found[0])


def is_any(key: str, values: list) -> Column:
    return F.col(key).isin(values) if values else F.lit(False)


def split_join(
    big: DataFrame, small: DataFrame, key: str, row_id: Sequence[str], salts: int = 16, share: float = 0.01
) -> DataFrame:
    """Inner join that spreads only the hot keys of ``big`` over ``salts`` tasks each."""
    hot = is_any(key, hot_keys(big, key, share))
    left = big.withColumn("_salt", F.when(hot, salt(salts, *row_id)).otherwise(F.lit(0)))
    copies = F.when(hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = small.withColumn("_salt", F.explode(copies))
    return left.join(right, [key, "_salt"]).drop("_salt")


def _hashable(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _hashable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_hashable(f.dataType) for f in kind)
    return not isinstance(kind, (T.MapType, T.VariantType))


def spread(df: DataFrame, salts: int, row_id: Sequence[str] = ()) -> Column:
    """A salt that is the same when a task runs again: of ``row_id`` if given, else of the row's columns and its
    partition, so that equal rows and rows of nothing but a key are spread as well."""
    if row_id:
        return salt(salts, *row_id)
    known = [c for c, f in zip(df.columns, df.schema) if _hashable(f.dataType)]
    return F.pmod(F.xxhash64(*known) + F.spark_partition_id(), F.lit(salts)).cast("int")


def join_keyed(
    big: DataFrame, keyed: DataFrame, on: Sequence[str], how: str = "inner", share: float = 0.01, salts: int = 32,
    row_id: Sequence[str] = (), hot: Sequence[int] | None = None,
) -> DataFrame:
    """Join ``big`` with a side that has one row per key; ``how``: inner, left, left_semi or left_anti.

    A side fresh from an aggregation is already clustered by the key, and then no partition of the join
    can be split at run time. So hot keys of ``big`` (null among them) are spread here: their rows get a
    salt (see ``spread``), and the one row of the other side is copied to each. ``hot`` gives the xxhash64 of
    such keys if they are known already.
    """
    on = list(on)
    if hot is None:
        hot = hot_keys(big.select(F.xxhash64(*on).alias("_key")), "_key", share)
    if not hot:
        return big.join(keyed, on, how)
    is_hot = F.xxhash64(*on).isin(hot)
    left = big.withColumn("_salt", F.when(is_hot, spread(big, salts, row_id)).otherwise(F.lit(0)))
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = keyed.withColumn("_salt", F.explode(copies))
    return left.join(right, [*on, "_salt"], how).drop("_salt")


def salted_join(big: DataFrame, small: DataFrame, key: str, row_id: Sequence[str], salts: int = 10) -> DataFrame:
    """Inner join with every key of ``big`` spread over ``salts`` tasks and ``small`` copied ``salts`` times."""
    left = big.withColumn("_salt", salt(salts, *row_id))
    right = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [key, "_salt"]).drop("_salt")


def salted_sum(
    df: DataFrame, keys: Sequence[str], sums: Mapping[str, Column], row_id: Sequence[str], salts: int = 16
) -> DataFrame:
    """Two-stage aggregation: sums per (key, salt), then per key."""
    first = df.groupBy(*keys, salt(salts, *row_id).alias("_salt")).agg(
        *[F.sum(column).alias(name) for name, column in sums.items()]
    )
    return first.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in sums])
