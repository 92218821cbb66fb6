"""Join operators.

Outer joins are one native join for all ordinary keys. Keys that hold more than a share of either side, null
among them, are joined apart, salted, because a native outer join cannot be split on every side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from clickweave.operators.ordering import rank_in_group
from clickweave.operators.skew import hot_keys, join_keyed, spread
from clickweave.workspace import fresh_dir, fresh_name


def without_partner(left: DataFrame, right: DataFrame, on: Sequence[str], row_id: Sequence[str] = ()) -> DataFrame:
    """Rows of ``left`` whose key is not in ``right``; a null key has no partner."""
    return join_keyed(left, right.select(*on).distinct(), on, "left_anti", row_id=row_id)


def with_partner(left: DataFrame, right: DataFrame, on: Sequence[str], row_id: Sequence[str] = ()) -> DataFrame:
    """Rows of ``left`` whose key is in ``right``, each once."""
    return join_keyed(left, right.select(*on).distinct(), on, "left_semi", row_id=row_id)


def inner(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    return left.join(right, list(on))


def _hot(df: DataFrame, on: Sequence[str], share: float) -> list[int]:
    """Hashes of the keys with more than ``share`` of the rows, at most ``1 / share``; null is a key like others.

    Candidates come from one pass that shuffles nothing; a second pass counts just them.
    """
    key = F.xxhash64(*on).alias("_key")
    found = hot_keys(df.select(key), "_key", share)
    if not found:
        return []
    counts = df.select(F.when(key.isin(found), key).alias("_key")).groupBy("_key").count().collect()
    total = sum(line["count"] for line in counts)
    return [line["_key"] for line in counts if line["_key"] is not None and line["count"] > share * total]


def _salted(
    big: DataFrame, small: DataFrame, on: Sequence[str], salts: int, row_id: Sequence[str] = ()
) -> DataFrame:
    left = big.withColumn("_salt", spread(big, salts, row_id))
    right = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [*on, "_salt"]).drop("_salt")


def outer(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str, share: float = 0.01, salts: int = 32, rows_without: bool = False
) -> DataFrame:
    """Left, right or full outer join; with ``rows_without`` only the rows that have no partner."""
    if how not in ("left", "right", "full"):
        raise ValueError(f"not an outer join: {how}")
    on = list(on)
    names = [*on, *[c for c in left.columns if c not in on], *[c for c in right.columns if c not in on]]
    key = F.xxhash64(*on)
    hot_left, hot_right = _hot(left, on, share), _hot(right, on, share)
    hot = sorted({*hot_left, *hot_right})
    in_left, in_right = left.withColumn("_l", F.lit(True)), right.withColumn("_r", F.lit(True))
    if hot:
        in_left, in_right = in_left.where(~key.isin(hot)), in_right.where(~key.isin(hot))
    out = in_left.join(in_right, on, how)
    if rows_without:
        out = out.where(F.col("_l").isNull() | F.col("_r").isNull())
    out = out.select(*names)
    if not hot:
        return out
    lefts, rights = left.where(key.isin(hot)), right.where(key.isin(hot))
    if not rows_without:
        mine = key.isin(hot_left) if hot_left else F.lit(False)
        out = out.unionByName(_salted(lefts.where(mine), rights.where(mine), on, salts).select(*names))
        out = out.unionByName(_salted(rights.where(~mine), lefts.where(~mine), on, salts).select(*names))
    # The hot keys that a side has: a table with a line per key. Null meets no partner.
    for side, other, wanted in ((lefts, rights, how != "right"), (rights, lefts, how != "left")):
        if wanted:
            alone = side.join(F.broadcast(other.select(*on).distinct()), on, "left_anti")
            out = out.unionByName(alone, allowMissingColumns=True)
    return out


def left_outer(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    return outer(left, right, on, "left")


def right_outer(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    return outer(left, right, on, "right")


def full_outer(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    return outer(left, right, on, "full")


def anti_both(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of either side that have no partner on the other."""
    return outer(left, right, on, "full", rows_without=True)


def replicated(
    big: DataFrame, small: DataFrame, on: Sequence[str], how: str = "inner", max_rows: int = 100_000, max_bytes: int = 64 << 20
) -> DataFrame:
    """Map-side inner or left join: copy ``small`` to every executor if it is within both bounds.

    Rows and their bytes (as JSON text) are counted first, of at most ``max_rows + 1`` rows; a larger side is
    joined by shuffle, with the same result.
    """
    if how not in ("inner", "left"):
        raise ValueError("a copied side can only be joined inner or left")
    size = F.sum(F.octet_length(F.to_json(F.struct("*"))))
    n, used = small.limit(max_rows + 1).agg(F.count("*"), size).first()
    if n <= max_rows and (used or 0) <= max_bytes:
        return big.join(F.broadcast(small), list(on), how)
    return left_outer(big, small, on) if how == "left" else inner(big, small, on)


def bucketed(
    left: DataFrame, right: DataFrame, key: str, buckets: int, how: str = "inner", share: float = 0.01, salts: int = 32
) -> DataFrame:
    """Composite join: both sides written in buckets, one sorted file each, and merged without shuffle or sort.

    Spark trusts the order of the files if ``spark.sql.legacy.bucketedTableScan.outputOrdering`` is on, as in
    ``session.SETTINGS``; else it sorts each bucket again.
    ``buckets`` is sized to the input (a bucket is one task's work). Keys with more than ``share`` of a side's
    rows, which would make a bucket too large, and rows with a null key stay out of the buckets.
    """
    spark = left.sparkSession
    hot = sorted({*_hot(left, [key], share), *_hot(right, [key], share)})
    apart = F.col(key).isNull() | (F.xxhash64(key).isin(hot) if hot else F.lit(False))  # null has no bucket of its own
    tables = []
    for label, side in (("left", left), ("right", right)):
        name = fresh_name(spark, f"bucketed_{label}")
        (
            side.where(~apart).repartition(buckets, key)
            .write.bucketBy(buckets, key).sortBy(key).option("path", fresh_dir(spark, name)).format("parquet").saveAsTable(name)
        )
        tables.append(spark.table(name))
    merged = tables[0].hint("merge").join(tables[1], key, how)
    lefts, rights = left.where(apart), right.where(apart)
    others = _salted(lefts, rights, [key], salts) if how == "inner" else outer(lefts, rights, [key], how, share, salts)
    return merged.unionByName(others.select(*merged.columns))


def cogroup_values(
    left: DataFrame, right: DataFrame, key: str, left_value: str, right_value: str, ids: tuple[str, str]
) -> DataFrame:
    """All values of both sides per key in long form: (key, side, position, value), sorted by value.

    A key's values on either side may be any number; ``side`` is left or right.
    """
    parts = []
    for side, value, row_id, name in ((left, left_value, ids[0], "left"), (right, right_value, ids[1], "right")):
        rows = side.select(F.col(key).alias("key"), F.col(value).alias("value"), F.col(row_id).alias("_id"))
        placed = rank_in_group(rows, ["key"], ["value", "_id"], "position")
        parts.append(placed.select("key", F.lit(name).alias("side"), "position", "value"))
    return parts[0].unionByName(parts[1])
