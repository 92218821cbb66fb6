"""Order-based operators that never put a whole group, or the whole table, into one task.

A sort key that ends in a unique column makes range partitions of even size whatever the keys look
like: one key with a third of the rows is simply spread over many neighbouring partitions. The
sorted run is written once; positions, ranks and neighbours are then read off it with small
per-partition side tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from clickweave.functions.hashing import salt
from clickweave.operators.skew import join_keyed
from clickweave.workspace import stored

_IN_PARTITION_BITS = 33  # layout of monotonically_increasing_id
CUT_BEFORE_SHUFFLE = 1000  # Spark's windowGroupLimitThreshold


def sorted_run(df: DataFrame, order: Sequence[Column | str], partitions: int | None = None) -> DataFrame:
    """Total-order sort: range partitions, each sorted, with ``_part`` and ``_row`` marking the place."""
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    run = ranged.sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id())
    run = stored(run, "run")
    return run.select(
        *df.columns,
        F.shiftright("_place", _IN_PARTITION_BITS).cast("int").alias("_part"),
        F.col("_place").bitwiseAND(F.lit((1 << _IN_PARTITION_BITS) - 1)).alias("_row"),
    )


def _with_position(run: DataFrame, name: str) -> DataFrame:
    """Global 1-based position; the offsets table has one row per range partition, so it may be broadcast."""
    sizes = run.groupBy("_part").agg(F.count("*").alias("_size"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    return run.join(F.broadcast(offsets), "_part").withColumn(name, F.col("_offset") + F.col("_row") + 1)


def with_position(
    df: DataFrame, order: Sequence[Column | str], name: str = "position", partitions: int | None = None
) -> DataFrame:
    """``row_number() over (order by ...)`` as a distributed sort. ``order`` must end in a unique column."""
    placed = _with_position(sorted_run(df, order, partitions), name)
    return placed.select(*df.columns, name)


def rank_in_group(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    name: str = "rank",
    partitions: int | None = None,
) -> DataFrame:
    """``row_number() over (partition by keys order by ...)`` for groups of any size."""
    placed = _with_position(sorted_run(df, [*keys, *order], partitions), "_position")
    firsts = placed.groupBy(*keys).agg(F.min("_position").alias("_first"))
    ranked = _join_firsts(placed, firsts, keys)
    return ranked.select(*df.columns, (F.col("_position") - F.col("_first") + 1).alias(name))


def _join_firsts(placed: DataFrame, firsts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with the first position of their group; null is a group too, so keys are joined as structs."""
    left = placed.withColumn("_group", F.struct(*keys))
    right = firsts.select(F.struct(*keys).alias("_group"), "_first")
    return join_keyed(left, right, ["_group"])


def with_previous(
    df: DataFrame, order: Sequence[Column | str], columns: Sequence[str], name: str = "previous"
) -> DataFrame:
    """The row before, in total order, as a struct of ``columns``.

    Inside a range partition this is ``lag``; the first row of a partition takes the last row of the
    one before it from a table with one row per partition.
    """
    run = sorted_run(df, order)
    here = F.struct(*columns)
    inside = run.withColumn("_before", F.lag(here).over(W.partitionBy("_part").orderBy("_row")))
    tails = run.groupBy("_part").agg(F.max_by(here, "_row").alias("_tail"))
    seams = tails.select("_part", F.lag("_tail").over(W.orderBy("_part")).alias("_seam"))
    return inside.join(F.broadcast(seams), "_part").select(
        *df.columns, F.coalesce("_before", "_seam").alias(name)
    )


def top_rows(df: DataFrame, order: Sequence[Column | str], n: int) -> DataFrame:
    """The first ``n`` rows of the table; each task keeps at most ``n``."""
    return df.orderBy(*order).limit(n)


def _first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], n: int, name: str) -> DataFrame:
    window = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window)).where(F.col(name) <= n)


def top_per_group(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    n: int,
    name: str = "rank",
    spread: Sequence[str] = (),
    salts: int = 64,
) -> DataFrame:
    """The first ``n`` rows of each group.

    For a small constant ``n`` every task cuts its groups to ``n`` rows before the shuffle. Spark does so
    up to ``windowGroupLimitThreshold``; beyond it ``spread`` must name unique columns, and a group of any size is
    numbered over range partitions instead. With ``spread`` and a small ``n``, each group is ranked in ``salts``
    parts first, and only the first ``n`` of each part are ranked together.
    """
    if n > CUT_BEFORE_SHUFFLE:
        if not spread:
            raise ValueError(f"beyond {CUT_BEFORE_SHUFFLE} rows per group, name unique columns in spread")
        return rank_in_group(df, keys, [*order, *spread], name).where(F.col(name) <= n)
    if spread:
        parts = df.withColumn("_salt", salt(salts, *spread))
        df = _first_rows(parts, [*keys, "_salt"], order, n, "_in_part").drop("_salt", "_in_part")
    return _first_rows(df, keys, order, n, name)


def top_values(df: DataFrame, key: str, value: str, n: int, tie: Sequence[str], name: str = "values") -> DataFrame:
    """The ``n`` largest values of each key as one list, largest first."""
    best = top_per_group(df, [key], [F.desc(value), *tie], n, "_rank")
    return best.groupBy(key).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_rank", value))), lambda p: p[value]).alias(name)
    )


def top_after_changes(old: DataFrame, changed: DataFrame, groups: Sequence[str], item: str, count: str, n: int) -> DataFrame:
    """The top ``n`` of every group that changed, where counts only grow.

    ``old`` has the top ``n`` before (groups, item, count and more), ``changed`` the new counts of the items that have
    grown. An item outside both stands behind ``n`` others as before, so ranking them alone is enough: at most ``n`` rows
    a group plus the changes. Ties go to the smaller item.
    """
    names = [*groups, item, count]
    touched = changed.select(*groups).distinct()
    still = old.select(*names).join(touched, list(groups), "left_semi").join(changed.select(*groups, item), [*groups, item], "left_anti")
    return top_per_group(still.unionByName(changed.select(*names)), groups, [F.desc(count), F.asc(item)], n)
