"""Data organisation: nesting, binning, partitioning, anonymising, and multi-stage counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from clickweave.operators.joins import left_outer
from clickweave.operators.ordering import rank_in_group
from clickweave.sinks.writers import few_files
from clickweave.workspace import fresh_dir


def nest_children(
    parents: DataFrame,
    children: DataFrame,
    key: str,
    child: Sequence[str],
    row_id: Sequence[str],
    page_rows: int = 1000,
    name: str = "children",
) -> DataFrame:
    """Parents with their children as pages of a sorted list of structs.

    Every parent's children are numbered in order and come ``page_rows`` to a page, ``page`` counting from 0;
    a parent without children has page 0 with an empty list. Children without a parent are dropped.
    """
    order = [c for c in dict.fromkeys([*child, *row_id]) if c != key]
    numbered = rank_in_group(children.select(key, *order), [key], order, "_place")
    paged = numbered.withColumn("page", F.floor((F.col("_place") - 1) / page_rows))
    lists = paged.groupBy(key, "page").agg(F.sort_array(F.collect_list(F.struct(*child))).alias(name))
    empty = F.array().cast(lists.schema[name].dataType)
    nested = left_outer(parents, lists, [key])
    return nested.withColumn("page", F.coalesce("page", F.lit(0).cast("long"))).withColumn(name, F.coalesce(name, empty))


def question_answers(
    posts: DataFrame, key: str, is_question: Column, answer: Sequence[str], row_id: Sequence[str], page_rows: int = 1000
) -> DataFrame:
    """Questions with their answers nested; answers without a question are dropped."""
    questions = posts.where(is_question)
    answers = posts.where(~is_question)
    return nest_children(questions, answers, key, answer, row_id, page_rows, "answers")


def bins_of(bins: Mapping[str, Column]) -> Column:
    """One row per bin the record belongs to; a record of no bin is dropped."""
    return F.explode(F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in bins.items()])))


def binned(df: DataFrame, bins: Mapping[str, Column]) -> DataFrame:
    """Write every record to each bin it matches, one folder per bin, in one pass; the bins read back."""
    return by_folder(df.withColumn("bin", bins_of(bins)), "bin", "bins")


def by_folder(df: DataFrame, column: str, label: str, gather: bool = False) -> DataFrame:
    """Write ``df`` with one folder per value of ``column`` and read it back.

    Tasks write their own file in each folder, so a value with very many rows needs no task of its own.
    With many folders, ``gather`` brings the rows of each together first.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, label)
    (few_files(df, column) if gather else df).write.partitionBy(column).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def anonymized(df: DataFrame, drop: Sequence[str], dates: Sequence[str]) -> DataFrame:
    """Without the identifying columns, times cut to days."""
    out = df.drop(*drop)
    for name in dates:
        out = out.withColumn(name, F.to_date(name))
    return out


def shuffled(df: DataFrame, seed: int) -> DataFrame:
    """Rows in random order."""
    return df.orderBy(F.rand(seed))


def posts_per_user(posts: DataFrame, user: str) -> DataFrame:
    return posts.where(F.col(user).isNotNull()).groupBy(user).agg(F.count("*").alias("posts"))


def posts_against_mean(posts: DataFrame, users: DataFrame, user: str) -> DataFrame:
    """Users below or at least at the mean number of posts, with their reputation (null if unknown)."""
    counts = posts_per_user(posts, user)
    mean = counts.agg(F.avg("posts")).scalar()
    side = F.when(F.col("posts") < mean, "below").otherwise("above")
    return counts.join(users, user, "left").withColumn("bin", side)


def reputation_by_bin(binned_users: DataFrame) -> DataFrame:
    return binned_users.groupBy("bin").agg(
        F.count("*").alias("users"), F.round(F.avg("reputation"), 4).alias("mean_reputation")
    )


def folded_chain(posts: DataFrame, users: DataFrame, user: str, limit: float = 5000) -> DataFrame:
    """Posts per user, only for users with a reputation, summed per (posts, reputation), binned at ``limit``."""
    enriched = posts_per_user(posts, user).join(users, user)
    sums = enriched.groupBy("posts", "reputation").agg(F.sum("posts").alias("total"))
    return sums.withColumn("bin", F.when(F.col("reputation") < limit, "below").otherwise("above"))


def anonymized_and_distinct(df: DataFrame, user: str, drop: Sequence[str], dates: Sequence[str]) -> DataFrame:
    """Two outputs of one scan: anonymised records, copies kept, and distinct users.

    Both are written from one pass, a folder each; only the small column of users is made distinct.
    """
    kept = [c for c in df.columns if c not in drop]
    days = {c: F.to_date(c) if c in dates else F.col(c) for c in kept}
    record = F.to_json(F.struct(*[days[c].alias(c) for c in kept]))
    outputs = F.explode(
        F.array(
            F.struct(F.lit("anonymized").alias("output"), record.alias("value")),
            F.struct(F.lit("distinct").alias("output"), F.col(user).cast("string").alias("value")),
        )
    ).alias("o")
    both = by_folder(df.select(outputs).select("o.output", "o.value"), "output", "merged")
    users = both.where("output = 'distinct' AND value IS NOT NULL").distinct()
    return both.where("output = 'anonymized'").unionByName(users)


def in_few_files(df: DataFrame, label: str = "few-files") -> DataFrame:
    """Write the little that a selective filter leaves as few files: the scan keeps all its tasks, and the
    rows left over are brought together in partitions of the advisory size."""
    spark = df.sparkSession
    path = fresh_dir(spark, label)
    few_files(df).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
