"""From documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as
the next one's documents:

1. ``quality``: documents that the quality classifier rejects go.
2. ``exact_dedup``: of equal texts (after lower-casing A-Z) the one with the largest doc_id stays.
3. ``near_dedup``: of each component of near duplicates (five-word shingles, similarity 0.8) the document with
   the smallest doc_id stays (ties, and documents without one: the first row in the files' order). Rows are told apart
   by their place in the files, so rows that share a doc_id, or have none, are documents like others.
4. ``mix``: documents come in an order that follows the target weights of their sources at every point.
5. ``pack``: texts become tokens, packed into sequences of 2048, which are numbered in the order of stage 4: the
   stage's files are read in the order of their part numbers, and their rows by their place in the file. Blocks are
   about 1,024 pieces, so sequences leave the order by no more than that.

All columns of documents pass through stages 1 to 4. Nulls, empty texts, ties, equal rows and empty tables are
treated as the operators' docstrings say.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickweave.llm import best_fit, divide_skip, mph_dedup, pfair_mix, quality
from clickweave.llm.common import table
from clickweave.llm.queries import MIX_WEIGHTS, SEQUENCE, TOKENIZER
from clickweave.workspace import fresh_dir, scope, stored


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mph_dedup.keep_one(docs)


def in_file_order(docs: DataFrame) -> DataFrame:
    """``docs`` with ``place``, a number that rises with a row's file's number and its row in the file.

    No two rows share one, and it is the same in every job. Spark reads files by size, not by name. The names, one per
    file, are sorted on the driver.
    """
    at = docs.metadataColumn("_metadata")
    rows = docs.select(F.struct(*docs.columns).alias("whole"), at["file_path"].alias("file"), at["row_index"].alias("row"))
    files = [r["file"] for r in rows.select("file").distinct().collect()]
    # numbers in names count as numbers, so part-100000 comes after part-99999
    files.sort(key=lambda name: [int(x) if x.isdecimal() else x for x in re.split(r"([0-9]+)", name)])
    numbers = docs.sparkSession.createDataFrame(list(enumerate(files)), "number long, name string")
    placed = rows.join(F.broadcast(numbers), F.col("file") == F.col("name"))
    return placed.select("whole", (F.shiftleft("number", 40) + F.col("row")).alias("place"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = in_file_order(docs)
    named = rows.select(F.col("place").alias("doc_id"), "whole.text", F.col("whole.doc_id").cast("long").alias("name"))
    found = stored(divide_skip.jaccard_components(named), "near-duplicates")
    names = named.select("doc_id", "name")
    # Components of one row need no choice; of the others, which are few, the row with the smallest name stays.
    shared = found.where(F.col("doc_id") != F.col("component_id"))
    grouped = stored(shared.select("doc_id", "component_id").union(
        shared.select(F.col("component_id").alias("doc_id"), "component_id").distinct()), "grouped")
    grouped = grouped.join(names, "doc_id").select("component_id", F.struct(F.col("name").isNull(), "name", "doc_id").alias("by"))
    grouped = stored(grouped, "named")
    first = grouped.groupBy("component_id").agg(F.min("by").alias("first"))
    others = grouped.join(first, "component_id").where(F.col("by") != F.col("first")).select(F.col("by.doc_id").alias("_other"))
    return rows.join(others, rows["place"] == F.col("_other"), "left_anti").select("whole.*")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pfair_mix.mixed(docs, weights=MIX_WEIGHTS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = in_file_order(docs).select("whole.doc_id", "whole.text", "place")
    return best_fit.pack(rows, TOKENIZER, **SEQUENCE, order="place", block_rows=1024)


STAGES = [("quality", keep_quality), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("mix", mix), ("pack", pack)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again; what a stage made on the way goes with it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_dir(spark, f"stage-{name}")
        with scope(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
