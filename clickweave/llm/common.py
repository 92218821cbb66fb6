"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable
from functools import wraps
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickweave.workspace import fresh_dir, scope, stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Only the two columns an operator needs, as ``doc_id`` and ``text``; a null text is empty."""
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))


T = TypeVar("T")
_kept: list[tuple[str, object]] = []


def kept(name: str, make: Callable[[], T]) -> T:
    """The one object that a Python worker keeps between its tasks; another name takes the place of the one before."""
    if not _kept or _kept[0][0] != name:
        give_back()
        _kept.append((name, make()))
    return _kept[0][1]


def give_back() -> None:
    """Free what earlier tasks left in this Python worker, which lives on through the stages of other operators."""
    _kept.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim is not None:
        trim(0)


def tidy(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Run an operator whole, keep its result and remove the tables it made on the way."""

    @wraps(operator)
    def run(docs: DataFrame, *args, **settings) -> DataFrame:
        path = fresh_dir(docs.sparkSession, operator.__name__)
        with scope(docs.sparkSession):
            return stored(operator(docs, *args, **settings), "", path)

    return run


def in_order(df: DataFrame, *order: str | Column) -> DataFrame:
    """Range partitions, each sorted. An order that ends in a near-unique column spreads groups of any size."""
    return df.repartitionByRange(*order).sortWithinPartitions(*order)
