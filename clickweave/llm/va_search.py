"""Exact top-k by inner product with a vector-approximation file.

Components are whole numbers, floor(scale * x). Equal vectors are folded into one class with its smallest ids,
so a vector with any number of copies is scanned once. The approximation file holds one byte per component:
the number of the cell, between the component's smallest and largest value, in which the class lies.

1. Scan: the queries' classes meet the file in blocks. For a query the cells give a lower and an upper bound of
   each score; their difference is the same for all classes, so of every block the classes remain whose upper
   bound reaches the block's k-th largest lower bound.
2. Per query, the classes with the largest upper bounds have their exact vectors read first. The k-th exact
   score among them is certain to be reached, so of the others only those are read whose upper bound is not
   below it; no other can be among the first k.
3. Scores are exact integer products; ties go to the smaller id.

A block of the scan has a bounded number of queries and classes, whatever the tables' sizes; each side is
copied once for every block of the other, which a search of a growing query set in a growing table needs.

Vectors that are null or hold a null or non-finite component, and rows without an id, take no part. Shorter
vectors count as filled up with zeros. Equal rows are rows of their own: a query skips one row with its own id
in its own class. With fewer candidates than k, all are returned; without queries, nothing. Scores must fit
64 bits. Other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from clickweave.operators.ordering import top_per_group
from clickweave.workspace import stored

_CELLS = 256
CANDIDATES = "query long, class long, upper double"


def whole(vectors: DataFrame, vec_id: str, vector: str, scale: int) -> DataFrame:
    """(vec_id, v): the rows that take part, as whole numbers."""
    parts = F.transform(F.col(vector), lambda x: x.cast("double"))
    sound = F.forall(parts, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), parts.alias("x")).where(
        F.col("vec_id").isNotNull() & F.col("x").isNotNull() & sound
    )
    return rows.select("vec_id", F.transform("x", lambda x: F.floor(x * scale).cast("long")).alias("v"))


def _padded(vectors: pd.Series, size: int) -> np.ndarray:
    out = np.zeros((len(vectors), size))
    for row, v in enumerate(vectors):
        out[row, : len(v)] = v
    return out


def quantised(classes: DataFrame, low: np.ndarray, width: np.ndarray) -> DataFrame:
    """The approximation file: (class, cells)."""

    def coded(batches):
        for batch in batches:
            v = _padded(batch["v"], len(low))
            cells = np.clip(np.floor((v - low) / width), 0, _CELLS - 1).astype("u1")
            yield pd.DataFrame({"class": batch["class"], "cells": [c.tobytes() for c in cells]})

    return classes.select("class", "v").mapInPandas(coded, "class long, cells binary")


def scan(asked: DataFrame, file: DataFrame, low: np.ndarray, width: np.ndarray, k: int, asked_block: int, file_block: int) -> DataFrame:
    """(query, class, upper) of classes that may be among the first ``k`` of their block, by bounds from cells."""
    rows, columns = (max(1, math.ceil(df.count() / size)) for df, size in ((asked, asked_block), (file, file_block)))
    across = F.explode(F.sequence(F.lit(0), F.lit(columns - 1)))
    down = F.explode(F.sequence(F.lit(0), F.lit(rows - 1)))
    queries = asked.select("class", "v", F.pmod(F.xxhash64("class"), F.lit(rows)).cast("int").alias("r"), across.alias("c"))
    cells = file.select("class", "cells", F.pmod(F.xxhash64("class"), F.lit(columns)).cast("int").alias("c"), down.alias("r"))

    def bounds(key: tuple, mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        if not len(mine) or not len(theirs):
            return pd.DataFrame({"query": [], "class": [], "upper": []})
        q = _padded(mine["v"], len(low))
        floor = np.frombuffer(b"".join(theirs["cells"]), "u1").reshape(len(theirs), -1) * width + low
        gap = np.abs(q) @ width  # upper bound less lower bound
        gap += 1e-9 * (np.abs(q) @ np.maximum(np.abs(low), np.abs(low + _CELLS * width)))  # rounding
        lower = q @ floor.T + (np.minimum(q, 0) @ width)[:, None]
        names, found = theirs["class"].to_numpy(), []
        for row, name in enumerate(mine["class"]):
            best = lower[row]
            kth = np.partition(best, len(best) - k)[len(best) - k] if len(best) > k else -np.inf
            at = np.flatnonzero(best + gap[row] >= kth - gap[row] * 1e-9)
            found.append(pd.DataFrame({"query": name, "class": names[at], "upper": best[at] + gap[row]}))
        return pd.concat(found)

    return queries.groupBy("r", "c").cogroup(cells.groupBy("r", "c")).applyInPandas(bounds, CANDIDATES)


def product(a: str, b: str) -> Column:
    """Exact inner product; the shorter vector counts as filled up with zeros."""
    terms = F.zip_with(a, b, lambda x, y: F.coalesce(x, F.lit(0)) * F.coalesce(y, F.lit(0)))
    return F.aggregate(terms, F.lit(0).cast("long"), lambda s, x: s + x)


def search(
    vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, vec_id: str = "vec_id", vector: str = "embedding",
    asked_block: int = 512, file_block: int = 8192,
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score: the ``k`` best other rows of every row with ``is_query``.

    ``is_query`` is a condition on ``vec_id``.
    """
    rows = stored(whole(vectors, vec_id, vector, scale), "whole-vectors")
    # Every class with its k + 1 smallest ids; a task cuts its groups to k + 1 rows before they move.
    few = top_per_group(rows, ["v"], ["vec_id"], k + 1, "place")
    classes = few.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    classes = stored(classes.withColumn("class", F.monotonically_increasing_id()), "classes")
    sides = classes.select(F.posexplode("v").alias("j", "x")).groupBy("j").agg(F.min("x").alias("a"), F.max("x").alias("b"))
    spans = {line["j"]: (line["a"], line["b"]) for line in sides.toArrow().to_pylist()}  # one line per component
    size = max(spans, default=-1) + 1
    whole_size = classes.where(F.size("v") < size).isEmpty()  # a shorter vector makes zero a value of the components it lacks
    ends = np.array([spans[j] if whole_size else (min(0, spans[j][0]), max(0, spans[j][1])) for j in range(size)], float).reshape(size, 2)
    low, width = ends[:, 0], np.maximum((ends[:, 1] - ends[:, 0]) / (_CELLS - 1), 1e-9)

    query_rows = rows.where(is_query)
    asked = stored(classes.join(query_rows.select("v").distinct(), "v", "left_semi").select("class", "v"), "asked")
    file = stored(quantised(classes, low, width), "approximation")
    found = stored(scan(asked, file, low, width, k + 1, asked_block, file_block), "bounds")

    exact = classes.select("class", "v", "ids")
    wanted = asked.select(F.col("class").alias("query"), F.col("v").alias("q"))
    score = product("q", "v").alias("score")
    first = top_per_group(found, ["query"], [F.desc("upper"), "class"], k + 1, "place")
    read = first.join(exact, "class").join(wanted, "query").select("query", "place", score)
    # With fewer than k + 1 classes nothing is certain, and all candidates are read.
    certain = read.groupBy("query").agg(F.when(F.count("*") == k + 1, F.min("score")).alias("certain"))
    certain = stored(certain, "certain")
    rest = found.join(certain, "query").where(F.col("certain").isNull() | (F.col("upper") >= F.col("certain")))
    scored = rest.select("query", "class").join(exact, "class").join(wanted, "query").select("query", "class", "ids", score)
    each = scored.select("query", "class", "score", F.explode("ids").alias("vec_id"))
    best = top_per_group(each, ["query"], [F.desc("score"), "vec_id", "class"], k + 1, "place")
    lists = best.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("place", "class", "vec_id", "score"))).alias("best"))
    lists = stored(lists.join(wanted, "query"), "answers")

    # Every query row takes its class's answer, less one row with its own id and vector.
    told = query_rows.join(lists, F.col("v") == F.col("q"))
    own = F.filter("best", lambda b: (b["class"] == F.col("query")) & (b["vec_id"] == F.col("query_id")))
    told = told.withColumnRenamed("vec_id", "query_id")
    skipped = F.coalesce(F.try_element_at(F.transform(own, lambda b: b["place"]), F.lit(1)), F.lit(k + 1))
    others = F.slice(F.filter("best", lambda b: b["place"] != skipped), 1, k)
    return told.select("query_id", F.posexplode(others).alias("at", "b")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("b.vec_id").alias("vec_id"), F.col("b.score").alias("score")
    )
