"""Sharding by bytes: the contiguous partition whose largest shard is as small as it can be.

Documents with equal texts form one atomic group. Groups lie in the order of their digests; the smallest
capacity for which a greedy fill needs no more than the wanted shards is found by binary search. That capacity
stays the limit of every shard; within it each cut is as near as it can be to an equal share of the bytes that
are left, where a backward greedy fill shows that the rest fits the shards that are left. So one hot group
does not leave other shards empty.

Rows are sorted by (digest, doc_id) into range partitions, so a group of any size lies over several of them;
running sums inside a partition and a table with one line per partition give every row its place. The
greedy check needs the bytes before a group only near its cuts: the driver holds a bounded number of
(group, bytes before) points, walks over them, and where a walk meets a gap fetches finer points inside it, at least one new one each time. So it
fetches ``points`` numbers at a time (at least four a shard), and as many times as the searches' logarithms.

A null text has no bytes and lies in the group of the empty text. A size is the UTF-8 bytes plus one. Equal
rows and rows without a doc_id are rows like others. An empty table gives an empty result; shards without
groups stay empty.
"""

from __future__ import annotations

import bisect
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from clickweave.llm.common import in_order
from clickweave.workspace import stored

_RUN = "doc_id long, size long, text_crc32 long, part int, row long, bytes long, grp long, starts boolean, digest binary"


def _running(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Running counts of rows, bytes and groups inside a sorted partition."""
    part = TaskContext.get().partitionId()
    rows, size, groups, last = 0, 0, -1, None
    for batch in batches:
        if not len(batch):
            continue
        digests = batch["digest"].to_numpy(object)
        starts = np.empty(len(batch), bool)
        starts[0] = digests[0] != last
        starts[1:] = digests[1:] != digests[:-1]
        sizes = batch["size"].to_numpy(np.int64)
        batch["part"] = part
        batch["row"] = rows + np.arange(len(batch))
        batch["bytes"] = size + np.cumsum(sizes) - sizes
        batch["grp"] = groups + np.cumsum(starts)
        batch["starts"] = starts
        rows, size, groups, last = rows + len(batch), size + int(sizes.sum()), groups + int(starts.sum()), digests[-1]
        yield batch


def placed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row with its global place: doc_id, size, text_crc32, row, bytes (before it), grp, starts."""
    said = F.coalesce(F.col(text), F.lit(""))
    keyed = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), (F.octet_length(said) + 1).cast("long").alias("size"),
        F.crc32(said.cast("binary")).alias("text_crc32"), F.unhex(F.sha2(said, 256)).alias("digest"),
    )
    keyed = stored(keyed, "sizes")
    run = stored(in_order(keyed, "digest", "doc_id").mapInPandas(_running, _RUN), "sized-run")
    # One line per range partition, so its size is that of spark.sql.shuffle.partitions.
    lines = (
        run.groupBy("part")
        .agg(F.count("*").alias("rows"), F.sum("size").alias("bytes"), F.max("grp").alias("grp"),
             F.min_by("digest", "row").alias("first"), F.max_by("digest", "row").alias("last"))
        .orderBy("part").collect()
    )
    offsets, rows, size, groups, last = [], 0, 0, 0, None
    for line in lines:
        goes_on = last is not None and bytes(line["first"]) == bytes(last)
        offsets.append((line["part"], rows, size, groups - int(goes_on), goes_on))
        rows, size, groups, last = rows + line["rows"], size + line["bytes"], groups - int(goes_on) + line["grp"] + 1, line["last"]
    table = docs.sparkSession.createDataFrame(offsets, "part int, rows0 long, bytes0 long, grp0 long, goes_on boolean")
    return run.join(F.broadcast(table), "part").select(
        "doc_id", "size", "text_crc32", (F.col("row") + F.col("rows0")).alias("row"), (F.col("bytes") + F.col("bytes0")).alias("bytes"),
        (F.col("grp") + F.col("grp0")).alias("grp"), (F.col("starts") & ~((F.col("row") == 0) & F.col("goes_on"))).alias("starts"),
    )


class Points:
    """What the driver knows of the groups' borders: bytes and rows before some of the groups.

    ``fetch(wanted)`` returns (group, bytes before, rows before) of the groups asked for. Each call of ``add`` asks
    for at least one border nobody has fetched, and for about ``points`` at most, so every search ends.
    """

    def __init__(self, fetch: Callable[[list[int]], list[tuple[int, int, int]]], groups: int, total: int, count: int, points: int):
        self.fetch, self.points, self.turns = fetch, points, 0
        self.known = {0: (0, 0), groups: (total, count)}
        self._sort()
        if groups > 1:
            self.add([(0, groups)])

    def _sort(self) -> None:
        self.groups = sorted(self.known)
        self.bytes = [self.known[g][0] for g in self.groups]

    def add(self, ranges: list[tuple[int, int]]) -> None:
        """Fetch borders inside the ranges: each gap between known ones is cut evenly, wide gaps more often."""
        gaps = set()
        for a, b in ranges:
            low, high = bisect.bisect_right(self.groups, a) - 1, bisect.bisect_left(self.groups, b)
            gaps.update((c, d) for c, d in zip(self.groups[low:high], self.groups[low + 1 : high + 1]) if d - c > 1)
        # Where a range holds more gaps than may be fetched from, the widest come first.
        chosen = sorted(gaps, key=lambda g: (g[0] - g[1], g))[: self.points]
        width, wanted = sum(d - c for c, d in chosen), []
        for c, d in chosen:
            parts = 1 + max(1, self.points * (d - c) // width)
            wanted += sorted({c + (d - c) * i // parts for i in range(1, parts)} - {c})
        assert wanted, "no gap left to look into"
        self._ask(wanted)

    def _ask(self, wanted: list[int]) -> None:
        for group, size, row in self.fetch(wanted):
            self.known[group] = (size, row)
        self.turns += 1
        self._sort()

    def bracket(self, limit: int) -> tuple[int, int]:
        """The last known border with at most ``limit`` bytes before it, and the next known one."""
        at = bisect.bisect_right(self.bytes, limit) - 1
        return self.groups[at], self.groups[min(at + 1, len(self.groups) - 1)]

    def settle(self, walk: Callable[[], tuple[object, list[tuple[int, int]]]]):
        """Repeat a walk over the known borders, with finer ones each time, until it meets no gap."""
        while True:
            found, gaps = walk()
            if not gaps:
                return found
            self.add(gaps)

    def reaches(self, capacity: int, shards: int) -> bool:
        """Whether a greedy fill of ``shards`` shards reaches the end."""

        def walk():
            # The true end of each shard lies between ``low`` and ``high``.
            low, high, gaps = 0, 0, []
            for _ in range(shards):
                a, b = self.bracket(low + capacity)
                c, d = self.bracket(high + capacity)
                gaps += [g for g in ((a, b), (c, d)) if g[1] - g[0] > 1]
                low, high = self.known[a][0], self.known[c][0] if d - c <= 1 else high + capacity
            if low >= self.bytes[-1] or high < self.bytes[-1]:
                return low >= self.bytes[-1], []
            return False, gaps

        return self.settle(walk)

    def cuts(self, capacity: int, shards: int) -> list[int]:
        """First groups of shards 1, 2, ...: each cut as near as it can be to an equal share of what is left, where
        the shard keeps within ``capacity`` and the rest fits the shards that are left."""
        groups, total = self.groups[-1], self.bytes[-1]
        if last := [g for g in range(max(1, groups - shards + 1), groups) if g not in self.known]:
            self._ask(last)

        def back():
            # latest[j]: the first border from which j shards are enough
            latest, gaps = [groups], []
            for _ in range(shards - 1):
                start = self.known[latest[-1]][0] - capacity
                a, b = self.bracket(start - 1) if start > 0 else (0, 0)
                gaps += [(a, b)] * (b - a > 1)
                latest.append(b)
            return latest, gaps

        latest = self.settle(back)

        def forth():
            at, cut, gaps = 0, [], []
            for left in range(shards - 1, 0, -1):
                here = self.known[at][0]
                want = here + (total - here) // (left + 1)
                a, b = self.bracket(want)
                c, d = self.bracket(here + capacity)
                e, f = self.bracket(here)
                gaps += [g for g in ((a, b), (c, d), (e, f)) if g[1] - g[0] > 1]
                near = b if self.known[b][0] - want < want - self.known[a][0] else a
                # at least one group a shard, as long as there are enough of them
                near = min(max(near, latest[left], f), c)
                at = min(near, groups - left) if groups - left > at else near
                cut.append(at)
            return cut, gaps

        return self.settle(forth)


def smallest_capacity(points: Points, shards: int, least: int, most: int) -> int:
    """Binary search between a lower bound and a capacity that is enough."""
    while least < most:
        middle = (least + most) // 2
        least, most = (least, middle) if points.reaches(middle, shards) else (middle + 1, most)
    return most


def _from_table(starts: DataFrame) -> Callable[[list[int]], list[tuple[int, int, int]]]:
    """Fetches borders from a table (grp, bytes, row) sorted by grp: Parquet skips what lies outside the ranges."""

    def fetch(wanted: list[int]) -> list[tuple[int, int, int]]:
        wanted = sorted(wanted)
        step = -(-len(wanted) // 32)
        inside = F.lit(False)
        for i in range(0, len(wanted), step):
            inside = inside | F.col("grp").between(wanted[i], wanted[min(i + step, len(wanted)) - 1])
        # At most about ``points`` numbers, so a copy may go to every task.
        asked = starts.sparkSession.createDataFrame(pd.DataFrame({"grp": np.array(wanted, np.int64)}))
        found = starts.where(inside).join(F.broadcast(asked), "grp").select("grp", "bytes", "row").toArrow()
        return list(zip(*(c.to_pylist() for c in found.columns)))

    return fetch


def shard_by_bytes(
    docs: DataFrame, shards: int = 8, doc_id: str = "doc_id", text: str = "text", points: int = 8192
) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot (its place in the shard, from 0) of every document."""
    rows = placed(docs, doc_id, text)
    sums = rows.groupBy("grp").agg(F.sum("size").alias("size"), F.count("*").alias("rows"))
    seen = sums.agg(F.count("*"), F.sum("size"), F.sum("rows"), F.max("size")).first()
    groups, total, count, largest = (int(x or 0) for x in seen)
    shard, first = F.lit(0), F.lit(0).cast("long")
    if groups:
        mean = -(-total // shards)
        # In the order of the groups, so a fetch skips the row groups outside its ranges.
        starts = stored(rows.where("starts").select("grp", "bytes", "row"), "group-starts")
        known = Points(_from_table(starts), groups, total, count, max(points, 4 * shards))
        capacity = smallest_capacity(known, shards, max(mean, largest), mean + largest)
        cuts = known.cuts(capacity, shards)
        borders = [(known.known[cut][1], number + 1) for number, cut in enumerate(cuts)]
        shard, first = _located(F.col("row"), borders)
    return rows.select("doc_id", "size", "text_crc32", shard.cast("int").alias("shard"), (F.col("row") - first).alias("slot"))


def _located(row: Column, borders: list[tuple[int, int]]) -> tuple[Column, Column]:
    """The shard that holds a row, and the first row of that shard, from (first row, shard) in order."""
    starts = F.array(*[F.lit(x).cast("long") for x in [0, *[start for start, _ in borders]]])
    shard = F.size(F.filter(starts, lambda x: x <= row)) - 1
    return shard, F.element_at(starts, shard + 1)
