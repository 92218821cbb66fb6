"""N-gram Jaccard join by T-occurrence search with DivideSkip.

A document is the set of its distinct shingles (64-bit hashes of five words); two link when the sets' Jaccard
similarity reaches ``percent``. The result is one component per document, not pairs.

1. Equal sets are one class (known by 64 hash bits); from here on a class stands for its documents.
2. Shingles are ordered from rare to frequent by counts over all documents in 2^20 buckets (a fixed size), then
   by hash. Two sets that link share a shingle among the first ``n - ceil(percent n) + 1`` of each. Rows
   (shingle, size, class) of these are sorted over range partitions. Inside the list of a shingle, classes near
   enough in size for a link form runs. Equal short runs are folded, and their members are tied where a sketch
   allows it: counts of shingles in about ``n / 8`` bins, which differ by no more than the sets do. Members of long
   runs are tied to the first. The components of the ties are clusters; no link leaves a cluster. No long list is
   ever gathered.
3. A cluster is dealt to blocks of about ``block_docs`` classes, each with copies of a few pivots. A task
   takes one block at a time, builds its inverted index and searches it: for a set of size n, documents that
   occur on at least T = ceil(percent n) of its lists. DivideSkip puts the L longest lists aside, merges the
   short ones with a heap that skips what cannot occur T - L times, and probes the long ones by binary
   search. Sets that are already in the block's largest component need no search of their own: each link
   between components has an end outside.
4. Where a cluster has several blocks, classes outside its largest component are searched in all of its blocks,
   for the same reason. The components of all links are the result.

Work is linear in the documents and the lists of shared rare shingles; only a cluster with many classes that
share rare shingles and yet do not link costs (those classes) x (its blocks).

Null and empty texts, and texts without words, have no shingles, link with nothing and are their own
component. Rows without a doc_id link with nothing either; their component is null. Equal rows give equal result rows. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from clickweave.llm.common import give_back, in_order, texts, tidy
from clickweave.llm.components import components
from clickweave.operators.ordering import top_per_group
from clickweave.workspace import fresh_dir, scope, stored

_BUCKET_BITS = 20
_SLICE = 1 << 12  # counts that move together
_PIVOTS = 4
_FILTER_BITS, _FILTER_HASHES = 27, 2  # 16 MB
_SHORT = 64  # members of a run that are compared by their sketches
_PER_BIN = 8
_WORDS = 500_000  # word hashes kept by a worker
_MU = 0.0085  # weight of a binary probe against a heap step, from the published method
_STEP = np.uint64(0x9E3779B97F4A7C15)


class Shingler:
    """Sorted distinct 64-bit shingles of a text."""

    def __init__(self, words: int = 5):
        self.words, self.known = words, {}

    def __call__(self, text: str) -> np.ndarray:
        parts = text.encode().lower().split()  # bytes: A-Z only, and the six ASCII blanks
        if not parts:
            return np.empty(0, np.uint64)
        known = self.known
        if len(known) > _WORDS:
            known.clear()
        try:
            h = np.fromiter([known[p] for p in parts], np.uint64, len(parts))
        except KeyError:
            for p in parts:
                if p not in known:
                    known[p] = xxhash.xxh3_64_intdigest(p)
            h = np.fromiter([known[p] for p in parts], np.uint64, len(parts))
        width = min(self.words, len(parts))
        count = len(parts) - width + 1
        mixed = np.full(count, width, np.uint64)
        for i in range(width):
            mixed = (mixed ^ h[i : i + count]) * _STEP
            mixed ^= mixed >> np.uint64(29)
        return np.unique(mixed)


def class_of(shingles: np.ndarray) -> int:
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes()))))


def least_overlap(n: int, percent: int) -> int:
    """A set of size ``n`` shares at least this many shingles with any set it links with."""
    return -(-percent * n // 100)


def sketch(shingles: np.ndarray) -> bytes:
    """Counts of the shingles in a power of two of bins, about one bin for every eight, each at most 255."""
    bits = max(3, int(len(shingles) // _PER_BIN).bit_length())
    counts = np.bincount((shingles >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return np.minimum(counts, 255).astype("u1").tobytes()


def may_link(n: int, a: np.ndarray, m: int, b: np.ndarray, percent: int) -> bool:
    """Whether two sketches allow a link: sets that link differ in at most (100 - p) / (100 + p) of n + m shingles.

    The finer sketch is folded to the coarser. Clipped counts only bring sketches nearer, so no link is lost.
    """
    if len(a) > len(b):
        a = a.reshape(len(b), -1).sum(axis=1)
    elif len(b) > len(a):
        b = b.reshape(len(a), -1).sum(axis=1)
    return (100 + percent) * int(np.abs(a - b).sum()) <= (100 - percent) * (n + m)


def links(n: int, m: int, common: int, percent: int) -> bool:
    return 100 * common >= percent * (n + m - common)


# --- T-occurrence search -------------------------------------------------------------------------------------


def merge_skip(lists: list[list[int]], least: int) -> list[tuple[int, int]]:
    """(id, occurrences) of the ids on at least ``least`` of the sorted lists.

    A heap holds the heads. When the smallest id occurs too rarely, ``least - 1`` heads are taken out and their
    lists jump to the smallest head that is left, since no id before it can occur often enough.
    """
    found, at = [], [0] * len(lists)
    heap = [(values[0], i) for i, values in enumerate(lists) if values]
    heapq.heapify(heap)
    while len(heap) >= least:
        smallest, taken = heap[0][0], []
        while heap and heap[0][0] == smallest:
            taken.append(heapq.heappop(heap)[1])
        if len(taken) >= least:
            found.append((smallest, len(taken)))
            target = smallest + 1
        else:
            while heap and len(taken) < least - 1:
                taken.append(heapq.heappop(heap)[1])
            if not heap:
                break
            target = max(heap[0][0], smallest + 1)
        for i in taken:
            at[i] = bisect_left(lists[i], target, at[i])
            if at[i] < len(lists[i]):
                heapq.heappush(heap, (lists[i][at[i]], i))
    return found


def divide_skip(lists: list[list[int]], least: int) -> list[tuple[int, int]]:
    """(id, occurrences) of the ids on at least ``least`` of the lists: short lists merged, long ones probed."""
    if least <= 0 or len(lists) < least:
        return []
    lists = sorted(lists, key=len)
    longest = len(lists[-1])
    aside = min(least - 1, int(least / (_MU * math.log2(max(2, longest)) + 1)))
    short, long = lists[: len(lists) - aside], lists[len(lists) - aside :]
    found = []
    for name, count in merge_skip(short, least - aside):
        left = len(long)
        for values in reversed(long):
            if count + left < least:
                break
            left -= 1
            i = bisect_left(values, name)
            count += i < len(values) and values[i] == name
        if count >= least:
            found.append((name, count))
    return found


class Block:
    """The inverted index of a few sets; ``least`` drops shingles that fewer of them have."""

    def __init__(self, sets: list[np.ndarray], least: int = 2):
        self.sets = sets
        sizes = [len(s) for s in sets]
        every = np.concatenate(sets) if sets else np.empty(0, np.uint64)
        owner = np.repeat(np.arange(len(sets)), sizes)
        order = np.argsort(every, kind="stable")
        every, owner = every[order], owner[order]
        starts = np.flatnonzero(np.diff(every, prepend=~every[:1]) != 0)
        ends = np.append(starts[1:], len(every))
        shared = ends - starts >= least
        self.lists = {int(every[a]): owner[a:b].tolist() for a, b in zip(starts[shared], ends[shared])}

    def search(self, own: np.ndarray, percent: int) -> list[int]:
        """Sets of the block that link with ``own``."""
        lists = [self.lists[s] for s in own.tolist() if s in self.lists]
        found = divide_skip(lists, least_overlap(len(own), percent))
        return [i for i, common in found if links(len(own), len(self.sets[i]), common, percent)]


class _Union:
    def __init__(self, n: int):
        self.parent, self.size = list(range(n)), [1] * n

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def tie(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        if i == j:
            return False
        if self.size[i] < self.size[j]:
            i, j = j, i
        self.parent[j], self.size[i] = i, self.size[i] + self.size[j]
        return True


def joined(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that join all sets of a block that are connected in it.

    Sets are searched until every set that was not is in the largest component.
    """
    block, union, found = Block(sets), _Union(len(sets)), []
    largest = 0
    waiting = list(range(len(sets)))
    while waiting:
        left = []
        for i in waiting:
            if union.size[union.root(i)] > 1 and union.root(i) == union.root(largest):
                left.append(i)
                continue
            for j in block.search(sets[i], percent):
                if union.tie(i, j):
                    found.append((i, j))
                    if union.size[union.root(i)] > union.size[union.root(largest)]:
                        largest = i
        # what was spared may have been overtaken by a larger component
        waiting = left if any(union.root(i) != union.root(largest) for i in left) else []
    return found


# --- the join ------------------------------------------------------------------------------------------------

SEEN = "doc_id long, n long, class long, sketch binary, slice int, counts binary"


def _first_pass(docs: DataFrame, words: int) -> DataFrame:
    """Per document (doc_id, n, class); per task its shingle counts in slices, each class of it once."""

    def seen(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        give_back()
        shingles, counts, told = Shingler(words), np.zeros(1 << _BUCKET_BITS, np.int64), set()
        for batch in batches:
            rows, held, size = [], [], 0
            for known, text in zip(batch["doc_id"].notna(), batch["text"]):
                s = shingles(text)
                name = (len(s), class_of(s))
                new = known and name not in told
                rows.append((*name, sketch(s) if new else None))
                if new:
                    told.add(name)
                    held.append((s >> np.uint64(64 - _BUCKET_BITS)).astype(np.int64))
                    size += len(s)
                if size > len(counts):
                    counts += np.bincount(np.concatenate(held), minlength=len(counts))
                    held, size = [], 0
            if held:
                counts += np.bincount(np.concatenate(held), minlength=len(counts))
            sizes, names, sketches = zip(*rows) if rows else ((), (), ())
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "n": sizes, "class": names, "sketch": sketches, "slice": -1, "counts": None})
        if told:
            parts = counts.astype("<u4").reshape(-1, _SLICE)
            none = pd.array([None] * len(parts), "Int64")
            yield pd.DataFrame({"doc_id": none, "n": 0, "class": 0, "sketch": None, "slice": range(len(parts)), "counts": [p.tobytes() for p in parts]})

    return docs.mapInPandas(seen, SEEN)


def _summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sums of equal slices, from rows sorted by slice; one sum is in memory at a time."""
    number, total = None, None
    for batch in batches:
        for i, counts in zip(batch["slice"], batch["counts"]):
            if i != number:
                if number is not None:
                    yield pd.DataFrame({"slice": [number], "counts": [total.tobytes()]})
                number, total = i, np.zeros(_SLICE, "<i8")
            total += np.frombuffer(counts, "<u4")
    if number is not None:
        yield pd.DataFrame({"slice": [number], "counts": [total.tobytes()]})


def shingle_counts(slices: DataFrame) -> np.ndarray:
    """How often shingles fall in each bucket; a table of fixed size, whatever the corpus."""
    counts = np.zeros(1 << _BUCKET_BITS, np.float32)
    dealt = slices.repartition("slice").sortWithinPartitions("slice")
    for line in dealt.mapInPandas(_summed, "slice int, counts binary").toArrow().to_pylist():
        at = line["slice"] * _SLICE
        counts[at : at + _SLICE] = np.frombuffer(line["counts"], "<i8")
    return counts


def _rare_first(docs: DataFrame, counts: np.ndarray, words: int, percent: int) -> DataFrame:
    """(shingle, n, class) of the rare shingles that two linking sets cannot all lack; each class once per task."""
    shared = docs.sparkSession.sparkContext.broadcast(counts)

    def rare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        give_back()
        shingles, told = Shingler(words), set()
        for batch in batches:
            parts = []
            for text in batch["text"]:
                s = shingles(text)
                name = (len(s), class_of(s))
                if not len(s) or name in told:
                    continue
                told.add(name)
                often = shared.value[(s >> np.uint64(64 - _BUCKET_BITS)).astype(np.int64)]
                first = s[np.argsort(often, kind="stable")[: len(s) - least_overlap(len(s), percent) + 1]]
                parts.append((first.view(np.int64), *name))
            sizes = [len(p[0]) for p in parts]
            yield pd.DataFrame({
                "shingle": np.concatenate([p[0] for p in parts]) if parts else np.empty(0, np.int64),
                "n": np.repeat(np.array([p[1] for p in parts], np.int64), sizes), "class": np.repeat(np.array([p[2] for p in parts], np.int64), sizes),
            })

    return docs.mapInPandas(rare, "shingle long, n long, class long")


TIES = "u long, v long, part int, side int, shingle long, n long, members array<long>"
_HEAD, _TAIL, _TIE, _RUN = 0, 1, 2, 3


def _ties(percent: int):
    def tied(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Runs of the lists, from rows sorted by (shingle, n, class): short ones whole, of long ones ties to the first.

        A run that touches the partition's first or last row may go on in a neighbour; its rows are tied to its
        first, and two lines (head, tail) tell where it lies. A run is held only while it is short.
        """
        part, told = TaskContext.get().partitionId(), set()
        s0 = n0 = None  # the last row
        run: list[int] = []  # the open run; of a long one only the first
        long = False  # the open run's rows are tied to its first as they come
        out: list[tuple] = []

        def tie(u: int, v: int) -> None:
            if u != v and (u, v) not in told:
                if len(told) < 1_000_000:  # only spares repeated rows
                    told.add((u, v))
                out.append((u, v, part, _TIE, 0, 0, None))

        def close() -> None:
            members = tuple(dict.fromkeys(run))
            if not long and len(members) > 1 and members not in told:
                if len(told) < 1_000_000:
                    told.add(members)
                out.append((0, 0, part, _RUN, 0, 0, list(members)))

        for batch in batches:
            if not len(batch):
                continue
            shingle, n, name = (batch[c].to_numpy(np.int64) for c in ("shingle", "n", "class"))
            goes_on = np.empty(len(batch), bool)
            goes_on[1:] = (shingle[1:] == shingle[:-1]) & (100 * n[:-1] >= percent * n[1:])
            if s0 is None:
                goes_on[0] = False
                out.append((int(name[0]), int(name[0]), part, _HEAD, int(shingle[0]), int(n[0]), None))
            else:
                goes_on[0] = shingle[0] == s0 and 100 * n0 >= percent * n[0]
            starts = np.flatnonzero(~goes_on)
            ends = np.append(starts[1:], len(batch))
            first = starts[0] if len(starts) else len(batch)
            for i in name[:first].tolist():  # the run that is open from the batch before
                if not long and len(run) < _SHORT:
                    run.append(i)
                    continue
                if not long:
                    for other in run:
                        tie(other, run[0])
                    run, long = run[:1], True
                tie(i, run[0])
            # A run of one row inside the batch has no partner.
            wide = (ends - starts > 1) | (ends == len(batch))
            for a, b in zip(starts[wide].tolist(), ends[wide].tolist()):
                close()
                members = name[a:b].tolist()
                long = (s0 is None and a == 0) or b - a > _SHORT  # the partition's first run is tied at once
                if long:
                    for i in members:
                        tie(i, members[0])
                    run = members[:1]
                else:
                    run = members
            s0, n0 = int(shingle[-1]), int(n[-1])
            yield pd.DataFrame(out, columns=["u", "v", "part", "side", "shingle", "n", "members"])
            out = []
        if s0 is not None:
            for other in run:  # the partition's last run
                tie(other, run[0])
            out.append((run[0], run[0], part, _TAIL, s0, n0, None))
            yield pd.DataFrame(out, columns=["u", "v", "part", "side", "shingle", "n", "members"])

    return tied


def _allowed(percent: int):
    def allowed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Ties between members of short runs whose sketches allow a link, from rows sorted by run."""
        key, held = None, []

        def done() -> list[tuple[int, int]]:
            union, found = _Union(len(held)), []
            for i, (a, n, x) in enumerate(held):
                for j in range(i):
                    b, m, y = held[j]
                    near = 100 * min(n, m) >= percent * max(n, m)
                    if near and union.root(i) != union.root(j) and may_link(n, x, m, y, percent):
                        union.tie(i, j)
                        found.append((a, b))
            return found

        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                if r.run != key:
                    out += done()
                    key, held = r.run, []
                held.append((r.node, r.n, np.frombuffer(r.sketch, "u1").astype(np.int64)))
            yield pd.DataFrame(out, columns=["u", "v"])
        yield pd.DataFrame(done(), columns=["u", "v"])

    return allowed


def clusters(rare: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """(node, cluster) of classes that share a rare shingle and may link; ``nodes`` has their n and sketch."""
    spark = rare.sparkSession
    ties = stored(in_order(rare, "shingle", "n", "class").mapInPandas(_ties(percent), TIES), "ties")
    # Two lines per range partition: does a run go on into the next?
    lines = ties.where(F.col("side").isin(_HEAD, _TAIL)).orderBy("part", "side").collect()
    seams = [
        (a["v"], b["u"]) for a, b in zip(lines, lines[1:])
        if a["side"] == _TAIL and b["side"] == _HEAD and a["shingle"] == b["shingle"] and 100 * a["n"] >= percent * b["n"]
    ]
    runs = ties.where(F.col("side") == _RUN).select("members").distinct()
    runs = stored(runs.select(F.monotonically_increasing_id().alias("run"), "members"), "runs")
    rows = runs.select("run", F.explode("members").alias("node")).join(nodes.select("node", "n", "sketch"), "node")
    dealt = rows.select("run", "node", "n", "sketch").repartition("run").sortWithinPartitions("run", "node")
    edges = ties.where(F.col("side") == _TIE).select("u", "v").union(dealt.mapInPandas(_allowed(percent), LINKS))
    return components(edges.union(spark.createDataFrame(seams, LINKS))).withColumnRenamed("root", "cluster")


LINKS = "u long, v long"


def _block_links(percent: int):
    def linked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Links of every block, from rows sorted by (cluster, block, asked).

        A block's own sets come first and are joined among themselves; sets that are asked are then searched
        one by one in its index. If any is asked, the block's own sets have been joined before. Only one block
        is in memory at a time.
        """
        key, own, index, asked = None, {}, None, False

        def done() -> list[tuple[int, int]]:
            names = sorted(own)
            return [(names[i], names[j]) for i, j in joined([own[k] for k in names], percent)] if own and not asked else []

        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                if (r.cluster, r.block) != key:
                    out += done()
                    key, own, index, asked = (r.cluster, r.block), {}, None, False
                shingles = np.frombuffer(r.shingles, np.uint64)
                if not r.asked:
                    own[r.node] = shingles
                    continue
                if index is None:
                    names, asked = sorted(own), True
                    index = Block([own[k] for k in names], least=1)
                out += [(r.node, names[i]) for i in index.search(shingles, percent) if names[i] != r.node]
            yield pd.DataFrame(out, columns=["u", "v"])
        yield pd.DataFrame(done(), columns=["u", "v"])

    return linked


def _searched(rows: DataFrame, percent: int) -> DataFrame:
    """Links inside blocks of (cluster, block, node, asked, shingles)."""
    dealt = rows.repartition("cluster", "block").sortWithinPartitions("cluster", "block", "asked")
    return dealt.select("cluster", "block", "node", "asked", "shingles").mapInPandas(_block_links(percent), LINKS)


def _bits(doc_id: str) -> list[Column]:
    """Places of a doc_id in a filter of fixed size."""
    return [F.pmod(F.xxhash64(doc_id, F.lit(seed)), F.lit(1 << _FILTER_BITS)) for seed in range(_FILTER_HASHES)]


def _filter_of(ids: DataFrame, doc_id: str) -> np.ndarray:
    """The Bloom filter of the ids, one byte for eight places; its size is fixed, more ids only make it let more pass."""
    place = ids.select(F.explode(F.array(*_bits(doc_id))).alias("place"))
    part = F.call_function("shiftleft", F.lit(1), (F.col("place") % 8).cast("int"))
    filled = place.groupBy(F.floor(F.col("place") / 8).alias("at")).agg(F.bit_or(part).cast("int").alias("byte")).toArrow()
    out = np.zeros(1 << (_FILTER_BITS - 3), "u1")
    out[filled["at"].to_numpy()] = filled["byte"].to_numpy()
    return out


def _sets(docs: DataFrame, members: DataFrame, words: int) -> DataFrame:
    """(node, cluster, blocks, shingles) of the classes in ``members``, made where their first documents are read.

    A filter of the wanted ids, copied to every task, spares all other texts; no text is moved. What it lets pass
    besides is dropped when the sets meet ``members``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(_filter_of(members, "first_id"))
    places = [f"place{i}" for i in range(_FILTER_HASHES)]

    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        give_back()
        shingles, told = Shingler(words), set()
        for batch in batches:
            wanted = np.ones(len(batch), bool)
            for name in places:
                at = batch[name].to_numpy()
                wanted &= (shared.value[at >> 3] >> (at & 7)) & 1 == 1
            out = []
            for name, text in zip(batch["doc_id"][wanted], batch["text"][wanted]):
                s = shingles(text)
                node = class_of(s)
                if (name, node) not in told:  # equal rows of one task are told once
                    told.add((name, node))
                    out.append((name, node, s.tobytes()))
            yield pd.DataFrame(out, columns=["first_id", "node", "shingles"])

    asked = docs.select("doc_id", "text", *[b.alias(name) for b, name in zip(_bits("doc_id"), places)])
    found = asked.mapInPandas(made, "first_id long, node long, shingles binary")
    met = found.join(members, ["first_id", "node"])
    return met.select("node", "cluster", "blocks", "shingles")


def _parts(links_: DataFrame) -> DataFrame:
    return components(links_).withColumnRenamed("root", "part")


@tidy
def jaccard_components(
    docs: DataFrame, percent: int = 80, words: int = 5, block_docs: int = 64, block_shingles: int = 1 << 18,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """doc_id, n_shingles and component_id of every row."""
    spark = docs.sparkSession
    said = texts(docs, doc_id, text)
    seen = stored(_first_pass(said, words), "shingle-sets")
    rows = seen.where("slice < 0").select("doc_id", "n", F.col("class").alias("node"))
    counts = shingle_counts(seen.where("slice >= 0").select("slice", "counts"))
    linkable = F.col("doc_id").isNotNull() & (F.col("n") > 0)
    known = seen.where("slice < 0").where(linkable).groupBy(F.col("class").alias("node"))
    nodes = stored(known.agg(F.max("n").alias("n"), F.min("doc_id").alias("first_id"), F.max("sketch").alias("sketch")), "nodes")
    said = said.where(F.col("doc_id").isNotNull())

    members = fresh_dir(spark, "members")
    with scope(spark):
        found = clusters(stored(_rare_first(said, counts, words, percent), "rare-shingles"), nodes, percent)
        placed = nodes.join(stored(found, "clusters"), "node")
        sizes = placed.groupBy("cluster").agg(
            F.greatest(F.ceil(F.count("*") / block_docs), F.ceil(F.sum("n") / block_shingles)).alias("blocks")
        )
        members = stored(placed.join(stored(sizes, "cluster-sizes"), "cluster").select("node", "cluster", "blocks", "first_id"), "", members)
    sets = stored(_sets(said, members, words), "sets")
    number = F.pmod(F.xxhash64("node"), F.col("blocks")).alias("block")
    everywhere = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block")

    def rows_of(df: DataFrame, block, asked: bool = False) -> DataFrame:
        return df.select("cluster", block, "node", F.lit(asked).alias("asked"), "shingles")

    # Every block of a cluster also holds the cluster's smallest classes, which tie its blocks together.
    many = sets.where("blocks > 1")
    pivots = top_per_group(many.select("cluster", "node"), ["cluster"], ["node"], _PIVOTS).select("node")
    copied = rows_of(many.join(stored(pivots, "pivots"), "node", "left_semi"), everywhere)
    first = stored(_searched(rows_of(sets, number).union(copied), percent), "links")

    # Clusters of several blocks: what is outside the largest component is searched in the other blocks too.
    tagged = many.select("cluster", "node").join(stored(_parts(first), "parts"), "node", "left")
    tagged = stored(tagged.select("cluster", "node", F.coalesce("part", "node").alias("part")), "tagged")
    weights = tagged.groupBy("cluster", "part").count()
    largest = stored(weights.groupBy("cluster").agg(F.max_by("part", F.struct("count", "part")).alias("largest")), "largest")
    outside = tagged.join(largest, "cluster").where("part <> largest").select("node", "cluster")
    outside = stored(outside, "outside")
    asked = many.join(outside.select("node"), "node", "left_semi")
    there = many.join(outside.select("cluster").distinct(), "cluster", "left_semi")
    second = _searched(rows_of(asked, everywhere, asked=True).union(rows_of(there, number)), percent)

    tied = stored(_parts(first.union(stored(second, "outside-links"))), "components")
    parted = nodes.join(tied, "node", "left").select("node", "first_id", F.coalesce("part", "node").alias("part"))
    parted = stored(parted, "parted")
    firsts = stored(parted.groupBy("part").agg(F.min("first_id").alias("component_id")), "firsts")
    named = stored(parted.join(firsts, "part").select("node", "component_id"), "named")
    linked = rows.where(linkable).join(named, "node").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    alone = rows.where(~linkable).select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return linked.union(alone)
