"""Substring dedup with content-defined chunks.

A gear hash rolls over the UTF-8 bytes of a text; a chunk ends where its top bits are zero, unless another
such place lies within the ``least`` bytes before. Whether a place is a cut depends only on the bytes just
before it, so an insertion moves no cut outside its neighbourhood. A long stretch without cuts, such as one word
over and over, is cut where the hash is smallest among the last 32, at least 32 bytes apart, and every ``most``
bytes at the latest. Chunks are known by a 64-bit digest.

1. Chunks (digest, doc_id, pos, size) are sorted by digest over range partitions. Every chunk that an earlier
   document has is tied to two places: the first of its digest (smallest doc_id, then place), and the last one in
   the nearest earlier document. A sorted partition is read as a stream that keeps two places; only a digest that
   goes on over a partition border is settled afterwards, from one line per partition. So a chunk may have any
   share of all rows.
2. Ties are gathered by (document, earlier document, shift) to alignments of at least ``seed`` bytes of chunks, and
   these by pair of documents. The bytes around a pair's alignments, ``reach`` more on either side, are cut out of
   both texts.
3. Alignments are compared byte by byte (this also settles equal digests of different chunks) and followed in both
   directions until the texts differ; equal stretches of at least ``words`` whole words are the result. A pair with
   a stretch that goes on at the border of a cut-out comes again with a larger one. An alignment that lies in a
   stretch already found in that pair, and does not leave it, is passed over, so text that repeats itself is
   compared once and not once for every repeat.

A null or empty text has no chunks. Rows without a doc_id take no part, since no span could name them. Rows
with one doc_id and equal texts are one document; with different texts, the doc_id names them all, spans refer
to the largest text, and a passage that two of them share is not reported. Repeats inside one document are not
reported. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from clickweave.llm.common import in_order, texts, tidy
from clickweave.workspace import stored

_WINDOW = 32  # bytes that a 32-bit gear hash remembers
_WIDE = 160  # a stretch without cuts that is longer is cut by another rule
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True

CHUNKS = "digest long, doc_id long, pos long, size int"
MARKED = "kind int, digest long, doc_id long, pos long, size int, first_doc long, first_pos long, near_doc long, near_pos long"
SPANS = "doc_id long, start long, size long, first_doc_id long, first_start long, words long"


def _gear() -> np.ndarray:
    """256 pseudo-random numbers: multiples of an odd constant, mixed."""
    x = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) & np.uint64(2**64 - 1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((x ^ (x >> np.uint64(27))) >> np.uint64(32)).astype(np.uint32)


GEAR = _gear()


def rolled(data: np.ndarray) -> np.ndarray:
    """Gear hash at every byte, h = 2 h + gear[byte] in 32 bits, by doubling the span of the sums."""
    h, span = GEAR[data], 1
    while span < _WINDOW:
        h[span:] += h[:-span] << np.uint32(span)
        span *= 2
    return h


def cuts(data: np.ndarray, bits: int, least: int, most: int) -> np.ndarray:
    """Ends of the chunks of ``data``; the last is its length."""
    if not len(data):
        return np.empty(0, np.int64)
    h = rolled(data)
    marks = np.flatnonzero(h >> np.uint32(32 - bits) == 0) + 1
    if len(marks):
        marks = marks[np.diff(marks, prepend=-least - 1) > least]
    ends = np.append(marks, len(data)) if not len(marks) or marks[-1] != len(data) else marks
    gaps = np.diff(ends, prepend=0)
    if gaps.max() > _WIDE:
        ends = np.concatenate([_stretch(h[e - g : e], e - g, most) if g > _WIDE else [e] for e, g in zip(ends.tolist(), gaps.tolist())])
    return ends.astype(np.int64)


def _stretch(h: np.ndarray, start: int, most: int) -> np.ndarray:
    """Cuts of a stretch without any, by the hashes at its bytes."""
    low, span = h.copy(), 1
    while span < _WINDOW:  # smallest of the last 32
        low[span:] = np.minimum(low[span:], low[:-span])
        span *= 2
    places = np.flatnonzero(low == h) + 1
    places = places[places >= _WINDOW]
    found, at = [], 0
    while at < len(h):
        i = int(np.searchsorted(places, at + _WINDOW))
        following = int(places[i]) if i < len(places) else len(h)
        at = min(following, at + most, len(h))
        found.append(start + at)
    return np.array(found, np.int64)


def chunks(docs: DataFrame, bits: int, least: int, most: int) -> DataFrame:
    def cut_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, digests, starts, sizes = [], [], [], []
            for name, text in zip(batch["doc_id"], batch["text"]):
                raw = text.encode()
                ends = cuts(np.frombuffer(raw, "u1"), bits, least, most).tolist()
                begins = [0, *ends[:-1]] if ends else []
                ids.append(np.full(len(ends), name, np.int64))
                digests += [xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in zip(begins, ends)]
                starts += begins
                sizes += [b - a for a, b in zip(begins, ends)]
            yield pd.DataFrame({
                "digest": np.array(digests, np.uint64).view(np.int64), "doc_id": np.concatenate(ids) if ids else np.empty(0, np.int64),
                "pos": np.array(starts, np.int64), "size": np.array(sizes, np.int32),
            })

    return docs.mapInPandas(cut_up, CHUNKS)


_COPY, _UNSURE, _HEAD, _TAIL = 0, 1, 2, 3


def _marked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Copies with the first place and the nearest earlier document's last, from rows sorted by (digest, doc_id, pos).

    Rows of the partition's first digest are unsure, its first place may lie further left; of these the rows of
    the first document (the head) lack the nearest one as well. A last line tells the partition's last digest with
    its first place, its last place and the last one of the document before (``size`` 1 if there is one).
    """
    digest, first_doc, first_pos, head, head_doc = None, 0, 0, None, None
    last_doc, last_pos, near_doc, near_pos, near = 0, 0, 0, 0, False
    for batch in batches:
        if not len(batch):
            continue
        d, doc, pos = (batch[c].to_numpy(np.int64) for c in ("digest", "doc_id", "pos"))
        if head is None:
            head, head_doc = d[0], doc[0]
        new = np.empty(len(d), bool)
        new[0] = d[0] != digest
        new[1:] = d[1:] != d[:-1]
        group = np.cumsum(new)  # 0: goes on from the batch before
        at = np.flatnonzero(new)
        docs0, pos0 = np.append(first_doc, doc[at]), np.append(first_pos, pos[at])
        # runs of one document within a digest, with the row before each
        fresh = new.copy()
        fresh[0] |= doc[0] != last_doc
        fresh[1:] |= doc[1:] != doc[:-1]
        run, starts = np.cumsum(fresh), np.flatnonzero(fresh)
        before_doc, before_pos = np.append(last_doc, doc[:-1])[starts], np.append(last_pos, pos[:-1])[starts]
        near_docs, near_poss, nears = np.append(near_doc, before_doc), np.append(near_pos, before_pos), np.append(near, ~new[starts])
        unsure = d == head
        kind = np.where(unsure, np.where(doc == head_doc, _HEAD, _UNSURE), _COPY).astype(np.int32)
        out = batch.assign(
            kind=kind, first_doc=docs0[group], first_pos=pos0[group], near_doc=near_docs[run], near_pos=near_poss[run],
        )
        digest, first_doc, first_pos = d[-1], docs0[group[-1]], pos0[group[-1]]
        last_doc, last_pos, near_doc, near_pos, near = doc[-1], pos[-1], near_docs[run[-1]], near_poss[run[-1]], nears[run[-1]]
        yield out.loc[unsure | (doc != docs0[group]), _COLUMNS]
    if head is not None:
        yield pd.DataFrame([(_TAIL, digest, last_doc, last_pos, int(near), first_doc, first_pos, near_doc, near_pos)], columns=_COLUMNS)


_COLUMNS = [c.split()[0] for c in MARKED.split(", ")]


def copies(chunk_rows: DataFrame) -> DataFrame:
    """Chunks that an earlier document has, with the first place and the nearest earlier document's last."""
    marked = stored(in_order(chunk_rows, "digest", "doc_id", "pos").mapInPandas(_marked, MARKED), "marked-chunks")
    # Unsure digests and tails: at most two per range partition.
    firsts = (
        marked.where(F.col("kind") != _COPY).groupBy("digest")
        .agg(F.min(F.struct("first_doc", "first_pos")).alias("first"))
    )
    # What lies before a head: the last place of a partition further left, or of the document before that one.
    tails = marked.where(F.col("kind") == _TAIL)
    place = tails.select("digest", F.struct("doc_id", "pos").alias("place")).union(
        tails.where(F.col("size") == 1).select("digest", F.struct("near_doc", "near_pos"))
    )
    befores = place.groupBy("digest").agg(F.collect_list("place").alias("places"))
    names = ["digest", "doc_id", "pos", "size", "first_doc", "first_pos", "near_doc", "near_pos"]
    sure = marked.where(F.col("kind") == _COPY).select(*names)
    unsure = marked.where(F.col("kind").isin(_UNSURE, _HEAD)).drop("first_doc", "first_pos").join(F.broadcast(firsts), "digest")
    unsure = unsure.where(F.col("doc_id") != F.col("first.first_doc")).join(F.broadcast(befores), "digest", "left")
    nearest = F.array_max(F.filter("places", lambda p: p["doc_id"] < F.col("doc_id")))
    known = F.when(F.col("kind") == _UNSURE, F.struct(F.col("near_doc").alias("doc_id"), F.col("near_pos").alias("pos"))).otherwise(nearest)
    settled = unsure.withColumn("near", known).select(
        "digest", "doc_id", "pos", "size", "first.first_doc", "first.first_pos", F.col("near.doc_id").alias("near_doc"), F.col("near.pos").alias("near_pos")
    )
    return sure.unionByName(settled)


def _whole_words(raw: bytes, a: int, b: int) -> int:
    """Words that lie wholly in raw[a:b] (a word at its border counts only if the text ends there)."""
    n = len(raw[a:b].split())
    if n and a > 0 and not _SPACE[raw[a]] and not _SPACE[raw[a - 1]]:
        n -= 1
    if n and b < len(raw) and not _SPACE[raw[b - 1]] and not _SPACE[raw[b]]:
        n -= 1
    return n


def _alike(a: bytes, b: bytes, i: int, j: int, step: int) -> int:
    """How many bytes of ``a`` and ``b`` are equal from i and j on (``step`` 1), or before them (-1)."""
    most, n, block = min(len(a) - i, len(b) - j) if step > 0 else min(i, j), 0, 64
    while n < most:
        size = min(block, most - n)
        x, y = (a[i + n : i + n + size], b[j + n : j + n + size]) if step > 0 else (a[i - n - size : i - n], b[j - n - size : j - n])
        if x != y:
            differ = np.flatnonzero(np.frombuffer(x, "u1") != np.frombuffer(y, "u1"))
            return n + (int(differ[0]) if step > 0 else size - 1 - int(differ[-1]))
        n, block = n + size, min(2 * block, 1 << 20)
    return n


def equal_stretches(
    mine: bytes, other: bytes, lines: list[tuple[int, int, int]], words: int, open_left: tuple[bool, bool] = (False, False), open_right: tuple[bool, bool] = (False, False),
) -> list[tuple[int, int, int, int]] | None:
    """(start in ``mine``, size, shift, whole words) of maximal equal stretches on the lines (lo, hi, shift), where
    mine[i] meets other[i + shift]. None if one goes on where ``mine`` or ``other`` is cut off (open)."""
    found: list[tuple[int, int, int, int]] = []
    cover: list[tuple[int, int]] = []  # the stretches found, joined, by start
    for lo, hi, shift in lines:
        lo, hi = max(lo, 0, -shift), min(hi, len(mine), len(other) - shift)
        if hi <= lo:
            continue
        k = bisect_right(cover, (lo, len(mine) + 1)) - 1
        if k >= 0 and cover[k][1] >= hi:
            a, b = cover[k]
            leaves = (b < len(mine) and b + shift < len(other) and mine[b] == other[b + shift]) or (
                a > 0 and a + shift > 0 and mine[a - 1] == other[a - 1 + shift]
            )
            if not leaves:
                continue
        same = np.frombuffer(mine, "u1")[lo:hi] == np.frombuffer(other, "u1")[lo + shift : hi + shift]
        edges = np.flatnonzero(np.diff(np.concatenate([[0], same.astype(np.int8), [0]])))
        for start, end in zip((edges[::2] + lo).tolist(), (edges[1::2] + lo).tolist()):
            if start == lo:
                start -= _alike(mine, other, start, start + shift, -1)
            if end == hi:
                end += _alike(mine, other, end, end + shift, 1)
            if (start == 0 and open_left[0]) or (start + shift == 0 and open_left[1]):
                return None
            if (end == len(mine) and open_right[0]) or (end + shift == len(other) and open_right[1]):
                return None
            if end - start >= 2 * words - 1:
                n = _whole_words(mine, start, end)
                if n >= words:
                    found.append((start, end - start, shift, n))
                    first, last = bisect_left(cover, start, key=lambda c: c[1]), bisect_right(cover, end, key=lambda c: c[0])
                    inside = cover[first:last]
                    cover[first:last] = [(min([start, *(c[0] for c in inside)]), max([end, *(c[1] for c in inside)]))]
    return sorted(set(found))


@tidy
def repeated_spans(
    docs: DataFrame, words: int = 50, bits: int = 5, least: int = 8, most: int = 1024, seed: int = 32, reach: int = 256,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Passages of at least ``words`` words that an earlier document has too.

    Offsets and sizes are in UTF-8 bytes. A passage is told for every alignment that finds more of it, so spans
    of a document may overlap. ``reach`` is only the first step by which cut-outs go beyond the chunks.
    """
    said = texts(docs, doc_id, text).where(F.col("doc_id").isNotNull())
    cut_up = stored(chunks(said, bits, least, most), "chunks")
    ties = F.array_distinct(F.array(*[
        F.struct(F.col(f"{n}_doc").alias("doc"), F.col(f"{n}_pos").alias("pos")) for n in ("first", "near")
    ]))
    tied = copies(cut_up).select("doc_id", "pos", "size", F.explode(ties).alias("tie"))
    lines = tied.groupBy("doc_id", F.col("tie.doc").alias("first_doc"), (F.col("tie.pos") - F.col("pos")).alias("shift")).agg(
        F.min("pos").alias("lo"), F.max(F.col("pos") + F.col("size")).alias("hi"), F.sum("size").alias("seeds")
    )
    each = F.array_sort(F.collect_list(F.struct("lo", "hi", "shift")))
    pairs = lines.where(F.col("seeds") >= seed).groupBy("doc_id", "first_doc").agg(each.alias("lines")).select(
        "doc_id", "first_doc", *[F.col(f"lines.{c}").alias(c) for c in ("lo", "hi", "shift")],
        F.array_min("lines.lo").alias("a"), F.array_max("lines.hi").alias("b"),
        F.array_min(F.transform("lines", lambda x: x["lo"] + x["shift"])).alias("other_a"),
        F.array_max(F.transform("lines", lambda x: x["hi"] + x["shift"])).alias("other_b"),
    )
    pending = stored(pairs.withColumn("pair", F.monotonically_increasing_id()), "pairs")
    spans = None
    while True:
        seen = stored(_compared(pending, said, words, reach), "compared")
        mine = seen.where("pending = 0").drop("pending", "pair")
        spans = mine if spans is None else spans.unionByName(mine)
        again = seen.where("pending = 1").select("pair")
        if again.isEmpty():
            return spans
        pending, reach = stored(pending.join(again, "pair", "left_semi"), "pairs"), reach * 16


def _compared(pairs: DataFrame, said: DataFrame, words: int, reach: int) -> DataFrame:
    """Spans of the pairs, or one line with ``pending`` 1 for a pair whose cut-outs are too small."""
    asked = None
    for side, name, a, b in ((0, "doc_id", "a", "b"), (1, "first_doc", "other_a", "other_b")):
        more = pairs.select(
            "pair", F.col(name).alias("name"), F.lit(side).alias("side"),
            F.greatest(F.col(a) - reach, F.lit(0)).alias("a"), (F.col(b) + reach).alias("b"),
        )
        asked = more if asked is None else asked.union(more)
    raw = F.col("text").cast("binary")
    size = F.least(F.col("b") - F.col("a"), F.lit(2**31 - 1)).cast("int")
    out = asked.join(said.select(F.col("doc_id").alias("name"), "text"), "name").select(
        "pair", "side", "a", F.substring(raw, (F.col("a") + 1).cast("int"), size).alias("part"), (F.octet_length("text") > F.col("b")).alias("more")
    )
    out = out.groupBy("pair").agg(
        *[F.max(F.when(F.col("side") == s, F.struct("part", "a", "more"))).alias(n) for s, n in ((0, "mine"), (1, "other"))]
    )
    both = pairs.select("pair", "doc_id", "first_doc", "lo", "hi", "shift").join(out, "pair").select(
        "pair", "doc_id", "first_doc", "lo", "hi", "shift", F.col("mine.part").alias("mine"), F.col("mine.a").alias("a"), F.col("mine.more").alias("more"),
        F.col("other.part").alias("other"), F.col("other.a").alias("b"), F.col("other.more").alias("other_more"),
    )

    def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for r in batch.itertuples(index=False):
                lines = [(lo - r.a, hi - r.a, shift + r.a - r.b) for lo, hi, shift in zip(r.lo.tolist(), r.hi.tolist(), r.shift.tolist())]
                got = equal_stretches(r.mine, r.other, lines, words, (r.a > 0, r.b > 0), (r.more, r.other_more))
                if got is None:
                    found.append((1, r.pair, r.doc_id, 0, 0, r.first_doc, 0, 0))
                    continue
                for start, size, shift, n in got:
                    found.append((0, r.pair, r.doc_id, r.a + start, size, r.first_doc, r.b + start + shift, n))
            yield pd.DataFrame(found, columns=["pending", "pair", "doc_id", "start", "size", "first_doc_id", "first_start", "words"])

    return both.mapInPandas(compared, f"pending int, pair long, {SPANS}")


def without_repeats(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """(doc_id, text) with the spans cut out; a cut that would split a character leaves that character."""
    each = spans.groupBy("doc_id").agg(F.array_sort(F.collect_set(F.struct("start", "size"))).alias("spans"))

    def cut_out(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["text"] = [t if s is None else removed(t, [(x["start"], x["size"]) for x in s]) for t, s in zip(batch["text"], batch["spans"])]
            yield batch[["doc_id", "text"]]

    return texts(docs).join(each, "doc_id", "left").mapInPandas(cut_out, "doc_id long, text string")


def removed(text: str, spans: list[tuple[int, int]]) -> str:
    raw, keep, at = text.encode(), [], 0
    for start, size in sorted(spans):
        end = start + size
        while start < len(raw) and raw[start] & 0xC0 == 0x80:  # inside a character
            start += 1
        while end > start and end < len(raw) and raw[end] & 0xC0 == 0x80:
            end -= 1
        keep.append(raw[at : max(at, start)])
        at = max(at, end)
    return b"".join([*keep, raw[at:]]).decode()
