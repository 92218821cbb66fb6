"""Packing token pieces into sequences by vector best fit.

A bin has residual capacities in tokens, documents and attention cost (the sum of squared lengths). Pieces
come in order of falling length; a piece goes to the open bin in which, under every constraint, the weighted
norm of what stays free is smallest (``rule="norm"``), or whose free capacities have the largest weighted dot
product with its demand (``rule="dot"``). Where none fits, a new bin opens.

Tokenizing streams over the rows: a text is cut before every blank that a visible character follows, which is
always a border between tokens, and the ids of each part are looked up in a bounded cache in front of the
tokenizer; texts where such a cut is not clear (blank before white space, a special token's string) go to the
tokenizer whole. A document is its ids and the end id. Longer ones than a sequence are cut into full pieces
from the end, so the first piece may be shorter; full pieces are sequences by themselves. The other pieces
are dealt by hash to blocks of about ``block_rows`` and packed block by block: each task holds one block, and
a block leaves about one sequence partly empty.

With ``order`` (a column of whole numbers that no two rows share) blocks are consecutive ranges of the pieces in
that order instead, full pieces among them. Sequences are numbered block by block, and in a block by the place of
their longest piece (ties: the first), so sequence_id follows the order: the sequences up to the end of a block
hold just the pieces up to there.

A null or empty text is just the end id. Equal rows and rows without a doc_id are documents like others: a
piece carries a row number that no two rows share. An empty table gives an empty result.
"""

from __future__ import annotations

import json
import math
import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from clickweave.llm.common import kept, texts
from clickweave.operators.ordering import with_position
from clickweave.workspace import stored

PIECES = "row long, doc_id long, piece int, start long, length long, ids_crc32 long"
_CACHE = 400_000  # parts of words kept by a worker
_LATIN = re.compile("[\t\n\r\x20-\x7e\xa1-\u024f]*")
_WHITE = [c for c in map(chr, range(0x3001)) if c.isspace()]
_BLANKS = [" " + c for c in _WHITE]
_ASCII_BLANKS = [b for b in _BLANKS if b.isascii()]


class _Parts(dict):
    """Ids of parts of texts, made on first use."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, part: str) -> bytes:
        self[part] = ids = self.make(part)
        return ids


class Encoder:
    """Token ids as little-endian 32-bit numbers, with a cache of the parts between blanks.

    If the tokenizer is a byte-level BPE whose merges are in the order of their ids, parts of Latin text are
    merged by tiktoken from the same vocabulary, which gives the same ids faster; all others go to the tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as file:
            self.merge = _merger(json.load(file))
        self.cache = _Parts(self._part)

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _part(self, part: str) -> bytes:
        if self.merge and _LATIN.fullmatch(part):
            return array("I", self.merge(part)).tobytes()
        return self.whole(part)

    def __call__(self, text: str) -> bytes:
        blanks = _ASCII_BLANKS if text.isascii() else _BLANKS
        if "\0" in text or any(s in text for s in self.special) or any(s in text for s in blanks) or text.endswith(" "):
            return self.whole(text)
        if len(self.cache) > _CACHE:
            self.cache.clear()
        parts = text.replace(" ", "\0 ").split("\0")
        if not parts[0]:
            del parts[0]
        return b"".join(map(self.cache.__getitem__, parts))


def _merger(file: dict):
    """tiktoken's merge of the same vocabulary, or None if the file is not such a byte-level BPE."""
    model, before = file["model"], file.get("pre_tokenizer") or {}
    plain = before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and before.get("use_regex", True)
    if model.get("type") != "BPE" or not plain or file.get("normalizer") or model.get("byte_fallback"):
        return None
    # The usual printable stand-ins of bytes: visible Latin-1 characters stand for themselves.
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in seen} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in seen)}
    ranks = {}
    for token, number in model["vocab"].items():
        if all(c in byte_of for c in token):
            ranks[bytes(byte_of[c] for c in token)] = number
    merged = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    ids = [model["vocab"][a + b] for a, b in merged]
    if ids != sorted(ids) or len(ranks) < 256 + len(set(ids)):
        return None
    import tiktoken

    # Fixed value: the pattern that splits text before the merges.
    pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    special = {t["content"]: t["id"] for t in file.get("added_tokens", [])}
    words = {token: number for token, number in ranks.items() if token.decode("utf-8", "replace") not in special}
    return tiktoken.Encoding("parts", pat_str=pattern, mergeable_ranks=words, special_tokens={}).encode_ordinary


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces: only the first may be shorter than a sequence."""
    if length <= capacity:
        return [(0, length)]
    first = length % capacity
    starts = [0] * bool(first) + list(range(first, length, capacity))
    return [(a, b - a) for a, b in zip(starts, [*starts[1:], length])]


def pieces(
    docs: DataFrame, tokenizer: str, capacity: int, end_id: int, doc_id: str, text: str, keep_ids: bool, order: str | None = None,
) -> DataFrame:
    """Token pieces of every document: ``PIECES``, and ``ids`` (32-bit numbers) if wanted; ``row`` is ``order`` if given."""
    end = np.array([end_id], "<u4").tobytes()

    def tokenized(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = kept(f"encoder of {tokenizer}", lambda: Encoder(tokenizer))
        for batch in batches:
            out = []
            for row, name, said in zip(batch["row"], batch["doc_id"], batch["text"]):
                ids = encode(said) + end
                for number, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    mine = ids[4 * start : 4 * (start + length)]
                    out.append((row, None if pd.isna(name) else name, number, start, length, zlib.crc32(mine), *[mine] * keep_ids))
            frame = pd.DataFrame(out, columns=["row", "doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * keep_ids])
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            yield frame

    if order is None:
        rows = texts(docs, doc_id, text).withColumn("row", F.monotonically_increasing_id())
    else:
        said = F.coalesce(F.col(text), F.lit("")).alias("text")
        rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), said, F.col(order).cast("long").alias("row"))
    return rows.mapInPandas(tokenized, PIECES + ", ids binary" * keep_ids)


def best_fit(
    lengths: np.ndarray, tokens: int, documents: float = math.inf, attention: float = math.inf,
    weights: tuple[float, float, float] = (1.0, 1.0, 1.0), rule: str = "norm",
) -> np.ndarray:
    """The bin of each piece; ``lengths`` must fall. Each piece must fit an empty bin."""
    full = np.array([tokens, documents, attention], float)
    bound = np.isfinite(full)
    scale = np.where(bound, 1.0 / np.where(bound, full, 1.0), 0.0)
    weight = np.array(weights, float)[bound]
    demand = np.stack([lengths, np.ones(len(lengths)), lengths.astype(float) ** 2], 1) * scale
    demand = demand[:, bound]
    if (demand > 1 + 1e-12).any():
        raise ValueError("a piece is larger than a bin")
    free = np.empty((len(lengths), demand.shape[1]))
    chosen, least, opened = np.empty(len(lengths), np.int64), demand.min(axis=0, initial=1.0), 0
    live = np.empty(0, np.int64)  # bins that the smallest piece still fits
    for i, need in enumerate(demand):
        left = free[live] - need
        fits = np.flatnonzero((left >= -1e-12).all(axis=1))
        if len(fits):
            if rule == "norm":
                at = fits[np.argmin((weight * left[fits] ** 2).sum(axis=1))]
            else:
                at = fits[np.argmax((weight * need * free[live[fits]]).sum(axis=1))]
            chosen[i] = live[at]
            free[live[at]] = left[at]
            if (left[at] < least - 1e-12).any():
                live = np.delete(live, at)
        else:
            chosen[i] = opened
            free[opened] = 1.0 - need
            if (free[opened] >= least - 1e-12).all():
                live = np.append(live, opened)
            opened += 1
    return chosen


def pack(
    docs: DataFrame, tokenizer: str, tokens: int = 2048, documents: float = math.inf, attention: float = math.inf, end_id: int = 0,
    weights: tuple[float, float, float] = (1.0, 1.0, 1.0), rule: str = "norm", block_rows: int = 8192,
    doc_id: str = "doc_id", text: str = "text", keep_ids: bool = False, order: str | None = None,
) -> DataFrame:
    """Pieces with sequence_id and offset; with ``keep_ids`` also their ids, see ``sequences``."""
    if attention < tokens**2 or documents < 1:
        raise ValueError("a full piece must fit a sequence")
    cut_up = stored(pieces(docs, tokenizer, tokens, end_id, doc_id, text, keep_ids, order), "pieces")
    names = [c for c in cut_up.columns if c != "row"]
    if order is not None:
        places = _packed_in_order(cut_up, tokens, documents, attention, weights, rule, block_rows)
        return cut_up.join(places, ["row", "piece"]).select(*names, "sequence_id", "offset")
    whole = cut_up.where(F.col("length") == tokens)
    rest = cut_up.where(F.col("length") < tokens).select("row", "piece", "length")
    blocks = max(1, math.ceil(rest.count() / block_rows))

    def packed(key: tuple, block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["length", "row", "piece"], ascending=[False, True, True], ignore_index=True)
        bins = best_fit(block["length"].to_numpy(), tokens, documents, attention, weights, rule)
        block["sequence_id"] = (key[0] << 32) + bins
        block["offset"] = block.groupby("sequence_id")["length"].cumsum() - block["length"]
        return block[["row", "piece", "sequence_id", "offset"]]

    dealt = rest.withColumn("block", F.pmod(F.xxhash64("row", "piece"), F.lit(blocks)))
    places = dealt.groupBy("block").applyInPandas(packed, "row long, piece int, sequence_id long, offset long")
    alone = whole.select(*names, (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    together = cut_up.where(F.col("length") < tokens).join(places, ["row", "piece"]).select(*names, "sequence_id", "offset")
    return alone.unionByName(together)


def _packed_in_order(
    cut_up: DataFrame, tokens: int, documents: float, attention: float, weights: tuple[float, float, float], rule: str, block_rows: int,
) -> DataFrame:
    """sequence_id and offset of every (row, piece), in blocks of consecutive pieces."""
    total = cut_up.count()
    blocks = max(1, math.ceil(total / block_rows))

    def packed(key: tuple, block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["length", "place"], ascending=[False, True], ignore_index=True)
        # full pieces come first and are sequences by themselves
        full = int((block["length"] == tokens).sum())
        bins = best_fit(block["length"].to_numpy()[full:], tokens, documents, attention, weights, rule)
        bins = np.concatenate([np.arange(full), full + bins])
        # a bin's first piece is its longest
        firsts = block["place"].to_numpy()[np.unique(bins, return_index=True)[1]]
        number = np.empty(len(firsts), np.int64)
        number[np.argsort(firsts)] = np.arange(len(firsts))
        block["sequence_id"] = (key[0] << 32) + number[bins]
        block["offset"] = block.groupby("sequence_id")["length"].cumsum() - block["length"]
        return block[["row", "piece", "sequence_id", "offset"]]

    placed = with_position(cut_up.select("row", "piece", "length"), ["row", "piece"], "place")
    # blocks of equal size, so the last is not a short one
    dealt = placed.withColumn("block", F.expr(f"(place - 1) * {blocks}L div {max(1, total)}L"))
    return dealt.groupBy("block").applyInPandas(packed, "row long, piece int, sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """The token sequences of ``pack(..., keep_ids=True)``: sequence_id, ids (32-bit numbers), doc_ids, lengths."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "length", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids"),
        F.transform("parts", lambda p: p["doc_id"]).alias("doc_ids"), F.transform("parts", lambda p: p["length"]).alias("lengths"),
    )
