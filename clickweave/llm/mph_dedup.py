"""Exact dedup against a minimal perfect hash over the distinct digests of a history.

The digest of a text is the SHA-256 of its UTF-8 bytes after lower-casing A-Z. The digests are dealt to
shards by hash; a task builds the minimal perfect hash of its shard (levels of bits: a key sits on the
first level where no other key shares its place, and its slot is the rank of its bit). A slot holds the full
digest, the locator of the row that stays (its doc_id) and the number of copies. A lookup finds the one slot
a digest could have and compares all 32 bytes, so a digest the history lacks never passes for a member.

``dedup(docs)`` takes the table as its own history: of equal texts the row with the largest doc_id stays.
``dedup(docs, index)`` removes what an earlier corpus has; the rows it lacks are grouped among themselves.

Equal rows (same text, same doc_id) are folded and counted before any row moves, and exactly one of them
stays; the rows of a shard are read in parts of about ``part_rows``, each with a copy of the shard, so one
text may hold any share of the rows. A null text is empty. Rows without a doc_id count as copies and stay
only if no copy has one; then keep_id is null. An empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from clickweave.llm.common import ascii_lower, texts
from clickweave.workspace import stored

KEY_BYTES = 32
_LEVELS = 64
_WORD = KEY_BYTES // 8

SLOTS = "shard long, n long, levels array<int>, bits binary, digests binary, winners binary, without_id binary, copies binary"
FOUND = "digest binary, doc_id long, times long, member boolean, keep_id long, group_size long, wins boolean"


def _places(words: np.ndarray, level: int, size: int) -> np.ndarray:
    mixed = np.full(len(words), 0x9E3779B97F4A7C15 * (level + 1) & (2**64 - 1), np.uint64)
    for column in range(_WORD):
        mixed ^= words[:, column]
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(29)
    return mixed % np.uint64(size)


def _words(digests: bytes) -> np.ndarray:
    return np.frombuffer(digests, "<u8").reshape(-1, _WORD)


def build(digests: list[bytes], spare: float = 1.5) -> tuple[list[int], bytes]:
    """Level sizes and bits of the minimal perfect hash of distinct digests."""
    words = _words(b"".join(digests))
    sizes, bits = [], []
    for level in range(_LEVELS):
        if not len(words):
            break
        size = max(8, math.ceil(spare * len(words) / 8) * 8)
        place = _places(words, level, size)
        alone = np.bincount(place.astype(np.int64), minlength=size) == 1
        sizes.append(size)
        bits.append(np.packbits(alone))
        words = words[~alone[place.astype(np.int64)]]
    if len(words):
        raise ValueError("digests are not distinct")
    return sizes, b"".join(b.tobytes() for b in bits)


def slots(levels: list[int], bits: bytes, digests: list[bytes]) -> np.ndarray:
    """The slot each digest would have, -1 where no member can be."""
    flat = np.unpackbits(np.frombuffer(bits, "u1")).astype(bool)
    rank = np.cumsum(flat) - 1
    words = _words(b"".join(digests))
    found, open_rows, start = np.full(len(words), -1, np.int64), np.arange(len(words)), 0
    for level, size in enumerate(levels):
        place = _places(words[open_rows], level, size).astype(np.int64) + start
        here = flat[place]
        found[open_rows[here]] = rank[place[here]]
        open_rows, start = open_rows[~here], start + size
    return found


def digested(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(digest, doc_id, times): equal rows folded."""
    rows = texts(docs, doc_id, text).select(F.unhex(F.sha2(ascii_lower(F.col("text")), 256)).alias("digest"), "doc_id")
    return rows.groupBy("digest", "doc_id").agg(F.count("*").alias("times"))


def _sharded(df: DataFrame, shards: int) -> DataFrame:
    return df.withColumn("shard", F.pmod(F.xxhash64("digest"), F.lit(shards)))


class Index:
    """Shards of a minimal perfect hash, one row each, in the shared folder."""

    def __init__(self, rows: DataFrame, shards: int):
        self.rows, self.shards = rows, shards


def build_index(folded: DataFrame, shard_keys: int = 4096) -> Index:
    """The index of (digest, doc_id, times) rows; a shard has about ``shard_keys`` digests."""
    winners = stored(
        folded.groupBy("digest").agg(F.max("doc_id").alias("winner"), F.sum("times").alias("copies")), "winners"
    )
    shards = max(1, math.ceil(winners.count() / shard_keys))

    def laid_out(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        digests = group["digest"].tolist()
        levels, bits = build(digests)
        order = np.argsort(slots(levels, bits, digests))
        group = group.iloc[order]
        return pd.DataFrame({
            "shard": [key[0]], "n": [len(group)], "levels": [levels], "bits": [bits], "digests": [b"".join(group["digest"])],
            "winners": [group["winner"].fillna(0).to_numpy("<i8").tobytes()],
            "without_id": [group["winner"].isna().to_numpy("u1").tobytes()], "copies": [group["copies"].to_numpy("<i8").tobytes()],
        })

    return Index(stored(_sharded(winners, shards).groupBy("shard").applyInPandas(laid_out, SLOTS), "digest-index"), shards)


def _probed(key: tuple, rows: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
    digests = rows["digest"].tolist()
    out = rows[["digest", "doc_id", "times"]].copy()
    member = np.zeros(len(rows), bool)
    keep, size, nameless = (np.zeros(len(rows), kind) for kind in (np.int64, np.int64, bool))
    if len(shard) and len(rows):
        line = shard.iloc[0]
        slot = slots(list(line["levels"]), line["bits"], digests)
        full = np.frombuffer(line["digests"], "u1").reshape(-1, KEY_BYTES)
        asked = np.frombuffer(b"".join(digests), "u1").reshape(-1, KEY_BYTES)
        member = (slot >= 0) & (full[slot] == asked).all(axis=1)
        keep = np.frombuffer(line["winners"], "<i8")[slot]
        nameless = np.frombuffer(line["without_id"], "u1")[slot].astype(bool)
        size = np.frombuffer(line["copies"], "<i8")[slot]
    known = pd.Series(keep, index=rows.index, dtype="Int64").mask(~member | nameless)
    out["member"] = member
    out["keep_id"] = known
    out["group_size"] = pd.Series(size, index=rows.index, dtype="Int64").mask(~member)
    ids = rows["doc_id"].astype("Int64")
    out["wins"] = member & ((ids == known).fillna(False) | (nameless & ids.isna())).to_numpy(bool)
    return out


def lookup(folded: DataFrame, index: Index, part_rows: int = 16384) -> DataFrame:
    """Each (digest, doc_id, times) row with what its slot says, if its digest is a member."""
    rows = _sharded(folded, index.shards)
    parts = stored(
        rows.groupBy("shard").agg(F.ceil(F.count("*") / part_rows).alias("parts")), "shard-parts"
    )
    dealt = rows.join(parts, "shard").withColumn("part", F.pmod(F.xxhash64("doc_id"), F.col("parts")))
    copies = index.rows.join(parts, "shard").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    return (
        dealt.select("shard", "part", "digest", "doc_id", "times").groupBy("shard", "part")
        .cogroup(copies.drop("parts").groupBy("shard", "part"))
        .applyInPandas(_probed, FOUND)
    )


def decide(folded: DataFrame, index: Index | None = None) -> DataFrame:
    """(digest, doc_id, times, keep_id, group_size, wins) of folded rows; ``wins``: one of its times stays."""
    if index is None:
        return lookup(folded, build_index(folded)).drop("member")
    found = stored(lookup(folded, index), "looked-up")
    fresh = found.where(~F.col("member")).select("digest", "doc_id", "times")
    repeats = found.where("member").drop("member").withColumn("wins", F.lit(False))
    return repeats.unionByName(decide(stored(fresh, "nonmembers")))


def dedup(docs: DataFrame, index: Index | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    decided = decide(stored(digested(docs, doc_id, text), "digests"), index)
    each = decided.withColumn("time", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
    return each.select(
        "doc_id", "keep_id", "group_size", (F.col("wins") & (F.col("time") == 1)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def keep_one(docs: DataFrame, index: Index | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    names = docs.columns
    whole = docs.select(
        F.unhex(F.sha2(ascii_lower(F.coalesce(F.col(text), F.lit(""))), 256)).alias("digest"),
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("name"), F.struct(*names).alias("row"),
    )
    decided = stored(decide(stored(digested(docs, doc_id, text), "digests"), index).where("wins"), "decided")
    stays = decided.select("digest", F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("name"), "times")
    joined = whole.join(stays, ["digest", "name"])
    once = joined.where("times = 1").select("row.*")
    again = joined.where("times > 1").dropDuplicates(["digest", "name"]).select("row.*")
    return once.union(again)
