"""Split-block Bloom filters, kept as tables: trained once, merged, saved, loaded and used before a shuffle.

A filter is a number of blocks of 256 bits, a block eight lanes of 32 bits. A value goes to one block and sets one bit
in each lane, so testing a value reads a single row of the table (block, w0..w3: two lanes a word). Only blocks that
hold bits have a row. Block and bits come from the md5 of the value's text, so every run and engine finds the same.

The number of blocks comes from declared numbers alone, never from the data; more values than declared only raise the
rate of false positives, and no member is ever lost. Null is no member.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickweave.operators.joins import with_partner
from clickweave.workspace import stored

LANES, LANE_BITS = 8, 32
WORDS = [f"w{i}" for i in range(LANES // 2)]
ROW_BYTES = 40  # block and words


def expected_rate(values: int, blocks: int) -> float:
    """The share of non-members that pass: values fall on blocks by chance, so the rate is a mean over their loads."""
    load = values / blocks
    total, chance = 0.0, math.exp(-load)
    for k in range(1, int(load + 12 * math.sqrt(load) + 30)):
        chance *= load / k
        total += chance * (1 - (1 - 1 / LANE_BITS) ** k) ** LANES
    return total


def blocks_for(values: int, rate: float) -> int:
    """The fewest blocks that keep the rate of false positives for so many values."""
    # A block of 400 values lets nearly everything pass, so fewer blocks need not be looked at.
    low, high = max(1, values // 400), max(1, 64 * values)
    while low < high:
        middle = (low + high) // 2
        if expected_rate(values, middle) <= rate:
            high = middle
        else:
            low = middle + 1
    return low


def _hex(digest: Column, first: int, digits: int) -> Column:
    return F.conv(F.substring(digest, first, digits), 16, 10).cast("long")


def placed(rows: DataFrame, value: Column, blocks: int) -> DataFrame:
    """``rows`` with where a value lies: its ``_block``, and ``_lanes``, five bits for each lane (see ``_words``).

    Both take a digest and are used many times over, so they are columns, computed once a row. They are never null, or
    Spark would test the digest for null once more before a join; a null value has block -1, which no filter has.
    """
    digested = rows.withColumn("_digest", F.md5(value.cast("string")))
    block = F.coalesce(F.pmod(_hex(F.col("_digest"), 1, 12), F.lit(blocks)), F.lit(-1).cast("long"))
    lanes = F.coalesce(_hex(F.col("_digest"), 13, 10), F.lit(0).cast("long"))
    return digested.withColumns({"_block": block, "_lanes": lanes}).drop("_digest")


def _words() -> dict[str, Column]:
    """The bits a placed value sets in each word."""

    def lane(i: int) -> Column:
        shift = F.shiftright("_lanes", 5 * i).bitwiseAND(F.lit(31)) + (i % 2) * LANE_BITS
        return F.call_function("shiftleft", F.lit(1).cast("long"), shift.cast("int"))

    return {name: lane(2 * i).bitwiseOR(lane(2 * i + 1)) for i, name in enumerate(WORDS)}


def _ored(table: DataFrame) -> DataFrame:
    return table.groupBy("block").agg(*[F.bit_or(w).alias(w) for w in WORDS])


@dataclass(frozen=True)
class BlockBloom:
    """A filter: its table and the number of blocks it is made for."""

    table: DataFrame
    blocks: int

    @classmethod
    def trained(cls, values: DataFrame, column: str, expected: int, rate: float) -> "BlockBloom":
        """The filter of a column. Bits are OR-ed in every task before the shuffle, so no value is hot."""
        blocks = blocks_for(expected, rate)
        known = placed(values.where(F.col(column).isNotNull()).select(column), F.col(column), blocks)
        known = known.select(F.col("_block").alias("block"), *[bits.alias(name) for name, bits in _words().items()])
        return cls(stored(_ored(known), "bloom"), blocks)

    def merged(self, other: "BlockBloom") -> "BlockBloom":
        """The filter of both sets of values."""
        if self.blocks != other.blocks:
            raise ValueError("only filters with the same number of blocks can be merged")
        return BlockBloom(stored(_ored(self.table.unionByName(other.table)), "bloom"), self.blocks)

    def save(self, path: str) -> None:
        self.table.write.parquet(f"{path}/table")
        self.table.sparkSession.range(1).select(F.lit(self.blocks).cast("long").alias("blocks")).write.parquet(f"{path}/shape")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "BlockBloom":
        schema = ", ".join(f"{name} long" for name in ("block", *WORDS))
        return cls(spark.read.schema(schema).parquet(f"{path}/table"), spark.read.parquet(f"{path}/shape").first()["blocks"])

    def _hits(self, rows: DataFrame, value: Column, copied: bool) -> DataFrame:
        """Rows whose value is in the filter, each once."""
        table = self.table.select(F.struct(*WORDS).alias("_bits"), F.col("block").alias("_at"))
        found = placed(rows, value, self.blocks).join(F.broadcast(table) if copied else table, F.col("_block") == F.col("_at"))
        for word, bits in _words().items():
            found = found.where(F.col(f"_bits.{word}").bitwiseAND(bits) == bits)
        return found.drop("_bits", "_block", "_at", "_lanes")

    def keep(self, rows: DataFrame, column: str, max_bytes: int = 64 << 20) -> DataFrame:
        """Rows whose ``column`` is in the filter: all members and the false positives.

        A filter whose full size (blocks, not data) is within ``max_bytes`` is copied to every task and ``rows`` are not
        shuffled. A larger one is joined by block with the distinct values, and the rows then with those that passed,
        which spreads hot values.
        """
        rows_known = rows.where(F.col(column).isNotNull())
        if self.blocks * ROW_BYTES <= max_bytes:
            return self._hits(rows_known, F.col(column), copied=True)
        return with_partner(rows, self._hits(rows_known.select(column).distinct(), F.col(column), copied=False), [column])

    def keep_any(self, rows: DataFrame, tokens: Column, row_id: str, max_bytes: int = 64 << 20) -> DataFrame:
        """Rows with at least one token in the filter. Different tokens are tested once each, wherever they occur."""
        pairs = rows.select(F.col(row_id).alias("_id"), F.explode(F.array_distinct(tokens)).alias("_token"))
        hits = self.keep(pairs, "_token", max_bytes).select(F.col("_id").alias(row_id)).distinct()
        return with_partner(rows, hits, [row_id])


def joined_through_filter(
    big: DataFrame, small: DataFrame, on: Sequence[str], expected: int, rate: float = 0.01, max_bytes: int = 64 << 20
) -> DataFrame:
    """Inner join whose big side is cut by a filter of the small side's keys before its shuffle.

    ``small`` is read twice, once for the filter. The result is that of the plain join; with more keys than
    ``expected`` only more rows of ``big`` are shuffled.
    """
    # Parts carry their length, so different keys have different texts; a null part makes the key null.
    parts = [F.concat(F.length(F.col(c).cast("string")), F.lit(":"), F.col(c).cast("string")) for c in on]
    keyed = lambda df: df.withColumn("_key", F.concat(*parts))
    cut = BlockBloom.trained(keyed(small.select(*on)), "_key", expected, rate).keep(keyed(big), "_key", max_bytes)
    return cut.drop("_key").join(small, list(on))
