"""Pseudo-random numbers that are the same on every retry and in every engine."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def hash_number(*parts: Column | str, offset: int = 0) -> Column:
    """32 bits of the md5 of the parts joined with ``|``; ``offset`` picks one of four words."""
    digest = F.md5(F.concat_ws("|", *parts))
    return F.conv(F.substring(digest, 1 + 8 * offset, 8), 16, 10).cast("long")


def hash_bucket(n: Column | int, *parts: Column | str, offset: int = 0) -> Column:
    """A bucket 0..n-1 drawn from the md5 of the parts."""
    count = n if isinstance(n, Column) else F.lit(n)
    return F.pmod(hash_number(*parts, offset=offset), count)


def salt(n: int, *parts: Column | str) -> Column:
    """A cheap salt 0..n-1 for spreading rows; only ever used inside one Spark job."""
    return F.pmod(F.xxhash64(*parts), F.lit(n)).cast("int")


def sql_hash_number(expression: str, offset: int = 0) -> str:
    """The SQL twin of ``hash_number`` for an expression that is already joined with ``|``."""
    return f"CAST('0x' || substr(md5({expression}), {1 + 8 * offset}, 8) AS BIGINT)"
