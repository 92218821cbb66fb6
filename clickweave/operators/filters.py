"""Row filters: patterns, samples, well-formed lines, membership."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clickweave.functions.hashing import hash_bucket
from clickweave.operators.joins import with_partner


def full_match(text: Column, pattern: str) -> Column:
    """True if the whole text matches."""
    return text.rlike(rf"\A(?:{pattern})\z")


def sample_percent(df: DataFrame, percent: float, seed: int) -> DataFrame:
    return df.sample(False, percent / 100.0, seed)


def sample_percent_by_key(df: DataFrame, percent: int, *key: str) -> DataFrame:
    """A sample that is the same in every run: keys whose md5 falls in the first ``percent`` of 100 buckets."""
    return df.where(hash_bucket(100, *key) < percent)


def well_formed(lines: DataFrame, column: str, fields: int, sep: str = ",") -> DataFrame:
    """Lines with exactly ``fields`` fields; a trailing empty field counts as missing."""
    parts = F.split(column, sep)
    return lines.where((F.size(parts) == fields) & (F.element_at(parts, -1) != ""))


def keep_by_join(df: DataFrame, tokens: Column, words: DataFrame, column: str, row_id: str) -> DataFrame:
    """Rows with any token in ``words``, exactly."""
    pairs = df.select(row_id, F.explode(F.array_distinct(tokens)).alias(column))
    hits = with_partner(pairs, words, [column]).select(row_id)
    return with_partner(df, hits, [row_id])
