"""Word counts, line counts, dictionary counters and the link index."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from clickweave.functions.scalars import unescape
from clickweave.operators.ordering import rank_in_group
from clickweave.workspace import stored

# State abbreviations looked for in a location text.
STATES = (
    "AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DE", "FL", "GA", "HI", "ID", "IL", "IN", "IA", "KS", "KY", "LA", "ME", "MD", "MA", "MI", "MN", "MS", "MO",
    "MT", "NE", "NV", "NH", "NJ", "NM", "NY", "NC", "ND", "OH", "OK", "OR", "PA", "RI", "SC", "SF", "TN", "TX", "UT", "VT", "VA", "WA", "WV", "WI", "WY",
)
UNKNOWN, NULL_OR_EMPTY = "Unknown", "Null or Empty"


def clean_words(text: Column | str) -> Column:
    """Words of escaped text: lower case, entities undone, quotes dropped, other non-letters as blanks."""
    plain = F.replace(unescape(F.lower(text)), F.lit("'"), F.lit(""))
    return F.split(plain, "[^a-zA-Z]+")


def word_counts(df: DataFrame, words: Column) -> DataFrame:
    """Occurrences of each word; empty words are not counted and a null text has none."""
    return df.select(F.explode(words).alias("word")).where("word <> ''").groupBy("word").agg(F.count("*").alias("n"))


def line_counts(df: DataFrame, text: str) -> DataFrame:
    return df.select(F.explode(F.split(text, "\n")).alias("line")).groupBy("line").agg(F.count("*").alias("n"))


def first_known(text: Column | str, known: Sequence[str] = STATES) -> Column:
    """The first upper-cased word that is in ``known``, else a name for the gap."""
    content = text if isinstance(text, Column) else F.col(text)
    hits = F.filter(F.split(F.upper(content), r"\s"), lambda t: t.isin(*known))
    return F.when(F.coalesce(content, F.lit("")) == "", NULL_OR_EMPTY).otherwise(
        F.coalesce(F.get(hits, F.lit(0)), F.lit(UNKNOWN))
    )


def link_index(pages: DataFrame, page_id: str, body: str, pattern: str, skip: Column | None = None) -> DataFrame:
    """Link -> pages that hold it, in long form: (link, position, page id), sorted by page id.

    Rows with ``skip`` (questions, say) and rows without a body are left out.
    """
    links = F.array_distinct(F.regexp_extract_all(unescape(F.lower(body)), F.lit(pattern), F.lit(1)))
    said = pages.where(F.col(body).isNotNull() & ~F.coalesce(skip if skip is not None else F.lit(False), F.lit(False)))
    hits = stored(said.select(page_id, F.explode(links).alias("link")), "links")
    return rank_in_group(hits, ["link"], [page_id], "position").select("link", "position", page_id)
