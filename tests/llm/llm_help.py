"""Fixtures and helpers of these tests."""

import pytest

LONG = " ".join(f"w{i % 977}x{i // 977}" for i in range(30_000))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, equal rows, equal texts, columns with clashing names."""
    rows = [
        (1, "Alpha beta gamma", "s0", 7, "x"), (2, "alpha BETA gamma", "s1", 7, None), (3, None, None, None, None), (4, "", "s0", 1, "x"),
        (5, LONG, "s0", 2, "y"), (6, LONG.upper(), "s1", 2, "y"), (None, "alpha beta gamma", "s0", 3, "z"), (None, "only without id", None, 3, "z"),
        (7, "same row", "s0", 4, "t"), (7, "same row", "s0", 4, "t"), (7, "same row", "s0", 4, "t"), (8, " \t\n ", "s1", 5, "t"),
        (9, "ÄÖ äö   ünï", "s1", 5, "t"), (10, "äö ÄÖ   ünï", "s1", 5, "t"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, shard int, node string").repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, source string, shard int, node string")


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
