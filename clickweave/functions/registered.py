"""Named functions for use inside SQL text.

Each is a SQL function over built-in expressions, so it is inlined by the optimiser.
"""

from __future__ import annotations

from pyspark.sql import SparkSession, functions as F

SQL_FUNCTIONS = (
    "strLen(s STRING) RETURNS INT RETURN char_length(s)",
    "concat_long_string(n BIGINT, s STRING, sep STRING) RETURNS STRING "
    "RETURN coalesce(CAST(n AS STRING), 'null') || sep || coalesce(s, 'null')",
    "json_text(j STRING, field STRING) RETURNS STRING RETURN get_json_object(j, concat('$.', field))",
    "random_prefix(s STRING, id BIGINT, n INT) RETURNS STRING RETURN CAST(pmod(hash(id), n) AS STRING) || '_' || s",
    "remove_random_prefix(s STRING) RETURNS STRING RETURN substring(s, instr(s, '_') + 1)",
)


def register(spark: SparkSession) -> None:
    for definition in SQL_FUNCTIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {definition}")


def str_count(column: str):
    """Rows per group, nulls included."""
    return F.count(F.lit(1)).alias(column)


def group_concat_distinct(column, sep: str = ","):
    """Distinct values in order, joined."""
    return F.array_join(F.array_sort(F.collect_set(column)), sep)
