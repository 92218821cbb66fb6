"""Registered queries against their SQL on the smallest tables. ``ALL_QUERIES=1`` runs every one."""

import os

import duckdb
import pytest

from clickweave.plans.catalog import BUILDERS, SQL
from tools.check import TABLES, rows_of

SOME = [
    "area_top3_product", "map_select", "where_float_cast", "bloom_filter_docs", "grep_fullmatch", "date_keys", "udf_strlen",
    "join_full", "join_left", "join_anti_symmetric", "join_bucketed", "join_bucketed_full", "cogroup_lists", "join_three_way", "group_values",
    "wordcount_sorted", "wordcount_pages", "dictionary_counts", "tfidf_sql", "qa_hierarchy", "observe_sum", "src_parquet_sql", "src_shard_source", "src_month_dynamic", "src_json_variant", "src_xml_dump", "posts_vs_average",
    "inverted_index_links", "row_number_rank", "hierarchy_order_lines", "merged_anonymize_distinct", "session_filter",
    "session_extract", "top10_session", "page_convert_string", "src_xml_rows", "st_blacklist_static",
    "st_click_hour_total", "st_user_ad_counts", "st_window_top3", "sink_upsert_add",
]


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{small}/{name}.parquet'")
    return con


@pytest.mark.parametrize("key", sorted(BUILDERS) if os.environ.get("ALL_QUERIES") else SOME)
def test_query(spark, small, duck, key):
    got = BUILDERS[key](spark, small).toArrow()
    assert got.num_columns > 0
    if key in SQL:
        assert rows_of(got) == rows_of(duck.sql(SQL[key]).to_arrow_table())


def test_entry_points(spark):
    import __spark_entry__ as app

    assert app.entry(spark).count() > 0
    assert BUILDERS.keys() <= app.queries().keys() and SQL.keys() <= app.oracle_sql().keys()
