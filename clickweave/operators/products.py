"""Hot products per area."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from clickweave.operators.ordering import top_per_group


def area_level(area: Column, levels: Mapping[str, str], otherwise: str) -> Column:
    """Level of an area from a small mapping."""
    level = F.lit(otherwise)
    for name, value in levels.items():
        level = F.when(area == name, value).otherwise(level)
    return level


def area_top_products(
    clicks: DataFrame, cities: DataFrame, products: DataFrame, levels: Mapping[str, str], otherwise: str, n: int = 3
) -> DataFrame:
    """The ``n`` most clicked products of each area with the cities they were clicked in.

    Clicks are first counted per (city, product): that is the only shuffle over raw rows and it
    combines before it shuffles. City names and areas are joined to those counts.
    """
    per_city = (
        clicks.where(F.col("click_product_id").isNotNull())
        .groupBy("city_id", F.col("click_product_id").alias("product_id"))
        .agg(F.count("*").alias("n"))
    )
    label = F.concat_ws(":", "city_id", "city_name")
    per_area = (
        per_city.join(cities, "city_id")
        .groupBy("area", "product_id")
        .agg(
            F.sum("n").alias("click_count"),
            F.array_join(F.array_sort(F.collect_set(label)), ",").alias("city_infos"),
        )
    )
    named = per_area.join(products, "product_id").select(
        "area",
        area_level(F.col("area"), levels, otherwise).alias("area_level"),
        "product_id",
        "city_infos",
        "click_count",
        "product_name",
        F.when(F.get_json_object("extend_info", "$.product_status") == "0", "Self")
        .otherwise("Third Party")
        .alias("product_status"),
    )
    return top_per_group(named, ["area"], [F.desc("click_count"), F.asc("product_id")], n)
