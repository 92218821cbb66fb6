from clickweave.operators.products import area_top_products
from clickweave.plans import views
from clickweave.plans.registry import query

FIRST, LAST = "2024-01-03", "2024-01-27"
LEVELS = {"ASIA": "A Level", "EUROPE": "A Level", "AMERICA": "B Level", "AFRICA": "C Level"}


@query(
    "area_top3_product",
    views.sql("actions", "cities", "products") + f"""
    , counted AS (
        SELECT area, click_product_id AS product_id, count(*) AS click_count,
               string_agg(DISTINCT c.city_id || ':' || city_name, ',' ORDER BY c.city_id || ':' || city_name) AS city_infos
        FROM actions a JOIN cities c ON a.city_id = c.city_id
        WHERE click_product_id IS NOT NULL AND date BETWEEN '{FIRST}' AND '{LAST}'
        GROUP BY area, click_product_id)
    , ranked AS (
        SELECT area, CASE WHEN area IN ('ASIA', 'EUROPE') THEN 'A Level' WHEN area = 'AMERICA' THEN 'B Level'
                          WHEN area = 'AFRICA' THEN 'C Level' ELSE 'D Level' END AS area_level,
               product_id, city_infos, click_count, product_name,
               CASE WHEN json_extract_string(extend_info, '$.product_status') = '0' THEN 'Self' ELSE 'Third Party' END
                 AS product_status,
               CAST(row_number() OVER (PARTITION BY area ORDER BY click_count DESC, product_id) AS INTEGER) AS rank
        FROM counted JOIN products USING (product_id))
    SELECT * FROM ranked WHERE rank <= 3
    """,
)
def area_top3_product(spark, folder):
    return area_top_products(
        views.actions(spark, folder, FIRST, LAST, kind="click"),
        views.cities(spark, folder),
        views.products(spark, folder),
        LEVELS,
        "D Level",
    )
