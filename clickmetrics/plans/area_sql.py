"""The area report written as SQL on catalog tables or temp views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickmetrics.functions import register_sql_functions

REPORT = """
WITH counted_clicks AS (  -- one row per product and city, however many clicks a product has
    SELECT click_product_id, city_id, count(*) AS clicks
    FROM user_visit_action
    GROUP BY click_product_id, city_id),
city_clicks AS (
    SELECT area, product_name, city_name, sum(clicks) AS n
    FROM counted_clicks
    JOIN product_info ON click_product_id = product_id
    JOIN city_info USING (city_id)
    GROUP BY area, product_name, city_name),
product_clicks AS (
    SELECT area, product_name, sum(n) AS click_count
    FROM city_clicks
    GROUP BY area, product_name),
third_largest AS (  -- rank <= 3 is a count not below this one
    SELECT area, min(click_count) AS least
    FROM (SELECT area, click_count, row_number() OVER (PARTITION BY area ORDER BY click_count DESC) AS place
          FROM product_clicks)
    WHERE place <= 3
    GROUP BY area),
top_products AS (
    SELECT p.area, p.product_name
    FROM product_clicks p
    JOIN third_largest t ON p.area <=> t.area AND p.click_count >= t.least),
placed_cities AS (
    SELECT c.*, row_number() OVER (PARTITION BY c.area, c.product_name
                                   ORDER BY city_name IS NULL, n DESC, city_name) AS place
    FROM city_clicks c
    LEFT SEMI JOIN top_products t ON c.area <=> t.area AND c.product_name <=> t.product_name)
SELECT area, product_name, sum(n) AS click_count,
       city_remark(max(city_name) FILTER (WHERE place = 1),
                   max(n) FILTER (WHERE place = 1 AND city_name IS NOT NULL),
                   max(city_name) FILTER (WHERE place = 2),
                   max(n) FILTER (WHERE place = 2 AND city_name IS NOT NULL),
                   sum(n) FILTER (WHERE city_name IS NOT NULL),
                   count(city_name)) AS city_remark
FROM placed_cities
GROUP BY area, product_name"""


def register_views(spark: SparkSession, **tables: DataFrame) -> None:
    """Make DataFrames readable in SQL under the given names."""
    for name, table in tables.items():
        table.createOrReplaceTempView(name)


def area_top3_sql(spark: SparkSession) -> DataFrame:
    """Needs ``user_visit_action``, ``product_info`` and ``city_info`` as tables or views."""
    register_sql_functions(spark)
    return spark.sql(REPORT)
