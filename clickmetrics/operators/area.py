"""Product clicks per area with a city remark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmetrics.functions import city_remark_text


def area_product_clicks(actions: DataFrame, products: DataFrame, cities: DataFrame) -> DataFrame:
    """Actions with their product and city.

    No join is hinted: Spark broadcasts a dimension only while its size stays under
    ``spark.sql.autoBroadcastJoinThreshold`` and otherwise sort-merges, where adaptive execution
    splits a product id (such as the no-click mark) that fills a partition.
    """
    return (
        actions.select("click_product_id", "city_id", "click_category_id")
        .join(products, F.col("click_product_id") == F.col("product_id"))
        .join(cities, "city_id")
        .select("city_id", "city_name", "area", "product_name", "click_category_id")
    )


def city_remark(df: DataFrame, *by: str, city: str = "city_name", weight: str | None = None) -> DataFrame:
    """Per group: ``click_count`` of all rows and the ``city_remark`` text of the known cities.

    Rows are counted per (group, city) before anything is gathered, so a group's window sees one
    row per city. Equal counts are ordered by city name. ``weight`` is the column that holds how
    many clicks a row stands for.
    """
    per_city = df.groupBy(*by, F.col(city).alias("_city")).agg(
        (F.sum(weight) if weight else F.count("*")).alias("_n")
    )
    largest = Window.partitionBy(*by).orderBy(F.col("_city").isNull(), F.desc("_n"), "_city")
    known = F.col("_city").isNotNull()

    def at(place: int, column: str) -> Column:
        return F.max(F.when(known & (F.col("_place") == place), F.col(column)))

    return (
        per_city.withColumn("_place", F.row_number().over(largest))
        .groupBy(*by)
        .agg(
            F.sum("_n").alias("click_count"),
            city_remark_text(
                at(1, "_city"), at(1, "_n"), at(2, "_city"), at(2, "_n"),
                F.sum(F.when(known, F.col("_n"))), F.count("_city"),
            ).alias("city_remark"),
        )
    )


def _named_counts(actions: DataFrame, products: DataFrame, cities: DataFrame) -> DataFrame:
    """(area, product_name, city_name, clicks).

    The actions are counted per (product id, city id) before the joins: a hot product, and the
    no-click mark, enter the joins as one row per city.
    """
    counted = actions.groupBy("click_product_id", "city_id").agg(F.count("*").alias("clicks"))
    return (
        counted.join(products, F.col("click_product_id") == F.col("product_id"))
        .join(cities, "city_id")
        .groupBy("area", "product_name", "city_name")
        .agg(F.sum("clicks").alias("clicks"))
    )


def area_product_counts(actions: DataFrame, products: DataFrame, cities: DataFrame) -> DataFrame:
    """Clicks and city remark per (area, product_name)."""
    return city_remark(_named_counts(actions, products, cities), "area", "product_name", weight="clicks")


def area_product_top(counts: DataFrame, n: int = 3) -> DataFrame:
    """Rank <= n per area by clicks; equal ranks all stay, so an area may show more than n rows.

    These are the rows at or above the n-th largest count. Looking for that count alone, no task
    gets more than n rows of an area from each other task, however many products tie.
    """
    by_clicks = Window.partitionBy("area").orderBy(F.desc("click_count"))
    least = (
        counts.select("area", "click_count")
        .withColumn("place", F.row_number().over(by_clicks))
        .where(F.col("place") <= n)
        .groupBy(F.col("area").alias("_area"))
        .agg(F.min("click_count").alias("_least"))
    )
    in_area = counts["area"].eqNullSafe(F.col("_area"))
    return counts.join(least, in_area & (counts["click_count"] >= F.col("_least"))).select(*counts.columns)


def area_product_report(actions: DataFrame, products: DataFrame, cities: DataFrame, n: int = 3) -> DataFrame:
    """``area_product_top`` of ``area_product_counts``, with the remark built for the top rows only."""
    per_city = _named_counts(actions, products, cities)
    totals = per_city.groupBy("area", "product_name").agg(F.sum("clicks").alias("click_count"))
    top = area_product_top(totals, n).select(F.col("area").alias("_area"), F.col("product_name").alias("_name"))
    is_top = per_city["area"].eqNullSafe(top["_area"]) & per_city["product_name"].eqNullSafe(top["_name"])
    return city_remark(per_city.join(top, is_top, "left_semi"), "area", "product_name", weight="clicks")
