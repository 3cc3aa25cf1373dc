"""The report's input tables, derived from the generated parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmetrics.schemas import NO_CLICK, NO_IDS

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Which events stand for an order and for a payment.
_ORDER = "event_type = 'purchase' OR (event_type = 'click' AND k % 10 = 0)"
_PAY = "event_type = 'signup'"


def _ids(has: str, first: str, second: str) -> str:
    return f"CASE WHEN {has} THEN concat_ws(',', {first}, {second}) ELSE '{NO_IDS}' END"


def _if_click(value: str) -> str:
    return f"CASE WHEN event_type = 'click' THEN {value} ELSE {NO_CLICK}L END"


def user_visit_action(spark: SparkSession, sf_dir: str) -> DataFrame:
    products = _table(spark, sf_dir, "part").agg(F.greatest(F.lit(1), F.count("*"))).scalar()
    events = _table(spark, sf_dir, "events").selectExpr("*", "CAST(get_json_object(props, '$.k') AS bigint) AS k")
    events = events.withColumn("products", products)
    return events.selectExpr(
        "date_format(ts, 'yyyy-MM-dd') AS date",
        "user_id",
        "concat_ws('-', user_id, date_format(ts, 'yyyy-MM-dd')) AS session_id",
        "k % 8 + 1 AS page_id",
        "date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSSSSS') AS action_time",
        "'null' AS search_keyword",
        f"{_if_click('k % 20')} AS click_category_id",
        f"{_if_click('event_id % products')} AS click_product_id",
        f"{_ids(_ORDER, 'k % 20', '(k + 7) % 20')} AS order_category_ids",
        f"{_ids(_ORDER, 'event_id % products', '(event_id + 7) % products')} AS order_product_ids",
        f"{_ids(_PAY, 'k % 18', '(k + 5) % 18')} AS pay_category_ids",
        f"{_ids(_PAY, 'event_id % products', '(event_id + 5) % products')} AS pay_product_ids",
        "user_id % 25 AS city_id",
    )


def product_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "part").selectExpr("p_partkey AS product_id", "p_name AS product_name")


def city_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = _table(spark, sf_dir, "nation"), _table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).selectExpr(
        "CAST(n_nationkey AS bigint) AS city_id", "n_name AS city_name", "r_name AS area"
    )


def _lines(events: DataFrame, cities: DataFrame) -> DataFrame:
    clicks = events.where("event_type IN ('click', 'view')").selectExpr(
        "unix_millis(CAST(ts AS timestamp)) AS ts",
        "user_id",
        "CAST(get_json_object(props, '$.k') AS bigint) % 5 + 1 AS ad",
        "user_id % 25 AS city_id",
    )
    # The city table has 25 rows at every scale.
    return clicks.join(F.broadcast(cities), "city_id").selectExpr("concat_ws(',', ts, area, city_name, user_id, ad) AS value")


def ads_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(_table(spark, sf_dir, "events"), city_info(spark, sf_dir))


def ads_log_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = (
        spark.readStream.schema(EVENTS).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    )
    return _lines(events, city_info(spark, sf_dir))


def damaged(lines: DataFrame) -> DataFrame:
    """Click lines of which those of every tenth user lack the ad and those of the next have no readable time."""
    return lines.selectExpr(
        """CASE CAST(split_part(value, ',', 4) AS bigint) % 10
           WHEN 0 THEN substring_index(value, ',', 4)
           WHEN 1 THEN concat('at ', value)
           ELSE value END AS value"""
    )
