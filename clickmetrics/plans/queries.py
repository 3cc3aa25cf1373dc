"""The named queries, each from a session and the folder of the generated tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmetrics.operators import ads, area, category, pages, sessions
from clickmetrics.plans.area_sql import area_top3_sql, register_views
from clickmetrics.session import work_folder
from clickmetrics.sources import testtables
from clickmetrics.sources.actions import action_lines, parse_actions, save_clustered_actions
from clickmetrics.sources.ads import check_ads, parse_ads, split_checked, stream_ads_files
from clickmetrics.streaming import jobs
from clickmetrics.streaming.tables import stamp_files

Query = Callable[[SparkSession, str], DataFrame]

FLOW = "1,2,3,4,5,6"
MIN_CLICKS = 2
# 2024-01-01 00:00 UTC, in milliseconds.
FIRST_ARRIVAL = 1_704_067_200_000


def _actions(query: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: query(testtables.user_visit_action(spark, sf))


def _area(query: Callable[[DataFrame, DataFrame, DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: query(
        testtables.user_visit_action(spark, sf),
        testtables.product_info(spark, sf),
        testtables.city_info(spark, sf),
    )


def _ads(query: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: query(parse_ads(testtables.ads_log(spark, sf)))


def _stream(start: Callable, read: Callable[[SparkSession, str], DataFrame], **options) -> Query:
    """Runs a streaming job over all clicks until they are used up, then reads its table."""

    def query(spark: SparkSession, sf: str) -> DataFrame:
        folder = work_folder(spark, "ads")
        clicks = parse_ads(testtables.ads_log_stream(spark, sf))
        start(clicks, folder, trigger={"availableNow": True}, **options).awaitTermination()
        return read(spark, folder)

    return query


def _passed(spark: SparkSession, sf: str) -> DataFrame:
    """Clicks that pass the blacklist loop when they arrive by quarters of the day, in four batches."""
    folder = work_folder(spark, "ads")
    lines = testtables.ads_log(spark, sf)
    hour = F.expr("hour(timestamp_millis(CAST(split_part(value, ',', 1) AS bigint)))")
    for quarter in range(4):
        lines.where(F.floor(hour / 6) == quarter).write.mode("append").text(f"{folder}/in")
        clicks = parse_ads(stream_ads_files(spark, f"{folder}/in"))
        jobs.start_blacklist_loop(
            clicks, f"{folder}/job", trigger={"availableNow": True}, min_clicks=MIN_CLICKS
        ).awaitTermination()
    return jobs.read_passed(spark, f"{folder}/job")


def _arrivals(spark: SparkSession, sf: str) -> DataFrame:
    """The last hour by arrival: a quarter's clicks arrive together, 25 minutes after those of the quarter before."""
    folder = work_folder(spark, "ads")
    lines = testtables.ads_log(spark, sf)
    hour = F.expr("hour(timestamp_millis(CAST(split_part(value, ',', 1) AS bigint)))")
    for quarter in range(4):
        lines.where(F.floor(hour / 6) == quarter).write.text(f"{folder}/in/{quarter}")
        stamp_files(spark, f"{folder}/in/{quarter}", FIRST_ARRIVAL + quarter * 25 * 60_000)
        clicks = parse_ads(stream_ads_files(spark, f"{folder}/in/*", arrival=True))
        jobs.start_last_hour(clicks, f"{folder}/job", trigger={"availableNow": True}, time="arrival").awaitTermination()
    return jobs.read_last_hour(spark, f"{folder}/job").select("adsId", "minute", "n")


CATALOG_DAYS = ("2024-01-03", "2024-01-12")


def _catalog_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Page conversion over ten days of a clustered catalog table, reached after ``USE``."""
    folder = work_folder(spark, "shop")
    database = f"shop_{uuid.uuid4().hex}"
    before = spark.catalog.currentDatabase()
    spark.sql(f"CREATE DATABASE {database} LOCATION '{folder}'")
    try:
        spark.catalog.setCurrentDatabase(database)
        save_clustered_actions(testtables.user_visit_action(spark, sf), "actions_by_session", buckets=8)
        actions = spark.table("actions_by_session").where(F.col("date").between(*CATALOG_DAYS))
        return _rounded(pages.page_conversion(actions, FLOW))
    finally:
        spark.catalog.setCurrentDatabase(before)


def _line_counts(spark: SparkSession, sf: str) -> DataFrame:
    folder = work_folder(spark, "ads")
    lines = testtables.damaged(testtables.ads_log_stream(spark, sf))
    jobs.start_checked_append(lines, folder, trigger={"availableNow": True}).awaitTermination()
    return jobs.read_line_counts(spark, folder)


def _sessions_as_text(df: DataFrame) -> DataFrame:
    return df.withColumn("sessions", F.to_json("sessions"))


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumn("rate", F.round("rate", 6))


def _area_sql(spark: SparkSession, sf: str) -> DataFrame:
    register_views(
        spark,
        user_visit_action=testtables.user_visit_action(spark, sf),
        product_info=testtables.product_info(spark, sf),
        city_info=testtables.city_info(spark, sf),
    )
    return area_top3_sql(spark)


QUERIES: dict[str, Query] = {
    "uva_parse": _actions(lambda a: parse_actions(action_lines(a))),
    "category_click_counts": _actions(category.click_counts),
    "category_order_counts": _actions(category.order_counts),
    "category_pay_counts": _actions(category.pay_counts),
    "category_top10_strict": _actions(category.top_strict),
    "category_top10_single_pass": _actions(category.top_single_pass),
    "category_top10_lenient": _actions(category.top_lenient),
    "category_action_counts": _actions(category.action_counts),
    "category_session_top10": _actions(lambda a: sessions.top_sessions(a, category.top_strict(a))),
    "category_session_top10_nested": _actions(
        lambda a: _sessions_as_text(sessions.top_sessions_nested(a, category.top_strict(a)))
    ),
    "category_session_top10_ranked": _actions(
        lambda a: _sessions_as_text(sessions.top_sessions_ranked(a, category.top_strict(a)))
    ),
    "page_visit_counts": _actions(lambda a: pages.page_visits(a, FLOW)),
    "page_transition_counts": _actions(lambda a: pages.page_transitions(a, FLOW)),
    "page_conversion_rate": _actions(lambda a: _rounded(pages.page_conversion(a, FLOW))),
    "page_conversion_catalog": _catalog_pages,
    "area_product_clicks": _area(area.area_product_clicks),
    "area_product_counts": _area(area.area_product_counts),
    "area_product_top3": _area(area.area_product_report),
    "area_product_top3_sql": _area_sql,
    "city_remark": _area(
        lambda a, p, c: area.city_remark(area.area_product_clicks(a, p, c), "area").select("area", "city_remark")
    ),
    "ads_log_parse": _ads(lambda a: a),
    "ads_rejected_lines": lambda spark, sf: split_checked(check_ads(testtables.damaged(testtables.ads_log(spark, sf))))[1],
    "ads_line_counts_stream": _line_counts,
    "ads_daily_area_counts": _ads(ads.daily_area_counts),
    "ads_area_top3": _ads(ads.area_top3),
    "ads_area_top3_json": _ads(ads.area_top3_json),
    "ads_last_hour_clicks": _ads(ads.last_hour_clicks),
    "ads_last_hour_json": _ads(ads.last_hour_json),
    "ads_blacklist_build": _ads(lambda a: ads.build_blacklist(a, MIN_CLICKS)),
    "ads_blacklist_filter": _ads(lambda a: ads.drop_blacklisted(a, ads.build_blacklist(a, MIN_CLICKS))),
    "ads_raw_append": _stream(jobs.start_raw_append, jobs.read_raw),
    "ads_daily_area_counts_stream": _stream(
        jobs.start_daily_area_counts, lambda spark, f: jobs.counts_table(f).read(spark)
    ),
    "ads_area_top3_stream": _stream(jobs.start_area_top3, jobs.read_top3),
    "ads_area_top3_json_stream": _stream(
        jobs.start_area_top3, jobs.read_top3_hash
    ),
    "ads_last_hour_clicks_stream": _stream(
        jobs.start_last_hour,
        lambda spark, f: jobs.read_last_hour(spark, f).select("adsId", "hmString", "n"),
    ),
    "ads_last_hour_json_stream": _stream(
        jobs.start_last_hour, jobs.read_last_hour_hash
    ),
    "ads_last_hour_arrival_stream": _arrivals,
    "ads_blacklist_build_stream": _stream(
        jobs.start_blacklist, lambda spark, f: jobs.blacklist_table(f).read(spark), min_clicks=MIN_CLICKS
    ),
    "ads_blacklist_loop_stream": _stream(
        jobs.start_blacklist_loop, lambda spark, f: jobs.blacklist_table(f).read(spark), min_clicks=MIN_CLICKS
    ),
    "ads_blacklist_passed_stream": _passed,
}
