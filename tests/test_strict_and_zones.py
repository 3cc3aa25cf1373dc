"""Strict parsing whatever is read, text lines with NULL, and days in the session's time zone."""

import pytest

from clickmetrics.operators import pages
from clickmetrics.sources import actions as SA
from clickmetrics.sources import ads as SD
from clickmetrics.streaming import jobs
from tests.rows import actions


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_strict_fails_on_lines_that_are_not_read(spark, ansi):
    good = SA.action_lines(actions(spark, {})).first()[0]
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        lines = spark.createDataFrame([(good,), ("2024_x_s_3",)], "value string")
        for result in (SA.parse_actions(lines), pages.page_visits(SA.parse_actions(lines), "1,2,3")):
            with pytest.raises(Exception, match="bad line"):
                result.count()
        assert SA.parse_actions(lines, "permissive").count() == 1
        with pytest.raises(Exception, match="bad line"):
            SD.parse_ads(spark.createDataFrame([("1,a,b",)], "value string")).count()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_lines_keep_their_columns(spark):
    line = SA.action_lines(actions(spark, {"search_keyword": None})).first()[0]
    assert len(line.split("_")) == 13
    with pytest.raises(Exception, match="separator in field"):
        SA.action_lines(actions(spark, {"search_keyword": "a_b"})).collect()


@pytest.mark.parametrize("zone", ["Asia/Shanghai", "America/New_York"])
def test_watermarked_days_follow_the_zone(spark, zone, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        clicks = spark.sql(
            "SELECT concat_ws(',', unix_millis(t), 'a', 'c', 'u', '1') AS value FROM VALUES "
            "(timestamp'2024-11-03 02:00:00'), (timestamp'2024-11-03 12:00:00'), (timestamp'2024-11-03 20:00:00') AS v(t)"
        )
        clicks.write.text(str(tmp_path / "in"))
        stream = SD.parse_ads(SD.stream_ads_files(spark, str(tmp_path / "in")))
        folder = str(tmp_path / "job")
        query = jobs.start_daily_area_counts(stream, folder, {"availableNow": True}, watermark="2 days")
        query.awaitTermination()
        assert [(r.dayString, r.n) for r in jobs.counts_table(folder).read(spark).collect()] == [("2024-11-03", 3)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
