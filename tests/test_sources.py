import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import Observation

from clickmetrics.operators import pages
from clickmetrics.sources import actions as SA
from clickmetrics.sources import ads as S
from clickmetrics.sources import testtables
from tests.rows import actions, found, lines, millis


def test_actions_text_round_trip(spark, tmp_path):
    df = actions(spark, {}, {"session_id": "t", "order_category_ids": "1,2,", "city_id": 9})
    SA.write_actions_text(df, str(tmp_path / "a"))
    back = SA.read_actions_text(spark, str(tmp_path / "a"))
    assert back.dtypes == df.dtypes
    assert found(back) == found(df)


def test_actions_modes(spark):
    good = SA.action_lines(actions(spark, {})).first()[0]
    bad = lines(spark, good, "a_b", good.replace("_s_1_", "_s_x_"))
    assert SA.parse_actions(bad, "permissive").count() == 1
    with pytest.raises(Exception):
        SA.parse_actions(bad).collect()


def test_ads_line(spark):
    got = S.parse_ads(lines(spark, "1569572798366,华南,深圳,101,2")).selectExpr(
        "ts", "unix_millis(timestamp)", "dayString", "hmString", "area", "city", "userId", "adsId"
    )
    assert found(got) == [(1569572798366, 1569572798366, "2019-09-27", "08:26", "华南", "深圳", "101", "2")]


@pytest.mark.parametrize("bad", ["abc,x", "abc,a,c,1,2", "1,a,c,1", "1,a,c,1,", ""])
def test_ads_modes(spark, bad):
    mixed = lines(spark, f"{millis('2024-01-01')},a,c,1,2", bad)
    assert S.parse_ads(mixed, "permissive").count() == 1
    with pytest.raises(Exception):
        S.parse_ads(mixed).collect()


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        S.parse_ads(lines(spark, ""), "other")
    with pytest.raises(ValueError):
        SA.parse_actions(lines(spark, ""), "other")


def test_kafka_needs_its_package(spark):
    with pytest.raises(AnalysisException, match="kafka"):
        S.stream_ads_kafka(spark, "host:9092", maxOffsetsPerTrigger="1000")


def test_catalog_tables(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS shop")
    before = spark.catalog.currentDatabase()
    for name in ("user_visit_action", "product_info", "city_info"):
        spark.range(1).createOrReplaceTempView(name)
    try:
        assert set(SA.catalog_tables(spark, "shop")) == {"user_visit_action", "product_info", "city_info"}
        assert spark.catalog.currentDatabase() == "shop"
    finally:
        spark.catalog.setCurrentDatabase(before)
        spark.sql("DROP DATABASE shop CASCADE")


BAD = ["abc,a,c,1,2", "1,a,c,1", "", "x", ",,,,", "1,a,c,1,", "9" * 30 + ",a,c,1,2"]
WHY = [S.BAD_TIME, *[S.MISSING_FIELD] * 5, S.BAD_TIME]


def test_rejected_lines_have_a_reason_and_are_counted_in_passing(spark):
    good = [f"{millis('2024-01-01') + k},a,c,1,2" for k in range(5)]
    both = lines(spark, *good, *BAD)
    observation = Observation()
    checked = S.observe_lines(S.check_ads(both), observation)
    rows = checked.collect()
    assert S.line_counts(observation) == [("good", 5), (S.MISSING_FIELD, 5), (S.BAD_TIME, 2)]
    assert len(rows) == 12
    clicks, rejected = S.split_checked(S.check_ads(both))
    assert found(clicks) == found(S.parse_ads(both, "permissive"))
    assert found(rejected) == sorted(zip(BAD, WHY))


def _exchanges(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("Exchange hashpartitioning")


def test_clustered_table_needs_no_shuffle_by_session(spark, tmp_path):
    df = testtables.user_visit_action(spark, "/root/testdata/sf0.01")
    spark.sql(f"CREATE DATABASE clustered LOCATION '{tmp_path / 'db'}'")
    before = spark.catalog.currentDatabase()
    # A broadcast or a scan without buckets would hide what is looked at.
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    try:
        spark.catalog.setCurrentDatabase("clustered")
        SA.save_clustered_actions(df, "actions_by_session", buckets=4)
        table = spark.table("actions_by_session").where("date IN ('2024-01-03', '2024-01-05')")
        steps = pages.page_steps(table, "1,2,3")
        expected = pages.page_steps(df.where("date IN ('2024-01-03', '2024-01-05')"), "1,2,3")
        assert found(steps.fillna(-1)) == found(expected.fillna(-1))
        assert _exchanges(expected) == 3 and _exchanges(steps) == 0
        plan = steps._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [date" in plan and "Bucketed: true" in plan
        assert sorted(p.name for p in (tmp_path / "db" / "actions_by_session").glob("date=*"))[:2] == ["date=2024-01-01", "date=2024-01-02"]
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
        spark.catalog.setCurrentDatabase(before)
        spark.sql("DROP DATABASE clustered CASCADE")
