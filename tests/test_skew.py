"""Joins without a broadcast: the rows of one hot key are split over several tasks."""

import pytest

from clickmetrics.operators import ads as A
from clickmetrics.operators import area
from clickmetrics.schemas import ADS_INFO, USER_VISIT_ACTION, column_names
from tests.rows import PLAIN

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@pytest.fixture
def tiny_partitions(spark):
    before = {key: spark.conf.get(key, None) for key in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_product_is_split(spark, tiny_partitions):
    plain = {**PLAIN, "click_product_id": None, "city_id": None}
    fixed = [f"CAST('{v}' AS string) AS {k}" if isinstance(v, str) else f"{v}L AS {k}"
             for k, v in plain.items() if v is not None]
    ids = "CASE WHEN id % 3 = 0 THEN -1L ELSE id % 1000 END AS click_product_id"
    actions = spark.range(0, 60_000, 1, 16).selectExpr(*fixed, ids, "id % 5 AS city_id")
    actions = actions.select(*column_names(USER_VISIT_ACTION))
    products = spark.range(-1, 1000).selectExpr("id AS product_id", "concat('p', id % 60) AS product_name")
    cities = spark.range(5).selectExpr("id AS city_id", "concat('c', id) AS city_name", "'A' AS area")
    clicks = area.area_product_clicks(actions, products, cities)
    assert "skew=true" in final_plan(clicks)
    assert clicks.count() == 60_000
    # Counted before the joins, the same hot product is one row per city.
    counts = area.area_product_counts(actions, products, cities)
    assert "skew=true" not in final_plan(counts)
    assert counts.agg({"click_count": "sum"}).first()[0] == 60_000


def hot_user_clicks(ids):
    """Clicks of which every third belongs to one user."""
    texts = ["'N' AS area", "'c' AS city", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE string(id % 997) END AS userId"]
    ads = ids.selectExpr(
        "id AS ts", "timestamp_millis(id) AS timestamp", "'1970-01-01' AS dayString", "'00:00' AS hmString",
        *texts, "string(id % 5) AS adsId",
    )
    return ads.select(*column_names(ADS_INFO))


def some_users(spark, *more):
    users = [("1970-01-01", str(u)) for u in [*range(500), *more]]
    return spark.createDataFrame(users, "dayString string, userId string")


def shuffled_rows(df):
    """Rows that the exchanges of a finished plan wrote, largest first."""
    plan, found = df._jdf.queryExecution().executedPlan(), []
    stack = [plan.finalPhysicalPlan()]
    while stack:
        node = stack.pop()
        children = node.children()
        stack += [children.apply(i) for i in range(children.size())]
        if node.nodeName().startswith("ShuffleQueryStage"):
            stack.append(node.plan())
        if node.nodeName() == "Exchange":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
    return sorted(found, reverse=True)


def test_hot_listed_user_is_split(spark, tiny_partitions):
    clicks = hot_user_clicks(spark.range(0, 60_000, 1, 16))
    kept = A.drop_blacklisted(clicks, some_users(spark, "hot"))
    assert "skew=true" in final_plan(kept)
    listed = {str(u) for u in range(500)} | {"hot"}
    assert kept.count() == clicks.where(~clicks.userId.isin(listed)).count()


def test_clean_clicks_are_not_shuffled(spark, tiny_partitions):
    clicks = hot_user_clicks(spark.range(0, 60_000, 1, 16))
    kept = A.drop_blacklisted(clicks, some_users(spark))
    rows = kept.collect()
    listed = clicks.where(clicks.userId.isin([str(u) for u in range(500)])).count()
    assert len(rows) == 60_000 - listed and sum(r["userId"] == "hot" for r in rows) == 20_000
    # Only the listed users' clicks meet the list: the hot user, who is not on it, stays in place.
    assert shuffled_rows(kept)[0] <= listed * 1.01 < 25_000


def test_false_hits_of_the_filter_are_kept(spark, monkeypatch):
    monkeypatch.setattr(A, "FILTER_WORDS", 1)  # one word for all: nearly every click looks listed
    clicks = hot_user_clicks(spark.range(0, 3_000))
    (word,) = A.user_filter(some_users(spark)).collect()
    assert bin(word["mask"] & (2**64 - 1)).count("1") > 60
    expected = clicks.where(~clicks.userId.isin([str(u) for u in range(500)]))
    assert sorted(A.drop_blacklisted(clicks, some_users(spark)).collect()) == sorted(expected.collect())
    nobody = some_users(spark).limit(0)
    assert A.drop_blacklisted(clicks, nobody).count() == 3_000


def test_clicks_without_day_or_user_are_kept(spark):
    clicks = hot_user_clicks(spark.range(0, 10)).selectExpr("* EXCEPT (userId)", "CAST(NULL AS string) AS userId")
    clicks = clicks.select(*column_names(ADS_INFO))
    assert A.drop_blacklisted(clicks, some_users(spark)).count() == 10


def test_hot_user_is_split_inside_a_stream(spark, tiny_partitions, tmp_path):
    source = str(tmp_path / "in")
    spark.range(0, 60_000, 1, 16).write.parquet(source)
    plans = []

    def on_batch(clicks, _):
        plans.append(final_plan(A.drop_blacklisted(clicks, some_users(clicks.sparkSession, "hot"))))

    clicks = hot_user_clicks(spark.readStream.schema("id bigint").parquet(source))
    query = clicks.writeStream.foreachBatch(on_batch).option("checkpointLocation", str(tmp_path / "c"))
    query.trigger(availableNow=True).start().awaitTermination()
    assert len(plans) == 1 and "skew=true" in plans[0]
