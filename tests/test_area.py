from pyspark.sql import functions as F

from clickmetrics.operators import area
from clickmetrics.plans.area_sql import area_top3_sql, register_views
from tests.rows import actions, found

CLICKS = "area string, product_name string, city_name string"
PRODUCTS = "product_id bigint, product_name string"
CITIES = "city_id bigint, city_name string, area string"


def remark(spark, cities):
    df = spark.createDataFrame([("A", "p", c) for c in cities], CLICKS)
    return [tuple(r) for r in area.city_remark(df, "area", "product_name").collect()]


def test_city_mix(spark):
    text = "bj:50.00%,tj:33.33%,其它:16.67%"
    assert remark(spark, ["bj"] * 3 + ["tj"] * 2 + ["sh", None]) == [("A", "p", 7, text)]


def test_few_cities(spark):
    assert remark(spark, [None]) == [("A", "p", 1, "")]
    assert remark(spark, ["x"]) == [("A", "p", 1, "x:100.00%")]
    assert remark(spark, ["b", "a", None, None, None]) == [("A", "p", 5, "a:50.00%,b:50.00%")]


def test_rank_keeps_ties(spark):
    counts = spark.createDataFrame(
        [("A", f"p{i}", n, "") for i, n in enumerate([5, 4, 3, 3, 2])] + [("B", "q", 1, "")],
        "area string, product_name string, click_count bigint, city_remark string",
    )
    assert [r[1] for r in found(area.area_product_top(counts))] == ["p0", "p1", "p2", "p3", "q"]


def inputs(spark):
    clicks = [(1, 1), (1, 1), (1, 2), (2, 1), (2, 3), (3, 1), (-1, 1), (-1, 2)]
    df = actions(spark, *[{"click_product_id": p, "city_id": c} for p, c in clicks])
    products = spark.createDataFrame([(1, "pen"), (2, "pen"), (3, "cup"), (-1, "none")], PRODUCTS)
    cities = spark.createDataFrame([(1, "bj", "N"), (2, None, "N"), (3, "gz", "S")], CITIES)
    return df, products, cities


def test_equal_names_merge_and_the_no_click_mark_may_match(spark):
    got = found(area.area_product_counts(*inputs(spark)))
    assert got == [
        ("N", "cup", 1, "bj:100.00%"),
        ("N", "none", 2, "bj:100.00%"),
        ("N", "pen", 4, "bj:100.00%"),
        ("S", "pen", 1, "gz:100.00%"),
    ]
    raw = area.city_remark(area.area_product_clicks(*inputs(spark)), "area", "product_name")
    assert found(raw) == got


def test_sql_report_equals_dataframe_report(spark):
    df, products, cities = inputs(spark)
    register_views(spark, user_visit_action=df, product_info=products, city_info=cities)
    expected = found(area.area_product_top(area.area_product_counts(df, products, cities)))
    assert found(area_top3_sql(spark)) == expected
    assert found(area.area_product_report(df, products, cities)) == expected


def test_tied_products_of_one_area_do_not_meet_in_one_task(spark):
    counts = spark.range(0, 100_000, 1, 16).selectExpr(
        "CASE WHEN id % 10 = 0 THEN 'B' END AS area", "concat('p', id) AS product_name", "7L AS click_count"
    )
    top = area.area_product_top(counts)
    per_task = top.groupBy(F.spark_partition_id().alias("task")).count()
    assert top.count() == 100_000
    assert per_task.agg({"count": "max"}).first()[0] <= 10_000


def test_remark_text_in_sql(spark):
    area_top3_sql(spark)
    text = spark.sql("SELECT city_remark('bj', 3, 'tj', 2, 6, 3)").first()[0]
    assert text == "bj:50.00%,tj:33.33%,其它:16.67%"
    assert spark.sql("SELECT city_remark(NULL, NULL, NULL, NULL, NULL, 0)").first()[0] == ""
