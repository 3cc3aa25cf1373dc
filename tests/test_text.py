from decimal import ROUND_HALF_EVEN, Decimal

from pyspark.sql import functions as F

from clickmetrics.functions import id_list, plain_percent, rate_percent


def test_id_list(spark):
    cases = {"1,2": ["1", "2"], "1,2,,": ["1", "2"], ",,": [], "": [""], ",3": ["", "3"], "7": ["7"], "a,,b": ["a", "", "b"]}
    df = spark.createDataFrame([(c,) for c in cases], "ids string").select("ids", id_list(F.col("ids")).alias("got"))
    assert {r.ids: r.got for r in df.collect()} == cases


def test_percent_texts(spark):
    """Against exact decimals of the same fractions, half rounded to even."""
    fractions = [(a, b) for b in (1, 2, 3, 7, 8, 16, 32, 64, 125, 200, 799) for a in range(b + 1)]
    df = spark.createDataFrame(fractions, "a int, b int").withColumn("r", F.col("a").cast("double") / F.col("b"))
    for r in df.select("a", "b", plain_percent(F.col("r")).alias("p"), rate_percent(F.col("r")).alias("q")).collect():
        exact = (Decimal(100) * r.a / r.b).quantize(Decimal("0.01"), ROUND_HALF_EVEN)
        assert r.p == f"{exact}%"
        assert r.q == r.p.removeprefix("0")
