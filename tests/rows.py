"""Small hand-made inputs."""

from clickmetrics.schemas import USER_VISIT_ACTION, column_names

PLAIN = {
    "date": "2024-01-01",
    "user_id": 1,
    "session_id": "s",
    "page_id": 1,
    "action_time": "2024-01-01 00:00:00",
    "search_keyword": "null",
    "click_category_id": -1,
    "click_product_id": -1,
    "order_category_ids": "null",
    "order_product_ids": "null",
    "pay_category_ids": "null",
    "pay_product_ids": "null",
    "city_id": 1,
}


def actions(spark, *changes):
    names = column_names(USER_VISIT_ACTION)
    data = [tuple({**PLAIN, **c}[n] for n in names) for c in changes]
    return spark.createDataFrame(data, USER_VISIT_ACTION)


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def millis(day, clock="00:00:00"):
    import datetime as dt

    return int(dt.datetime.fromisoformat(f"{day}T{clock}+00:00").timestamp() * 1000)


def found(df):
    return sorted(tuple(r) for r in df.collect())
