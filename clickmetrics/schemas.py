"""Column layouts of the input tables, as Spark DDL strings."""

USER_VISIT_ACTION = (
    "date string, user_id bigint, session_id string, page_id bigint, action_time string, "
    "search_keyword string, click_category_id bigint, click_product_id bigint, "
    "order_category_ids string, order_product_ids string, pay_category_ids string, "
    "pay_product_ids string, city_id bigint"
)

ADS_INFO = (
    "ts bigint, timestamp timestamp, dayString string, hmString string, "
    "area string, city string, userId string, adsId string"
)

# Key-value rows written by the streaming sinks: hash name, hash field, payload.
KEY_VALUE = "key string, field string, value string"

# How the action table writes "no click" and "no id list".
NO_CLICK = -1
NO_IDS = "null"


def column_names(ddl: str) -> list[str]:
    return [part.split()[0] for part in ddl.split(",")]
