from clickmetrics.functions.text import (
    city_remark_text,
    id_list,
    pairs_json,
    plain_percent,
    rate_percent,
    register_sql_functions,
)

__all__ = [
    "city_remark_text",
    "id_list",
    "pairs_json",
    "plain_percent",
    "rate_percent",
    "register_sql_functions",
]
