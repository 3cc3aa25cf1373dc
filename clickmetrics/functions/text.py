"""Column functions for id lists, percent texts and JSON payloads."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Fixed values of the report texts: the label of "all other cities" and the percent patterns.
OTHER_CITIES = "其它"
RATE_PATTERN = ".00%"
SHARE_PATTERN = "0.00%"


def id_list(ids: Column) -> Column:
    """Split a comma list; empty entries at the end are dropped, an empty text is one empty id."""
    body = F.rtrim(ids, F.lit(","))
    return (
        F.when(ids == "", F.array(F.lit("")))
        .when(body == "", F.array().cast("array<string>"))
        .otherwise(F.split(body, ","))
    )


def rate_percent(rate: Column) -> Column:
    """0.005 -> ``.50%``, 0.5 -> ``50.00%``."""
    return F.call_function("format_number", rate, F.lit(RATE_PATTERN))


def plain_percent(rate: Column) -> Column:
    """0.005 -> ``0.50%``, 0.5 -> ``50.00%``."""
    return F.call_function("format_number", rate, F.lit(SHARE_PATTERN))


def city_remark_text(
    city1: Column, n1: Column, city2: Column, n2: Column, total: Column, cities: Column
) -> Column:
    """The two largest shares and, with more than two cities, the share of all others."""
    share1 = n1.cast("double") / total
    share2 = n2.cast("double") / total
    rest = F.lit(1.0) - share1 - share2

    def entry(name: Column, share: Column) -> Column:
        return F.concat(name, F.lit(":"), plain_percent(share))

    return F.concat_ws(
        ",",
        F.when(cities >= 1, entry(city1, share1)),
        F.when(cities >= 2, entry(city2, share2)),
        F.when(cities > 2, entry(F.lit(OTHER_CITIES), rest)),
    )


def pairs_json(pairs: Column, name: str, count: str) -> Column:
    """Array of structs -> ``[{"<name>":<count>},...]``, one object per entry, in array order."""
    return F.to_json(F.transform(pairs, lambda p: F.create_map(p[name], p[count])))


def register_sql_functions(spark: SparkSession) -> None:
    """Make the remark text callable from SQL.

    It takes the result of the counting, not the raw rows, so the counting itself stays a plain
    GROUP BY with map-side partial sums.
    """
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION city_remark(
            city1 STRING, n1 BIGINT, city2 STRING, n2 BIGINT, total BIGINT, cities BIGINT)
        RETURNS STRING
        RETURN concat_ws(',',
            CASE WHEN cities >= 1 THEN
                concat(city1, ':', format_number(CAST(n1 AS DOUBLE) / total, '{SHARE_PATTERN}')) END,
            CASE WHEN cities >= 2 THEN
                concat(city2, ':', format_number(CAST(n2 AS DOUBLE) / total, '{SHARE_PATTERN}')) END,
            CASE WHEN cities > 2 THEN concat('{OTHER_CITIES}:', format_number(
                CAST(1 AS DOUBLE) - CAST(n1 AS DOUBLE) / total - CAST(n2 AS DOUBLE) / total,
                '{SHARE_PATTERN}')) END)
    """)
