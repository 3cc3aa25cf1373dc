"""Clicks, orders and payments per category.

Every variant reads the table once: the ids of a row become (category, action) rows that are
counted in the scan stage, so only one partial count per category and task is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmetrics.functions import id_list
from clickmetrics.schemas import NO_CLICK, NO_IDS

CLICK, ORDER, PAY = "click", "order", "pay"


def _is_click() -> Column:
    return F.col("click_category_id") != NO_CLICK


def _has(ids: str) -> Column:
    return F.col(ids) != NO_IDS


def click_counts(actions: DataFrame) -> DataFrame:
    return (
        actions.where(_is_click())
        .groupBy("click_category_id")
        .agg(F.count("*").alias("n"))
        .select(F.col("click_category_id").cast("string").alias("categoryId"), "n")
    )


def _list_counts(actions: DataFrame, ids: str) -> DataFrame:
    return (
        actions.where(_has(ids))
        .select(F.explode(id_list(F.col(ids))).alias("categoryId"))
        .groupBy("categoryId")
        .agg(F.count("*").alias("n"))
    )


def order_counts(actions: DataFrame) -> DataFrame:
    return _list_counts(actions, "order_category_ids")


def pay_counts(actions: DataFrame) -> DataFrame:
    return _list_counts(actions, "pay_category_ids")


def first_actions(actions: DataFrame) -> DataFrame:
    """(categoryId, action) rows; a row counts only as the first it has of click, order, pay."""
    # A row without any action has a NULL list here, which explode drops.
    return actions.select(
        F.explode(
            F.when(_is_click(), F.array(F.col("click_category_id").cast("string")))
            .when(_has("order_category_ids"), id_list(F.col("order_category_ids")))
            .when(_has("pay_category_ids"), id_list(F.col("pay_category_ids")))
        ).alias("categoryId"),
        F.when(_is_click(), CLICK)
        .when(_has("order_category_ids"), ORDER)
        .otherwise(PAY)
        .alias("action"),
    )


def all_actions(actions: DataFrame) -> DataFrame:
    """(categoryId, action) rows; a row counts in every action it carries."""
    nothing = F.array().cast("array<string>")
    orders, pays = F.col("order_category_ids"), F.col("pay_category_ids")
    # One list holds the row's ids of all three actions; the position tells the action. Unlike an
    # array of structs built by a lambda, this stays in generated code.
    lists = actions.select(
        F.when(_is_click(), F.array(F.col("click_category_id").cast("string"))).otherwise(nothing).alias("c"),
        F.when(_has("order_category_ids"), id_list(orders)).otherwise(nothing).alias("o"),
        F.when(_has("pay_category_ids"), id_list(pays)).otherwise(nothing).alias("p"),
    )
    clicks, ordered = F.size("c"), F.size("o")
    return lists.select(
        F.posexplode(F.concat("c", "o", "p")).alias("at", "categoryId"), clicks.alias("nc"), ordered.alias("no")
    ).select(
        "categoryId",
        F.when(F.col("at") < F.col("nc"), CLICK)
        .when(F.col("at") < F.col("nc") + F.col("no"), ORDER)
        .otherwise(PAY)
        .alias("action"),
    )


def action_counts(actions: DataFrame) -> DataFrame:
    """The long form: one row per (categoryId, action)."""
    return first_actions(actions).groupBy("categoryId", "action").agg(F.count("*").alias("n"))


def _wide(category_actions: DataFrame) -> DataFrame:
    def times(action: str) -> Column:
        return F.count(F.when(F.col("action") == action, 1))

    return category_actions.groupBy("categoryId").agg(
        times(CLICK).alias("clickCount"), times(ORDER).alias("orderCount"), times(PAY).alias("payCount")
    )


def _complete(counts: DataFrame) -> DataFrame:
    return counts.where("clickCount > 0 and orderCount > 0 and payCount > 0")


def _top(counts: DataFrame, n: int) -> DataFrame:
    return counts.orderBy(
        F.desc("clickCount"), F.desc("orderCount"), F.desc("payCount"), "categoryId"
    ).limit(n)


def top_strict(actions: DataFrame, n: int = 10) -> DataFrame:
    """Rows count in all their actions; categories need all three. Equals joining three counts."""
    return _top(_complete(_wide(all_actions(actions))), n)


def top_single_pass(actions: DataFrame, n: int = 10) -> DataFrame:
    """Rows count in their first action; ids must be numbers; categories need all three."""
    numbered = first_actions(actions).withColumn(
        "categoryId", F.col("categoryId").cast("bigint").cast("string")
    )
    return _top(_complete(_wide(numbered)), n)


def top_lenient(actions: DataFrame, n: int = 10) -> DataFrame:
    """Rows count in their first action; a missing action is 0."""
    return _top(_wide(first_actions(actions)), n)
