"""The sessions with most clicks inside each top category.

``top`` is a result of ``operators.category.top_*``: at most n rows, so it is safe to broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickmetrics.schemas import NO_CLICK


def top_sessions(actions: DataFrame, top: DataFrame, n: int = 10) -> DataFrame:
    """Flat rows. Ties at place n are cut by session id."""
    clicks = (
        actions.where(F.col("click_category_id") != NO_CLICK)
        .select(
            F.col("click_category_id").cast("string").alias("categoryId"),
            F.col("session_id").alias("sessionId"),
        )
        .join(F.broadcast(top.select("categoryId")), "categoryId", "left_semi")
    )
    counts = clicks.groupBy("categoryId", "sessionId").agg(F.count("*").alias("clickCount"))
    # The rank filter is applied in each task before the shuffle, so a category that owns most
    # clicks still sends only n rows per task to its window.
    best_first = Window.partitionBy("categoryId").orderBy(F.desc("clickCount"), "sessionId")
    return (
        counts.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= n).drop("rank")
    )


def nest_sessions(flat: DataFrame) -> DataFrame:
    """One row per category with its sessions as a list, best first."""
    ordered = F.array_sort(
        F.collect_list(F.struct((-F.col("clickCount")).alias("order"), "sessionId", "clickCount"))
    )
    return flat.groupBy("categoryId").agg(
        F.transform(ordered, lambda s: F.struct(s["sessionId"], s["clickCount"])).alias("sessions")
    )


def top_sessions_nested(actions: DataFrame, top: DataFrame, n: int = 10) -> DataFrame:
    return nest_sessions(top_sessions(actions, top, n))


def top_sessions_ranked(actions: DataFrame, top: DataFrame, n: int = 10) -> DataFrame:
    """The nested form with the category's place; a top category without clicks keeps a row."""
    place = Window.orderBy(F.desc("clickCount"), F.desc("orderCount"), F.desc("payCount"), "categoryId")
    ranked = top.select(F.row_number().over(place).alias("category_rank"), "categoryId")
    nested = top_sessions_nested(actions, top, n)
    nobody = F.array().cast(nested.schema["sessions"].dataType)
    return (
        ranked.join(nested, "categoryId", "left")
        .select("category_rank", "categoryId", F.coalesce("sessions", nobody).alias("sessions"))
        .orderBy("category_rank")
    )
