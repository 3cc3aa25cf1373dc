"""Ad-click metrics on a bounded table of ad clicks (see ``sources.ads.parse_ads``)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmetrics.functions import pairs_json

# Names of the result hashes.
TOP3_PREFIX = "area:ads:top3:"
LAST_HOUR = "last_hour_click"

USER_DAY = ["dayString", "userId"]


def daily_area_counts(ads: DataFrame) -> DataFrame:
    return ads.groupBy("dayString", "area", "adsId").agg(F.count("*").alias("n"))


def rank_ads(counts: DataFrame, k: int = 3) -> DataFrame:
    """The k ads with most clicks per (day, area); ties are cut by ad id."""
    best_first = Window.partitionBy("dayString", "area").orderBy(F.desc("n"), "adsId")
    return counts.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k)


def area_top3(ads: DataFrame, k: int = 3) -> DataFrame:
    return rank_ads(daily_area_counts(ads), k)


def nest_top(ranked: DataFrame) -> DataFrame:
    """One row per (day, area) with its ranked ads as a list."""
    ordered = F.array_sort(F.collect_list(F.struct("rank", "adsId", "n")))
    return ranked.groupBy("dayString", "area").agg(
        F.transform(ordered, lambda a: F.struct(a["adsId"], a["n"])).alias("top")
    )


def top_hash(nested: DataFrame) -> DataFrame:
    """Key-value rows: one hash per day, one field per area."""
    return nested.select(
        F.concat(F.lit(TOP3_PREFIX), "dayString").alias("key"),
        F.col("area").alias("field"),
        pairs_json(F.col("top"), "adsId", "n").alias("value"),
    )


def area_top3_json(ads: DataFrame, k: int = 3) -> DataFrame:
    return top_hash(nest_top(area_top3(ads, k)))


def hour_start(newest: Column, minutes: int = 60, slide_seconds: int = 5) -> Column:
    """First millisecond of the sliding window that ends right after the newest click.

    Windows end on multiples of the slide, so this one covers the last ``minutes`` up to the end
    of the slide that holds ``newest`` (epoch milliseconds).
    """
    slide = slide_seconds * 1000
    return newest - newest % slide + (slide - minutes * 60_000)


def last_hour(ads: DataFrame, minutes: int = 60, slide_seconds: int = 5) -> DataFrame:
    newest = ads.agg(F.max("ts").alias("newest")).select(hour_start(F.col("newest"), minutes, slide_seconds))
    return ads.where(F.col("ts") >= newest.scalar())


def last_hour_clicks(ads: DataFrame, minutes: int = 60, slide_seconds: int = 5) -> DataFrame:
    """Clicks per ad and minute in the last hour before the newest click."""
    return minute_counts(last_hour(ads, minutes, slide_seconds)).select("adsId", "hmString", "n")


def minute_counts(ads: DataFrame) -> DataFrame:
    return ads.groupBy(
        "adsId", F.date_trunc("minute", "timestamp").alias("minute"), "hmString"
    ).agg(F.count("*").alias("n"))


def minutes_hash(minutes: DataFrame) -> DataFrame:
    """Key-value rows: one field per ad, its minutes in time order."""
    ordered = F.array_sort(F.collect_list(F.struct("minute", "hmString", "n")))
    return minutes.groupBy("adsId").agg(ordered.alias("list")).select(
        F.lit(LAST_HOUR).alias("key"),
        F.col("adsId").alias("field"),
        pairs_json(F.col("list"), "hmString", "n").alias("value"),
    )


def last_hour_json(ads: DataFrame, minutes: int = 60, slide_seconds: int = 5) -> DataFrame:
    return minutes_hash(minute_counts(last_hour(ads, minutes, slide_seconds)))


def build_blacklist(ads: DataFrame, min_clicks: int = 1) -> DataFrame:
    """Users with at least ``min_clicks`` clicks on one ad in one day."""
    per_ad = ads.groupBy(*USER_DAY, "adsId").agg(F.count("*").alias("n"))
    return per_ad.where(F.col("n") >= min_clicks).select(*USER_DAY).distinct()


# Rows of a user filter: so many words of 64 bits at most, whatever the list's length.
FILTER_WORDS = 1 << 18


def user_filter(blacklist: DataFrame) -> DataFrame:
    """(word, mask): a Bloom filter of the listed (day, user) pairs, at most FILTER_WORDS rows.

    A pair has three bits in one word, so a lookup is one join with a table of known size.
    """
    return blacklist.select(*_bits()).groupBy("word").agg(F.bit_or("own").alias("mask"))


def _bits() -> list[Column]:
    """The word and the bits of a row's (day, user)."""
    code = F.xxhash64(*USER_DAY)
    bits = [F.expr(f"shiftleft(1L, CAST(shiftrightunsigned(xxhash64(dayString, userId), {k}) & 63 AS int))") for k in (16, 24, 32)]
    return [F.pmod(code, F.lit(FILTER_WORDS)).alias("word"), reduce(Column.bitwiseOR, bits).alias("own")]


def drop_blacklisted(ads: DataFrame, blacklist: DataFrame) -> DataFrame:
    """Clicks of users not listed for the day of the click.

    A Bloom filter of the list, whose size is bounded, is broadcast first. Clicks that it rejects are
    surely not listed and stay where they are; only the others, listed ones and a few false hits, go
    into the anti join. That one is unhinted: a list under the broadcast threshold is broadcast, a
    larger one is shuffle-joined, with adaptive execution splitting the rows of an over-active user.
    A click without day or user is never listed.
    """
    columns = ads.columns
    bits = F.broadcast(user_filter(blacklist).withColumnRenamed("word", "_word"))
    word, own = _bits()
    looked = ads.withColumns({"_at": word, "_own": own}).join(bits, F.col("_at") == F.col("_word"), "left")
    maybe = F.coalesce(F.col("mask").bitwiseAND(F.col("_own")) == F.col("_own"), F.lit(False))
    clean = looked.where(~maybe).select(*columns)
    return clean.unionByName(looked.where(maybe).select(*columns).join(blacklist, USER_DAY, "left_anti"))
