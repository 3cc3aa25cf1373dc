"""Structured Streaming jobs over a stream of parsed ad clicks.

Every job takes a streaming DataFrame with the ad-click columns, a folder that all executors
share, and a trigger such as ``{"processingTime": "5 seconds"}`` or ``{"availableNow": True}``.
Checkpoint and result tables live in the folder, so starting a job again on it continues it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickmetrics.operators import ads as A
from clickmetrics.schemas import ADS_INFO, column_names
from clickmetrics.sources.ads import check_ads, line_counts, observe_lines, split_checked
from clickmetrics.streaming.tables import BatchTable, KeyedTable, PaneStore, values_of

EVERY_5_SECONDS = {"processingTime": "5 seconds"}
EVERY_10_SECONDS = {"processingTime": "10 seconds"}
EVERY_2_SECONDS = {"processingTime": "2 seconds"}


def _start(
    stream: DataFrame,
    folder: str,
    handler: Callable[[DataFrame, int], None],
    trigger: dict,
    mode: str = "update",
) -> StreamingQuery:
    return (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .foreachBatch(handler)
        .trigger(**trigger)
        .start()
    )


# --- clicks per (day, area, ad) and the daily top 3 ------------------------------------------


COUNTS = "dayString string, area string, adsId string, n bigint"


def counts_table(folder: str) -> KeyedTable:
    return KeyedTable(f"{folder}/counts", COUNTS, ["dayString", "area", "adsId"], by="dayString")


def top_table(folder: str) -> KeyedTable:
    return KeyedTable(
        f"{folder}/top",
        "dayString string, area string, top array<struct<adsId: string, n: bigint>>",
        ["dayString", "area"],
        by="dayString",
    )


def _by_day(ads: DataFrame, watermark: str) -> DataFrame:
    """Clicks with the start of their day in the session's time zone, the same day as ``dayString``."""
    return ads.withColumn("day", F.date_trunc("day", "timestamp")).withWatermark("day", watermark)


def _running_counts(ads: DataFrame, watermark: str | None) -> DataFrame:
    """Running totals; each batch emits only the totals it changed.

    Without a watermark totals live as long as the query and late clicks always count. With one,
    the totals of a day are dropped from the state once the day is that far in the past.
    """
    if watermark is None:
        return ads.groupBy("dayString", "area", "adsId").agg(F.count("*").alias("n"))
    return (
        _by_day(ads, watermark)
        .groupBy("day", "dayString", "area", "adsId")
        .agg(F.count("*").alias("n"))
        .drop("day")
    )


def start_daily_area_counts(
    ads: DataFrame, folder: str, trigger: dict = EVERY_5_SECONDS, watermark: str | None = None
) -> StreamingQuery:
    """Keeps ``counts_table(folder)``."""
    counts = counts_table(folder)
    return _start(_running_counts(ads, watermark), folder, counts.write, trigger)


def start_area_top3(
    ads: DataFrame, folder: str, trigger: dict = EVERY_5_SECONDS, watermark: str | None = None, k: int = 3
) -> StreamingQuery:
    """Keeps ``top_table`` of the folder; ``read_top3`` and ``read_top3_hash`` read it.

    Totals only grow, so an ad outside the old top k enters the new one only if this batch changed
    its total. A batch therefore ranks its changed totals together with the old top k of the
    (day, area) groups it touched, and never reads all totals.
    """
    changed_totals = BatchTable(f"{folder}/changed", COUNTS)
    tops = top_table(folder)

    def on_batch(changes: DataFrame, batch_id: int) -> None:
        spark = changes.sparkSession
        changed_totals.write(changes, batch_id)
        changed = changed_totals.batch(spark, batch_id)
        if changed.isEmpty():
            return
        group = ["dayString", "area"]
        touched, of_days = changed.select(*group).distinct(), values_of(changed, "dayString")
        old = tops.read(spark, batch_id - 1, lambda rows: rows.where(of_days).join(touched, group, "left_semi")).select(
            *group, F.inline("top")
        )
        candidates = (
            changed.unionByName(old).groupBy("dayString", "area", "adsId").agg(F.max("n").alias("n"))
        )
        tops.write(A.nest_top(A.rank_ads(candidates, k)), batch_id)

    return _start(_running_counts(ads, watermark), folder, on_batch, trigger)


def read_top3(spark: SparkSession, folder: str) -> DataFrame:
    """The daily top rows, one per ad with its rank."""
    return top_table(folder).read(spark).select(
        "dayString", "area", F.posexplode("top").alias("place", "ad")
    ).select("dayString", "area", "ad.adsId", "ad.n", (F.col("place") + 1).alias("rank"))


def read_top3_hash(spark: SparkSession, folder: str) -> DataFrame:
    """The daily top rows as hash entries."""
    return A.top_hash(top_table(folder).read(spark))


# --- the last hour -----------------------------------------------------------------------------


HOUR = "day bigint, adsId string, minute bigint, newest bigint, n bigint"
HOUR_KEYS = ["day", "adsId", "minute"]
PANES = "adsId string, minute bigint, pane bigint, n bigint"


class HourTables:
    """What the hour's job keeps: the newest pane, counts by pane while they can expire, counts by minute."""

    def __init__(self, folder: str, minutes: int = 60, slide_seconds: int = 5) -> None:
        self.minutes, self.slide_seconds = minutes, slide_seconds
        self.clock = BatchTable(f"{folder}/clock", "newest bigint, start bigint")
        self.panes = PaneStore(f"{folder}/panes", PANES, "pane")
        self.counts = KeyedTable(f"{folder}/minutes", HOUR, HOUR_KEYS, by="day", keep=self._alive_at)

    def start(self, newest: int) -> int:
        """First millisecond of the window whose last slide holds ``newest``; see ``operators.ads.hour_start``."""
        slide = self.slide_seconds * 1000
        return newest - newest % slide + slide - self.minutes * 60_000

    def time(self, spark: SparkSession, upto: int | None = None) -> tuple[int, int] | None:
        """(newest pane, window start) as of a batch; None before the first click."""
        return next(iter(map(tuple, self.clock.read(spark, upto).collect())), None)

    def _alive_at(self, rows: DataFrame, batch_id: int) -> DataFrame:
        """Rows with clicks in the hour as batch ``batch_id`` finds it.

        A minute whose newest pane is gone has no clicks left, and its older versions have older panes.
        """
        time = self.time(rows.sparkSession, batch_id - 1)
        return rows.where(F.col("newest") >= time[1]) if time else rows

    def read(self, spark: SparkSession) -> DataFrame:
        last = self.clock.last_batch(spark)
        return self._alive_at(self.counts.read(spark, last), last + 1).select(
            "adsId",
            F.timestamp_millis("minute").alias("minute"),
            F.date_format(F.timestamp_millis("minute"), "HH:mm").alias("hmString"),
            "n",
        )


def read_last_hour(spark: SparkSession, folder: str) -> DataFrame:
    """Clicks per ad and minute in the hour: (adsId, minute, hmString, n)."""
    return HourTables(folder).read(spark)


def read_last_hour_hash(spark: SparkSession, folder: str) -> DataFrame:
    """The last hour as hash entries; ads without a click in the hour are not in it."""
    return A.minutes_hash(read_last_hour(spark, folder))


def start_last_hour(
    ads: DataFrame,
    folder: str,
    trigger: dict = EVERY_5_SECONDS,
    minutes: int = 60,
    slide_seconds: int = 5,
    time: str = "timestamp",
) -> StreamingQuery:
    """Clicks per ad and minute in the last hour; ``read_last_hour`` reads them.

    ``time`` is the axis on which the hour is measured, up to the newest value seen: ``timestamp``
    takes the clicks' own time, ``arrival`` (see ``sources.ads``) when the lines came in. Minutes
    are always the clicks' own.

    Counts are kept per slide-sized pane. A batch adds the clicks it brings to the minutes they
    belong to, and takes off the panes that fell out of the hour since the batch before; it opens
    the files of those panes, and of the counts those of the days that change, not the hour's panes. Panes older than that
    are removed. The stream is stateless: what a batch reads was written by earlier batch ids, so a
    replayed batch gives the same tables.
    """
    tables = HourTables(folder, minutes, slide_seconds)
    changed = BatchTable(f"{folder}/changed", PANES)
    slide = slide_seconds * 1000

    def on_batch(clicks: DataFrame, batch_id: int) -> None:
        spark = clicks.sparkSession
        at = F.unix_millis(time)
        changed.write(
            clicks.groupBy(
                "adsId",
                F.unix_millis(F.date_trunc("minute", "timestamp")).alias("minute"),
                (at - F.pmod(at, F.lit(slide))).alias("pane"),
            ).agg(F.count("*").alias("n")),
            batch_id,
        )
        panes = changed.batch(spark, batch_id)
        seen = panes.agg(F.max("pane")).first()[0]
        if seen is None:
            return
        before = tables.time(spark, batch_id - 1)
        newest = max(seen, before[0]) if before else seen
        start = tables.start(newest)
        fresh = panes.where(F.col("pane") >= start)
        tables.panes.write(fresh, batch_id)
        day = F.floor(F.col("minute") / 86_400_000).cast("bigint").alias("day")
        moves = fresh.select(day, "adsId", "minute", "n", F.col("pane").alias("newest"))
        if before:
            gone = tables.panes.read(spark, before[1], min(start - 1, before[0]), batch_id)
            gone = gone.select(day, "adsId", "minute", (-F.col("n")).alias("n"), F.lit(None).alias("newest"))
            moves = moves.unionByName(gone)
        moves = moves.groupBy(*HOUR_KEYS).agg(F.sum("n").alias("more"), F.max("newest").alias("latest")).persist()
        try:
            of_days, touched = values_of(moves, "day"), moves.select(*HOUR_KEYS)
            alive = F.col("newest") >= (before[1] if before else start)
            old = tables.counts.read(
                spark,
                batch_id - 1,
                lambda rows: rows.where(of_days & alive).join(touched, HOUR_KEYS, "left_semi"),
            )
            total = (F.col("more") + F.coalesce("n", F.lit(0))).alias("n")
            both = moves.join(old, HOUR_KEYS, "left")
            tables.counts.write(both.select(*HOUR_KEYS, F.greatest("newest", "latest").alias("newest"), total), batch_id)
        finally:
            moves.unpersist()
        tables.clock.write(spark.createDataFrame([(newest, start)], tables.clock.schema), batch_id)
        if before:
            tables.panes.drop_before(spark, before[1])

    return _start(ads, folder, on_batch, trigger, mode="append")


# --- the blacklist -------------------------------------------------------------------------------


def blacklist_table(folder: str) -> KeyedTable:
    return KeyedTable(f"{folder}/blacklist", "dayString string, userId string", A.USER_DAY, by="dayString")


def start_blacklist(
    ads: DataFrame,
    folder: str,
    trigger: dict = EVERY_10_SECONDS,
    min_clicks: int = 1,
    watermark: str | None = None,
) -> StreamingQuery:
    """Keeps ``blacklist_table(folder)``: users with ``min_clicks`` clicks on one ad in a day.

    Counts live in the state store and a batch touches only the counters it changes. Counting on
    after a user is listed cannot change the set, so nothing has to be read back. Inserting a
    listed user again is harmless: the table holds one row per (day, user).
    """
    keys = [*A.USER_DAY, "adsId"]
    if watermark is None:
        grouped = ads.groupBy(*keys)
    else:
        grouped = _by_day(ads, watermark).groupBy("day", *keys)
    listed = grouped.agg(F.count("*").alias("n")).where(F.col("n") >= min_clicks).select(*A.USER_DAY)
    table = blacklist_table(folder)

    def on_batch(users: DataFrame, batch_id: int) -> None:
        table.write(users.distinct(), batch_id)

    return _start(listed, folder, on_batch, trigger)


def user_counts_table(folder: str) -> KeyedTable:
    return KeyedTable(
        f"{folder}/user_counts",
        "dayString string, userId string, adsId string, n bigint",
        [*A.USER_DAY, "adsId"],
        by="dayString",
    )


def start_blacklist_loop(
    ads: DataFrame, folder: str, trigger: dict = EVERY_10_SECONDS, min_clicks: int = 1
) -> StreamingQuery:
    """The blacklist with its feedback: clicks of users listed by earlier batches are dropped.

    The clicks that pass are appended to ``<folder>/passed`` (see ``read_passed``) and only they
    are counted. The stream itself is stateless, so each batch runs with adaptive execution, which
    splits the rows of an over-active user in the anti join. All state lies in tables written per batch id, so a replayed batch sees the same
    blacklist again and does not count twice.
    """
    blacklist, counts = blacklist_table(folder), user_counts_table(folder)
    keys = [*A.USER_DAY, "adsId"]

    def on_batch(clicks: DataFrame, batch_id: int) -> None:
        spark = clicks.sparkSession
        clicks.persist()
        try:
            # Lets the table scans skip the other days.
            of_batch = values_of(clicks, "dayString")
            users = clicks.select(*A.USER_DAY).distinct()
            listed = blacklist.read(
                spark, batch_id - 1, lambda rows: rows.where(of_batch).join(users, A.USER_DAY, "left_semi")
            )
            target = f"{folder}/passed/batch_id={batch_id}"
            A.drop_blacklisted(clicks, listed).write.mode("overwrite").parquet(target)
        finally:
            clicks.unpersist()
        passed = spark.read.schema(ADS_INFO).parquet(target)
        delta = passed.groupBy(*keys).agg(F.count("*").alias("more"))
        touched = passed.select(*keys).distinct()
        before = counts.read(
            spark, batch_id - 1, lambda rows: rows.where(of_batch).join(touched, keys, "left_semi")
        )
        total = F.col("more") + F.coalesce("n", F.lit(0))
        counts.write(delta.join(before, keys, "left").select(*keys, total.alias("n")), batch_id)
        reached = counts.batch(spark, batch_id).where(F.col("n") >= min_clicks)
        blacklist.write(reached.select(*A.USER_DAY).distinct(), batch_id)

    return _start(ads, folder, on_batch, trigger, mode="append")


def read_passed(spark: SparkSession, folder: str) -> DataFrame:
    """The clicks that passed, of the batches that finished."""
    rows = spark.read.schema(f"{ADS_INFO}, batch_id bigint").parquet(f"{folder}/passed")
    done = blacklist_table(folder).last_batch(spark)
    return rows.where(F.col("batch_id") <= done).select(*column_names(ADS_INFO))


# --- raw rows --------------------------------------------------------------------------------------


def start_raw_append(ads: DataFrame, folder: str, trigger: dict = EVERY_2_SECONDS) -> StreamingQuery:
    """Appends the parsed clicks to ``<folder>/raw``, each exactly once."""
    return (
        ads.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .option("path", f"{folder}/raw")
        .trigger(**trigger)
        .start()
    )


def read_raw(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(ADS_INFO).parquet(f"{folder}/raw")


CHECKED = f"value string, {ADS_INFO}, reason string"
LINE_COUNTS = "batch bigint, what string, n bigint"


def line_counts_table(folder: str) -> KeyedTable:
    return KeyedTable(f"{folder}/line_counts", LINE_COUNTS, ["batch", "what"], by="what")


def start_checked_append(lines: DataFrame, folder: str, trigger: dict = EVERY_2_SECONDS) -> StreamingQuery:
    """Appends raw lines as clicks, and those that cannot be read as (value, reason), each exactly once.

    Both come from one pass over a batch, and the counts of good and bad lines come with it.
    ``read_checked`` and ``read_line_counts`` read what finished batches wrote.
    """
    counts = line_counts_table(folder)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        observation = Observation()
        checked = observe_lines(check_ads(batch), observation)
        checked.withColumn("bad", F.col("reason").isNotNull()).write.mode("overwrite").partitionBy("bad").parquet(
            f"{folder}/lines/batch_id={batch_id}"
        )
        rows = [(batch_id, what, n) for what, n in line_counts(observation)]
        counts.write(batch.sparkSession.createDataFrame(rows, LINE_COUNTS), batch_id)

    return _start(lines, folder, on_batch, trigger, mode="append")


def read_checked(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The clicks of good lines, and (value, reason) of the others."""
    rows = spark.read.schema(f"{CHECKED}, batch_id bigint, bad boolean").parquet(f"{folder}/lines")
    rows = rows.where(F.col("batch_id") <= line_counts_table(folder).last_batch(spark))
    return split_checked(rows.where("NOT bad"))[0], split_checked(rows.where("bad"))[1]


def read_line_counts(spark: SparkSession, folder: str) -> DataFrame:
    """(what, n): good lines and those of each reason."""
    return line_counts_table(folder).read(spark).groupBy("what").agg(F.sum("n").alias("n"))


def start_console(ads: DataFrame, trigger: dict = EVERY_2_SECONDS) -> StreamingQuery:
    return (
        ads.writeStream.format("console")
        .option("truncate", "false")
        .outputMode("append")
        .trigger(**trigger)
        .start()
    )
