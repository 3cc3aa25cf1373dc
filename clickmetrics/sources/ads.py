"""Ad-click lines: reading them as a table or as a stream, and parsing them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from clickmetrics.schemas import ADS_INFO, column_names
from clickmetrics.sources.actions import fail_on_missing, split_once


FIELDS = ["ts", "area", "city", "userId", "adsId"]
MISSING_FIELD, BAD_TIME = "missing field", "bad time"
REASONS = (MISSING_FIELD, BAD_TIME)


def _fields(lines: DataFrame) -> DataFrame:
    """``value`` (and ``arrival``, if there) with the line's fields; ``time`` is the text of the time field."""
    arrival = [c for c in lines.columns if c == "arrival"]
    # An empty last field counts as missing, so commas at the end are cut first.
    parts = split_once(lines.select("value", *arrival), F.split(F.rtrim("value", F.lit(",")), ","))
    return parts.selectExpr(
        "value",
        *arrival,
        "get(p, 0) AS time",
        "try_cast(get(p, 0) AS bigint) AS ts",
        *[f"get(p, {i}) AS {c}" for i, c in enumerate(FIELDS) if i],
    )


# The ad-click columns, from those of ``_fields``.
_CLICK = [
    "ts",
    "timestamp_millis(ts) AS timestamp",
    "date_format(timestamp_millis(ts), 'yyyy-MM-dd') AS dayString",
    "date_format(timestamp_millis(ts), 'HH:mm') AS hmString",
    *FIELDS[1:],
]


def parse_ads(lines: DataFrame, mode: str = "strict") -> DataFrame:
    """``ts_ms,area,city,user,ad`` lines -> the 8 ad-click columns; batch and stream alike.

    ``strict`` fails on a short line or a bad time, whichever columns are read later; ``permissive``
    drops it (``check_ads`` keeps it with the reason). A column ``arrival`` of the lines is taken along.
    """
    if mode not in ("strict", "permissive"):
        raise ValueError(f"unknown mode: {mode}")
    raw = _fields(lines)
    raw = fail_on_missing(raw, FIELDS) if mode == "strict" else raw.dropna(subset=FIELDS)
    return raw.selectExpr(*_CLICK, *[c for c in lines.columns if c == "arrival"])


def check_ads(lines: DataFrame) -> DataFrame:
    """Every line, as ``value``, with the ad-click columns and ``reason``, which is NULL for a good line.

    A line that lacks a field is told so whatever its time looks like. Columns that could not be read are NULL.
    """
    short = " OR ".join(f"{name} IS NULL" for name in FIELDS[1:])
    reason = f"CASE WHEN time IS NULL OR {short} THEN '{MISSING_FIELD}' WHEN ts IS NULL THEN '{BAD_TIME}' END AS reason"
    return _fields(lines).selectExpr("value", *_CLICK, reason)


def observe_lines(checked: DataFrame, observation: Observation) -> DataFrame:
    """Counts good lines and those of each reason while the lines pass; ``line_counts`` reads them afterwards."""
    of_reason = [F.count_if(F.col("reason") == r).alias(r) for r in REASONS]
    return checked.observe(observation, F.count_if(F.col("reason").isNull()).alias("good"), *of_reason)


def line_counts(observation: Observation) -> list[tuple[str, int]]:
    """(what, n) after the pass: ``good`` and each reason."""
    seen = observation.get
    return [(what, seen[what]) for what in ("good", *REASONS)]


def split_checked(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The clicks of good lines, and (value, reason) of the others."""
    good = checked.where("reason IS NULL").select(*column_names(ADS_INFO))
    return good, checked.where("reason IS NOT NULL").select("value", "reason")


def read_ads_text(spark: SparkSession, path: str, mode: str = "strict") -> DataFrame:
    return parse_ads(spark.read.text(path), mode)


def stream_ads_files(
    spark: SparkSession, path: str, files_per_batch: int | None = None, arrival: bool = False
) -> DataFrame:
    """Lines of text files that arrive in a folder; with ``arrival``, when their file was written."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    lines = reader.load(path)
    return lines.select("value", F.col("_metadata.file_modification_time").alias("arrival")) if arrival else lines


def stream_ads_kafka(
    spark: SparkSession,
    servers: str,
    topic: str = "ads_log",
    starting_offsets: str = "latest",
    arrival: bool = False,
    **options: str,
) -> DataFrame:
    """Lines of a Kafka topic (needs the spark-sql-kafka package on the class path); with ``arrival``, their timestamp.

    Offsets are kept in the query's checkpoint. Further source options, such as
    ``maxOffsetsPerTrigger`` or ``kafka.group.id``, go through ``options``.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
    )
    for key, value in options.items():
        reader = reader.option(key, value)
    lines = reader.load().select(F.col("value").cast("string").alias("value"), F.col("timestamp").alias("arrival"))
    return lines if arrival else lines.select("value")
