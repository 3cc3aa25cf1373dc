"""Command line: ``python -m clickmetrics <job> ...`` or through ``spark-submit``."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from clickmetrics.operators import category, pages, sessions
from clickmetrics.plans.area_sql import area_top3_sql
from clickmetrics.session import build_session
from clickmetrics.sources.actions import catalog_tables, read_actions_text
from clickmetrics.sources.ads import parse_ads, stream_ads_files, stream_ads_kafka
from clickmetrics.streaming import jobs

TOPS = {
    "strict": category.top_strict,
    "single-pass": category.top_single_pass,
    "lenient": category.top_lenient,
}
STREAMS = {
    "ads-daily-counts": jobs.start_daily_area_counts,
    "ads-top3": jobs.start_area_top3,
    "ads-last-hour": jobs.start_last_hour,
    "ads-blacklist": jobs.start_blacklist,
    "ads-blacklist-loop": jobs.start_blacklist_loop,
    "ads-raw": jobs.start_raw_append,
}
# Which of a job's arguments can be set; None leaves the job's own default.
STREAM_OPTIONS = {
    "ads-daily-counts": {"watermark": str},
    "ads-top3": {"watermark": str, "k": int},
    "ads-last-hour": {"minutes": int, "slide_seconds": int, "time": str},
    "ads-blacklist": {"watermark": str, "min_clicks": int},
    "ads-blacklist-loop": {"min_clicks": int},
    "ads-raw": {},
}
OPTION_HELP = {
    "watermark": "how late clicks may come, as '2 days'; bounds the state",
    "k": "ads kept per day and area",
    "minutes": "length of the window",
    "slide_seconds": "step of the window",
    "time": "timestamp: the clicks' own time; arrival: when their lines came in",
    "min_clicks": "clicks on one ad in a day that put a user on the list",
}


def _actions(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    return spark.read.parquet(args.input) if args.parquet else read_actions_text(spark, args.input, args.mode)


def _batch(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.job == "area-top3":
        catalog_tables(spark, args.database)
        return area_top3_sql(spark)
    actions = _actions(spark, args)
    if args.job == "category-top10":
        return TOPS[args.variant](actions, args.n)
    if args.job == "session-top10":
        return sessions.top_sessions(actions, TOPS[args.variant](actions, args.categories), args.n)
    return pages.page_conversion(actions, args.flow)


def _clicks(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    arrival = getattr(args, "time", None) == "arrival"
    if args.kafka:
        limit = {"maxOffsetsPerTrigger": str(args.per_batch)} if args.per_batch else {}
        lines = stream_ads_kafka(spark, args.kafka, args.topic, args.starting_offsets, arrival, **limit)
    else:
        lines = stream_ads_files(spark, args.files, args.per_batch, arrival)
    return parse_ads(lines, args.mode)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="clickmetrics")
    parser.add_argument("--mode", choices=["strict", "permissive"], default="strict", help="for broken lines")
    parser.add_argument("--output", help="write the result as parquet instead of printing it")
    jobs_ = parser.add_subparsers(dest="job", required=True)

    for name in ("category-top10", "session-top10", "page-conversion"):
        job = jobs_.add_parser(name)
        job.add_argument("--input", required=True, help="folder of action lines")
        job.add_argument("--parquet", action="store_true", help="the input is parquet with the same columns")
        if name == "page-conversion":
            job.add_argument("--flow", default="1,2,3,4,5,6")
        else:
            job.add_argument("--variant", choices=TOPS, default="strict")
            job.add_argument("--n", type=int, default=10, help="rows, or sessions of each category")
        if name == "session-top10":
            job.add_argument("--categories", type=int, default=10, help="top categories whose sessions are ranked")
    report = jobs_.add_parser("area-top3")
    report.add_argument("--database", help="catalog database of the three tables")
    report.add_argument("--hive", action="store_true", help="use the configured Hive metastore")

    for name in [*STREAMS, "ads-console"]:
        job = jobs_.add_parser(name)
        source = job.add_mutually_exclusive_group(required=True)
        source.add_argument("--files", help="folder in which files of click lines arrive")
        source.add_argument("--kafka", help="bootstrap servers")
        job.add_argument("--topic", default="ads_log")
        job.add_argument("--starting-offsets", default="latest")
        job.add_argument("--per-batch", type=int, help="most files or Kafka records per batch")
        pace = job.add_mutually_exclusive_group()
        pace.add_argument("--trigger", help="time between batches, as '5 seconds'")
        pace.add_argument("--once", action="store_true", help="work through what is there, then stop")
        if name in STREAMS:
            job.add_argument("--folder", required=True, help="shared folder for checkpoint and result tables")
        for option, kind in STREAM_OPTIONS.get(name, {}).items():
            choices = ["timestamp", "arrival"] if option == "time" else None
            job.add_argument("--" + option.replace("_", "-"), type=kind, choices=choices, help=OPTION_HELP[option])
    return parser


SHOWN = 100


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = build_session(f"clickmetrics-{args.job}", hive=getattr(args, "hive", False))
    if args.job in STREAMS or args.job == "ads-console":
        options = {k: v for k in STREAM_OPTIONS.get(args.job, {}) if (v := getattr(args, k)) is not None}
        if args.once:
            options["trigger"] = {"availableNow": True}
        elif args.trigger:
            options["trigger"] = {"processingTime": args.trigger}
        clicks = _clicks(spark, args)
        query = (
            STREAMS[args.job](clicks, args.folder, **options) if args.job in STREAMS else jobs.start_console(clicks, **options)
        )
        query.awaitTermination()
        return
    result = _batch(spark, args)
    if args.output:
        result.write.parquet(args.output)
    else:
        result = result.persist()
        rows = result.count()
        result.show(SHOWN, truncate=False)
        if rows > SHOWN:
            print(f"{rows - SHOWN} more rows; --output writes them all")


if __name__ == "__main__":
    main()
