"""Reading the user-action table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmetrics.schemas import NO_IDS, USER_VISIT_ACTION, column_names

SEPARATOR = "_"


def parse_actions(lines: DataFrame, mode: str = "strict") -> DataFrame:
    """Turn ``value`` lines with ``_`` between the fields into the 13 typed columns.

    ``strict`` fails the job on a short line or a bad number, whichever columns are read later and
    with ANSI mode on or off; ``permissive`` drops such lines.
    """
    if mode not in ("strict", "permissive"):
        raise ValueError(f"unknown mode: {mode}")
    columns = [c.split() for c in USER_VISIT_ACTION.split(", ")]
    typed = split_once(lines, F.split("value", SEPARATOR)).selectExpr(
        "value", *[f"try_cast(get(p, {i}) AS {kind}) AS {name}" for i, (name, kind) in enumerate(columns)]
    )
    names = [name for name, _ in columns]
    return (fail_on_missing(typed, names) if mode == "strict" else typed.dropna(subset=names)).select(*names)


def split_once(lines: DataFrame, parts: Column) -> DataFrame:
    """``lines`` with a column ``p`` of parts. Passing through a list of one row keeps filters above from
    repeating the split for every field they look at."""
    return lines.select("*", F.inline(F.array(F.struct(parts.alias("p")))))


def fail_on_missing(parsed: DataFrame, names: list[str]) -> DataFrame:
    """Fails the job on a row that lacks one of the columns. A filter, so no plan leaves it out."""
    missing = " OR ".join(f"{name} IS NULL" for name in names)
    return parsed.where(f"CASE WHEN {missing} THEN raise_error(concat('bad line: ', value)) ELSE true END")


def read_actions_text(spark: SparkSession, path: str, mode: str = "strict") -> DataFrame:
    return parse_actions(spark.read.text(path), mode)


def action_lines(actions: DataFrame) -> DataFrame:
    """The inverse of :func:`parse_actions`; NULL is written as text, a separator inside a field fails."""
    fields = [f"coalesce(CAST({name} AS string), '{NO_IDS}')" for name in column_names(USER_VISIT_ACTION)]
    safe = [
        f"CASE WHEN contains({f}, '{SEPARATOR}') THEN raise_error(concat('separator in field: ', {f})) ELSE {f} END"
        for f in fields
    ]
    return actions.selectExpr(f"concat_ws('{SEPARATOR}', {', '.join(safe)}) AS value")


def write_actions_text(actions: DataFrame, path: str) -> None:
    action_lines(actions).write.text(path)


def catalog_tables(spark: SparkSession, database: str | None = None) -> dict[str, DataFrame]:
    """The three report tables from the session catalog, after an optional ``USE database``."""
    if database:
        spark.catalog.setCurrentDatabase(database)
    return {t: spark.table(t) for t in ("user_visit_action", "product_info", "city_info")}


def save_clustered_actions(actions: DataFrame, name: str, buckets: int, path: str | None = None) -> None:
    """Saves a catalog table with a folder for each date, inside it files clustered and sorted by session.

    Reading it for some dates scans only these; grouping or ordering by session needs no shuffle. A
    session then lies in one file of a date, so this suits sessions of moderate length.
    """
    clustered = actions.repartition(buckets, "session_id")  # a task writes one bucket of each date
    writer = clustered.write.format("parquet").mode("overwrite").partitionBy("date")
    writer = writer.bucketBy(buckets, "session_id").sortBy("session_id", "action_time")
    (writer.option("path", path) if path else writer).saveAsTable(name)
