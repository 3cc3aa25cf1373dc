"""Page-to-page conversion inside sessions."""

from __future__ import annotations

from itertools import zip_longest

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmetrics.functions import rate_percent

# Lengths of the action_time prefixes that cut a session into slices, fine to coarse. Texts like
# "yyyy-MM-dd HH:mm:ss" give minutes, then ten days; epoch seconds and milliseconds give ten seconds.
PREFIXES = (16, 9)


def _page_id(entry: str) -> int | None:
    """The page id an entry of a flow names, or None where no page id is written like that."""
    if not entry.removeprefix("-").isdecimal():
        return None
    page = int(entry)
    return page if str(page) == entry and -(2**63) <= page < 2**63 else None


def _flow_pages(flow: str) -> list[int | None]:
    return [_page_id(entry) for entry in flow.split(",")]


def page_visits(actions: DataFrame, flow: str) -> DataFrame:
    pages = {p for p in _flow_pages(flow) if p is not None}
    return (
        actions.where(F.col("page_id").isin(*pages)).groupBy("page_id").agg(F.count("*").alias("visits"))
    )


def _flow_steps(flow: str) -> list[tuple[int, int]]:
    pages = _flow_pages(flow)
    return sorted({(a, b) for a, b in zip(pages, pages[1:]) if a is not None and b is not None})


def _summaries(actions: DataFrame, steps: list[tuple[int, int]], prefixes: tuple[int, ...]) -> DataFrame:
    """One row with how often each step was made (s0, s1, ...) and each source page was seen (v0, v1, ...).

    Rows are placed once, by session and the finest slice of it (or lie so already, in a table clustered
    by session), a slice being a prefix of the action_time text; a prefix never reorders texts. Steps inside a slice are counted there, and the
    slice goes on as a summary: its first and last row and its counts. Summaries merge in time order
    into those of the next, shorter prefix and at last of the session, a merge adding the step from
    the last row of one to the first of the next. So all rows are shuffled once, and no task gets
    more of a long session than one slice of it.
    """
    sources = sorted({a for a, _ in steps})
    names = [*(f"s{k}" for k in range(len(steps))), *(f"v{k}" for k in range(len(sources)))]

    def made(page: Column, following: Column) -> list[Column]:
        return [F.count_if((page == a) & (following == b)) for a, b in steps]

    row = F.struct("action_time", "page_id")
    rows = actions.select("session_id", row.alias("first"), row.alias("last"))
    for level, length in enumerate([*prefixes, None]):
        if length is None:
            key, placed = ["session_id"], rows
        else:
            key = ["session_id", "slice"]
            placed = rows.withColumn("slice", F.substring("first.action_time", 1, length))
        in_slice = Window.partitionBy(*key).orderBy("first")
        linked = placed.withColumn("following", F.lead("first.page_id").over(in_slice))
        counts = made(F.col("last.page_id"), F.col("following"))
        if level:
            counts = [F.sum(n) + c if n.startswith("s") else F.sum(n) for n, c in zip_longest(names, counts)]
        else:
            counts += [F.count_if(F.col("first.page_id") == page) for page in sources]
        counts = [c.alias(n) for n, c in zip(names, counts)]
        ends = [] if length is None else [F.min("first").alias("first"), F.max("last").alias("last")]
        rows = (linked.groupBy(*key) if ends else linked.groupBy()).agg(*ends, *counts)
    return rows


def page_steps(actions: DataFrame, flow: str, prefixes: tuple[int, ...] = PREFIXES) -> DataFrame:
    """(page_id, next_page, n) for the flow's source pages.

    ``next_page`` is the page that follows in the session, ordered by action_time and then
    page_id, or NULL where that step is not part of the flow. Summed over ``next_page``, n is the
    number of visits of the page, so one tally yields both sides of the rate.
    """
    steps = _flow_steps(flow)
    if not steps:
        return actions.sparkSession.createDataFrame([], "page_id bigint, next_page bigint, n bigint")
    tally = [f"struct({a}L AS page_id, {b}L AS next_page, s{k} AS n)" for k, (a, b) in enumerate(steps)]
    for k, page in enumerate(sorted({a for a, _ in steps})):
        on = " - ".join([f"v{k}", *(f"s{i}" for i, (a, _) in enumerate(steps) if a == page)])
        tally.append(f"struct({page}L AS page_id, CAST(NULL AS bigint) AS next_page, {on} AS n)")
    return _summaries(actions, steps, prefixes).selectExpr(f"inline(array({', '.join(tally)}))").where("n > 0")


def _jump() -> Column:
    return F.concat_ws("->", F.col("page_id").cast("string"), F.col("next_page").cast("string"))


def page_transitions(actions: DataFrame, flow: str, prefixes: tuple[int, ...] = PREFIXES) -> DataFrame:
    """Steps of the flow that occur at least once."""
    return (
        page_steps(actions, flow, prefixes)
        .where(F.col("next_page").isNotNull() & (F.col("n") > 0))
        .select(_jump().alias("jump"), "n")
    )


def page_conversion(actions: DataFrame, flow: str, prefixes: tuple[int, ...] = PREFIXES) -> DataFrame:
    """Share of a source page's visits that go on to the next page of the flow."""
    of_page = Window.partitionBy("page_id")
    rate = F.col("n").cast("double") / F.col("visits")
    return (
        page_steps(actions, flow, prefixes)
        .withColumn("visits", F.sum("n").over(of_page))
        .where(F.col("next_page").isNotNull() & (F.col("n") > 0))
        .select(_jump().alias("jump"), "n", "visits", rate.alias("rate"), rate_percent(rate).alias("rate_text"))
    )
