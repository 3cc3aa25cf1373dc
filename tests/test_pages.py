import random
from collections import Counter

import pytest

from clickmetrics.operators import pages
from tests.rows import actions, found

COLUMNS = ["session_id", "action_time", "page_id"]


def visits(spark, *rows):
    return actions(spark, *[dict(zip(COLUMNS, r)) for r in rows])


def brute(rows, flow):
    """Transitions and visits by plain Python over sorted sessions."""
    flow = [int(p) for p in flow.split(",")]
    wanted = set(zip(flow, flow[1:]))
    jumps = Counter()
    for sid in {r[0] for r in rows}:
        path = [r[2] for r in sorted((r for r in rows if r[0] == sid), key=lambda r: (r[1] or "", r[2]))]
        jumps.update(step for step in zip(path, path[1:]) if step in wanted)
    seen = Counter(r[2] for r in rows)
    return sorted((f"{a}->{b}", n, seen[a], n / seen[a]) for (a, b), n in jumps.items())


def test_gap_page_breaks_the_step(spark):
    df = visits(spark, ("s", "t1", 1), ("s", "t2", 9), ("s", "t3", 2))
    assert found(pages.page_transitions(df, "1,2")) == []
    assert found(pages.page_conversion(df, "1,2")) == []
    assert found(pages.page_visits(df, "1,2")) == [(1, 1), (2, 1)]


def test_rate_texts(spark):
    steps = [("s", "t0", 1), ("s", "t1", 2)] + [(f"x{i}", "t", 1) for i in range(199)]
    assert found(pages.page_conversion(visits(spark, *steps), "1,2")) == [("1->2", 1, 200, 0.005, ".50%")]
    assert found(pages.page_conversion(visits(spark, *steps[:2]), "1,2")) == [("1->2", 1, 1, 1.0, "100.00%")]


def test_flow_entries_that_are_no_page_ids(spark):
    df = visits(spark, ("s", "t1", 1), ("s", "t2", 2))
    assert found(pages.page_transitions(df, "01,2")) == []
    assert found(pages.page_visits(df, "01,x,2")) == [(2, 1)]
    for flow in ("1", "", "x,y", "²,1", "1, 2", "1,99999999999999999999"):
        assert found(pages.page_transitions(df, flow)) == []
    assert found(pages.page_visits(df, "x")) == []


def test_repeated_step_in_the_flow_counts_once(spark):
    df = visits(spark, ("s", "t1", 1), ("s", "t2", 2), ("s", "t3", 1))
    assert found(pages.page_transitions(df, "1,2,1,2")) == [("1->2", 1), ("2->1", 1)]


DAY = 86_400
FORMATS = {
    "text": lambda t: f"2024-01-{1 + t // DAY:02} {t % DAY // 3600:02}:{t % 3600 // 60:02}:{t % 60:02}",
    "date": lambda t: f"2024-01-{1 + t // DAY:02}",
    "seconds": lambda t: str(1_704_067_200 + t),
    "milliseconds": lambda t: str((1_704_067_200 + t) * 1000 + t % 7),
    "null": lambda t: None,
    "empty": lambda t: "",
}


@pytest.mark.parametrize("form", FORMATS)
@pytest.mark.parametrize("prefixes", [pages.PREFIXES, (19, 13, 1), ()])
def test_one_long_session_and_short_ones_equal_brute_force(spark, form, prefixes):
    rng = random.Random(7)
    rows = []
    for _ in range(600):
        sid = rng.choice(["long"] * 5 + ["a", "b", "c", ""])
        rows.append((sid, FORMATS[form](rng.choice([0, 9, 10, 59, 60, 4000, DAY, 11 * DAY + 5])), rng.randint(1, 4)))
    rows += [("copies", FORMATS[form](0), 2)] * 50 + [("copies", FORMATS[form](1), 3)] * 50
    df = visits(spark, *rows)
    for flow in ("1,2,3,4", "2,2,3,3,1"):
        got = [r[:4] for r in found(pages.page_conversion(df, flow, prefixes))]
        assert got == brute(rows, flow)


def test_no_task_sorts_a_long_session_whole(spark):
    """200 000 rows of one session, in seconds and in text: windows over the session see only slice ends."""
    for time in ("CAST(1704067200 + id AS string)", "CAST(timestamp_seconds(1704067200 + id) AS string)"):
        rows = spark.range(200_000).selectExpr("'s' AS session_id", f"{time} AS action_time", "id % 5 AS page_id")
        left = pages.page_steps(rows, "1,2")
        assert sum(r["n"] for r in left.collect()) == 40_000
        plan = left._jdf.queryExecution().executedPlan()
        sizes = _window_rows(plan)
        assert len(sizes) >= 3 and min(sizes) <= 40_002


def _window_rows(plan):
    """Rows that reached the sort of every window, read from the plan that ran."""
    text, found_rows = plan.toString(), []
    node = plan.finalPhysicalPlan() if "AdaptiveSparkPlan" in text else plan
    stack = [node]
    while stack:
        node = stack.pop()
        children = node.children()
        stack += [children.apply(i) for i in range(children.size())]
        if node.nodeName().startswith(("ShuffleQueryStage", "AQEShuffleRead")) and node.nodeName().startswith("Shuffle"):
            stack.append(node.plan())
        if node.nodeName() == "Exchange":
            found_rows.append(node.metrics().apply("shuffleRecordsWritten").value())
    return found_rows


def test_null_session_is_one_session(spark):
    df = visits(spark, (None, "t1", 1), (None, "t2", 2), (None, "t3", 1))
    assert found(pages.page_transitions(df, "1,2,1")) == [("1->2", 1), ("2->1", 1)]
