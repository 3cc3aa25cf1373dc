from clickmetrics.operators import category, sessions
from tests.rows import actions, found

TOP = "categoryId string, clickCount bigint, orderCount bigint, payCount bigint"


def clicks(spark, **per_session):
    rows = []
    for sid, n in per_session.items():
        rows += [{"click_category_id": 1, "session_id": sid}] * n
    return actions(spark, *rows, {"click_category_id": 2, "session_id": "x"}, {"session_id": "x"})


def test_ties_at_the_last_place(spark):
    df = clicks(spark, c=3, b=1, a=1)
    top = spark.createDataFrame([("1", 5, 1, 1)], TOP)
    assert found(sessions.top_sessions(df, top, 2)) == [("1", "a", 1), ("1", "c", 3)]


def test_ranked_keeps_a_top_category_without_clicks(spark):
    df = clicks(spark, a=1, b=2)
    top = spark.createDataFrame([("9", 0, 4, 0), ("1", 3, 0, 0)], TOP)
    got = [(r.category_rank, r.categoryId, [tuple(s) for s in r.sessions])
           for r in sessions.top_sessions_ranked(df, top).collect()]
    assert got == [(1, "1", [("b", 2), ("a", 1)]), (2, "9", [])]


def test_nested_explodes_to_flat(spark):
    df = clicks(spark, **{f"s{i:02}": i % 5 + 1 for i in range(30)})
    top = category.top_lenient(df)
    nested = sessions.top_sessions_nested(df, top).selectExpr("categoryId", "inline(sessions)")
    assert found(nested) == found(sessions.top_sessions(df, top))
    order = sessions.top_sessions_nested(df, top).where("categoryId = '1'").first().sessions
    assert [s.clickCount for s in order] == sorted((s.clickCount for s in order), reverse=True)


def test_plan_limits_ranks_before_the_shuffle(spark):
    df = clicks(spark, a=1)
    plan = sessions.top_sessions(df, category.top_lenient(df))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert plan.count("WindowGroupLimit") == 2
