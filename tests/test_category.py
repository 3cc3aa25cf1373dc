from clickmetrics.operators import category as C
from tests.rows import actions, found


def click(cat, **more):
    return {"click_category_id": cat, **more}


def test_row_with_several_actions(spark):
    df = actions(
        spark,
        click(5, order_category_ids="5,6"),
        {"order_category_ids": "5", "pay_category_ids": "5"},
        {"pay_category_ids": "5,6"},
        click(6),
        {"order_category_ids": "6"},
    )
    assert found(C.top_strict(df)) == [("5", 1, 2, 2), ("6", 1, 2, 1)]
    assert found(C.top_single_pass(df)) == [("5", 1, 1, 1), ("6", 1, 1, 1)]
    assert found(C.action_counts(df)) == [
        ("5", "click", 1), ("5", "order", 1), ("5", "pay", 1),
        ("6", "click", 1), ("6", "order", 1), ("6", "pay", 1),
    ]


def test_missing_action(spark):
    df = actions(spark, click(1), {"order_category_ids": "1"})
    assert found(C.top_strict(df)) == []
    assert found(C.top_single_pass(df)) == []
    assert found(C.top_lenient(df)) == [("1", 1, 1, 0)]


def test_trailing_commas_and_empty_lists(spark):
    df = actions(spark, *[{"order_category_ids": ids} for ids in ("1,2,,", ",,", "", ",3")])
    assert found(C.order_counts(df)) == [("", 2), ("1", 1), ("2", 1), ("3", 1)]


def test_single_pass_reads_ids_as_numbers(spark):
    df = actions(spark, click(7), {"order_category_ids": "07"}, {"pay_category_ids": "7"})
    assert found(C.top_single_pass(df)) == [("7", 1, 1, 1)]
    assert found(C.top_strict(df)) == []


def test_variants_agree_on_exclusive_rows(spark):
    rows = []
    for cat in range(12):
        rows += [click(cat)] * (cat % 4 + 1)
        rows += [{"order_category_ids": f"{cat},{(cat + 1) % 12}"}] * (cat % 3 + 1)
        rows += [{"pay_category_ids": str(cat)}] * 2
    df = actions(spark, *rows)
    strict = [tuple(r) for r in C.top_strict(df).collect()]
    assert len(strict) == 10
    assert strict == [tuple(r) for r in C.top_single_pass(df).collect()]
    assert strict == [tuple(r) for r in C.top_lenient(df).collect()]


def test_strict_equals_join_of_counts(spark):
    df = actions(spark, click(1, order_category_ids="1,2", pay_category_ids="1"), click(2, pay_category_ids="2,2"))
    joined = (
        C.click_counts(df).toDF("categoryId", "c")
        .join(C.order_counts(df).toDF("categoryId", "o"), "categoryId")
        .join(C.pay_counts(df).toDF("categoryId", "p"), "categoryId")
    )
    assert found(C.top_strict(df)) == found(joined) == [("1", 1, 1, 1), ("2", 1, 1, 2)]


def test_top_breaks_ties_by_id(spark):
    rows = []
    for cat in range(12):
        rows += [click(cat), {"order_category_ids": str(cat)}, {"pay_category_ids": str(cat)}]
    top = [r.categoryId for r in C.top_strict(actions(spark, *rows)).collect()]
    assert top == sorted(map(str, range(12)))[:10]
