from clickmetrics.operators import ads as A
from clickmetrics.sources.ads import parse_ads
from tests.rows import found, lines, millis


def clicks(spark, *rows):
    """(day, clock, area, user, ad)"""
    return parse_ads(lines(spark, *[f"{millis(d, t)},{a},city,{u},{ad}" for d, t, a, u, ad in rows]))


def many(day, area, **per_ad):
    return [(day, "10:00:00", area, 1, ad[1:]) for ad, n in per_ad.items() for _ in range(n)]


def test_top3_payload(spark):
    df = clicks(spark, *many("2024-01-01", "N", a1=5, a2=9, a3=1, a4=7))
    assert found(A.area_top3_json(df)) == [
        ("area:ads:top3:2024-01-01", "N", '[{"2":9},{"4":7},{"1":5}]')
    ]


def test_days_do_not_mix(spark):
    df = clicks(spark, *many("2024-01-01", "N", a1=2), *many("2024-01-02", "N", a2=1))
    assert found(A.area_top3_json(df)) == [
        ("area:ads:top3:2024-01-01", "N", '[{"1":2}]'),
        ("area:ads:top3:2024-01-02", "N", '[{"2":1}]'),
    ]


def test_minutes_across_midnight(spark):
    df = clicks(spark, ("2024-01-02", "00:01:00", "N", 1, 1), ("2024-01-01", "23:59:00", "N", 1, 1))
    assert found(A.last_hour_json(df)) == [("last_hour_click", "1", '[{"23:59":1},{"00:01":1}]')]


def test_last_hour_edge(spark):
    # The newest click lies in the slide 10:00:00-10:00:05, so the hour starts at 09:00:05.
    times = ["09:00:04", "09:00:05", "10:00:02"]
    df = clicks(spark, *[("2024-01-01", t, "N", 1, 1) for t in times])
    assert found(A.last_hour_clicks(df)) == [("1", "09:00", 1), ("1", "10:00", 1)]


def test_blacklist_is_per_day(spark):
    df = clicks(
        spark,
        ("2024-01-01", "10:00:00", "N", 7, 1),
        ("2024-01-01", "10:00:01", "N", 7, 1),
        ("2024-01-02", "10:00:00", "N", 7, 1),
        ("2024-01-01", "10:00:00", "N", 8, 1),
        ("2024-01-01", "10:00:00", "N", 8, 2),
    )
    listed = A.build_blacklist(df, 2)
    assert found(listed) == [("2024-01-01", "7")]
    kept = found(A.drop_blacklisted(df, listed).select("dayString", "userId", "adsId"))
    assert kept == [("2024-01-01", "8", "1"), ("2024-01-01", "8", "2"), ("2024-01-02", "7", "1")]
    assert A.build_blacklist(df).count() == 3
