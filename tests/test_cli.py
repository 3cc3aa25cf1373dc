from clickmetrics.__main__ import main
from clickmetrics.operators import category, pages, sessions
from clickmetrics.operators.ads import area_top3, build_blacklist, last_hour_json
from clickmetrics.sources import actions as SA
from clickmetrics.sources import testtables
from clickmetrics.sources.ads import read_ads_text
from clickmetrics.streaming import jobs
from tests.rows import found

SF_DIR = "/root/testdata/sf0.001"


def test_batch_jobs(spark, tmp_path, capsys):
    df = testtables.user_visit_action(spark, SF_DIR)
    text = str(tmp_path / "lines")
    SA.write_actions_text(df, text)
    main(["--output", str(tmp_path / "out"), "page-conversion", "--input", text, "--flow", "1,2,3"])
    assert found(spark.read.parquet(str(tmp_path / "out"))) == found(pages.page_conversion(df, "1,2,3"))
    main(["category-top10", "--input", text, "--variant", "lenient", "--n", "3"])
    main(["session-top10", "--input", text])
    assert "clickCount" in capsys.readouterr().out


def test_area_report_from_views(spark, capsys):
    for table in (testtables.user_visit_action, testtables.product_info, testtables.city_info):
        table(spark, SF_DIR).createOrReplaceTempView(table.__name__)
    main(["area-top3"])
    assert "其它" in capsys.readouterr().out


def test_stream_job(spark, tmp_path):
    inbox, folder = str(tmp_path / "in"), str(tmp_path / "job")
    testtables.ads_log(spark, SF_DIR).write.text(inbox)
    main(["ads-blacklist", "--files", inbox, "--folder", folder, "--once", "--min-clicks", "2", "--per-batch", "1"])
    expected = build_blacklist(read_ads_text(spark, inbox), 2)
    assert found(jobs.blacklist_table(folder).read(spark)) == found(expected)


def test_session_numbers(spark, tmp_path, capsys):
    df = testtables.user_visit_action(spark, "/root/testdata/sf0.01")
    text = str(tmp_path / "lines")
    SA.write_actions_text(df, text)
    expected = sessions.top_sessions(df, category.top_strict(df, 3), 40)
    out = str(tmp_path / "out")
    numbers = ["session-top10", "--input", text, "--categories", "3", "--n", "40"]
    main(["--output", out, *numbers])
    assert found(spark.read.parquet(out)) == found(expected)
    main(numbers)
    rows = expected.count()
    assert rows > 100
    assert f"{rows - 100} more rows" in capsys.readouterr().out


def test_stream_settings(spark, tmp_path):
    inbox = str(tmp_path / "in")
    testtables.ads_log(spark, SF_DIR).write.text(inbox)
    ads = read_ads_text(spark, inbox)
    top = str(tmp_path / "top")
    main(["ads-top3", "--files", inbox, "--folder", top, "--once", "--k", "1", "--watermark", "400 days"])
    assert found(jobs.read_top3(spark, top)) == found(area_top3(ads, 1))
    hour = str(tmp_path / "hour")
    main(["ads-last-hour", "--files", inbox, "--folder", hour, "--once", "--minutes", "30", "--slide-seconds", "10"])
    assert found(jobs.read_last_hour_hash(spark, hour)) == found(last_hour_json(ads, 30, 10))


def test_console_job(spark, tmp_path, monkeypatch):
    inbox, started, start = str(tmp_path / "in"), [], jobs.start_console

    def watched(*args, **options):
        started.append(start(*args, **options))
        return started[0]

    monkeypatch.setattr(jobs, "start_console", watched)
    testtables.ads_log(spark, SF_DIR).limit(5).write.text(inbox)
    main(["ads-console", "--files", inbox, "--once"])
    # The JVM prints past Python's capture, so the rows that reached the sink are counted.
    assert sum(p["numInputRows"] for p in started[0].recentProgress) == 5
