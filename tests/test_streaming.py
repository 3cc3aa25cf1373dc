"""Streaming jobs: equal to the batch result, across several batches, restarts and replays."""

import functools
import random
from collections import Counter
from pathlib import Path

import pytest

from clickmetrics.operators import ads as A
from clickmetrics.sources import testtables
from clickmetrics.sources.ads import parse_ads, read_ads_text, stream_ads_files
from clickmetrics.streaming import jobs
from clickmetrics.streaming.tables import BatchTable, KeyedTable, stamp_files, values_of
from tests.rows import found, lines, millis

SF_DIR = "/root/testdata/sf0.001"
NOW = {"availableNow": True}
COUNTS = "k string, n bigint"


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    """The clicks as text, in three files."""
    folder = str(tmp_path_factory.mktemp("log") / "lines")
    testtables.ads_log(spark, SF_DIR).repartition(3).write.text(folder)
    return folder


@pytest.fixture
def small_epochs(monkeypatch):
    monkeypatch.setattr(jobs, "KeyedTable", functools.partial(KeyedTable, fold_every=2))


JOBS = {
    "counts": (
        jobs.start_daily_area_counts,
        lambda spark, f: jobs.counts_table(f).read(spark),
        A.daily_area_counts,
        {},
    ),
    "counts, bounded state": (
        jobs.start_daily_area_counts,
        lambda spark, f: jobs.counts_table(f).read(spark),
        A.daily_area_counts,
        {"watermark": "60 days"},
    ),
    "top3": (jobs.start_area_top3, jobs.read_top3, A.area_top3, {}),
    "top3 json": (jobs.start_area_top3, jobs.read_top3_hash, A.area_top3_json, {}),
    "last hour": (
        jobs.start_last_hour,
        jobs.read_last_hour_hash,
        functools.partial(A.last_hour_json, minutes=2880),
        {"minutes": 2880},
    ),
    "blacklist": (
        jobs.start_blacklist,
        lambda spark, f: jobs.blacklist_table(f).read(spark),
        functools.partial(A.build_blacklist, min_clicks=2),
        {"min_clicks": 2},
    ),
    "blacklist loop": (
        jobs.start_blacklist_loop,
        lambda spark, f: jobs.blacklist_table(f).read(spark),
        functools.partial(A.build_blacklist, min_clicks=2),
        {"min_clicks": 2},
    ),
    "raw": (jobs.start_raw_append, jobs.read_raw, lambda ads: ads, {}),
}


@pytest.mark.parametrize("name", JOBS)
def test_three_batches_equal_the_batch_query(spark, log, tmp_path, small_epochs, name):
    start, read, batch, options = JOBS[name]
    clicks = parse_ads(stream_ads_files(spark, log, files_per_batch=1))
    query = start(clicks, str(tmp_path), trigger=NOW, **options)
    query.awaitTermination()
    assert query.lastProgress["batchId"] >= 2
    assert found(read(spark, str(tmp_path))) == found(batch(read_ads_text(spark, log)))


class Feed:
    """A folder of click files and a job that is restarted for every new file."""

    def __init__(self, spark, tmp_path, start, **options):
        self.spark, self.start, self.options = spark, start, options
        self.inbox, self.folder = tmp_path / "in", str(tmp_path / "job")
        self.inbox.mkdir()

    def send(self, *rows):
        """Rows of (day, clock, area, user, ad); one file, one batch."""
        n = len(list(self.inbox.iterdir()))
        text = "\n".join(f"{millis(d, t)},{a},city,{u},{ad}" for d, t, a, u, ad in rows)
        (self.inbox / f"{n}.txt").write_text(text)
        clicks = parse_ads(stream_ads_files(self.spark, str(self.inbox)))
        self.start(clicks, self.folder, trigger=NOW, **self.options).awaitTermination()


DAY = "2024-01-01"


def test_feedback_drops_clicks_after_listing(spark, tmp_path):
    feed = Feed(spark, tmp_path, jobs.start_blacklist_loop, min_clicks=2)
    listed = jobs.blacklist_table(feed.folder)
    click = (DAY, "10:00:00", "N", 7, 1)
    feed.send(click)
    assert found(listed.read(spark)) == []
    feed.send(click, ("2024-01-02", "10:00:00", "N", 7, 1))
    assert found(listed.read(spark)) == [(DAY, "7")]
    feed.send(click, ("2024-01-02", "11:00:00", "N", 8, 1))
    assert found(listed.read(spark)) == [(DAY, "7")]
    passed = jobs.read_passed(spark, feed.folder).groupBy("dayString", "userId").count()
    assert found(passed) == [(DAY, "7", 2), ("2024-01-02", "7", 1), ("2024-01-02", "8", 1)]


def test_replayed_batch_does_not_count_twice(spark, tmp_path):
    feed = Feed(spark, tmp_path, jobs.start_blacklist_loop, min_clicks=3)
    click = (DAY, "10:00:00", "N", 7, 1)
    feed.send(click)
    feed.send(click)
    counts = found(jobs.user_counts_table(feed.folder).read(spark))
    assert counts == [(DAY, "7", "1", 2)]
    # Without its commit entry, batch 1 counts as unfinished and runs again on restart.
    commit = Path(feed.folder) / "checkpoint" / "commits" / "1"
    commit.unlink()
    crc = commit.with_name(".1.crc")
    if crc.exists():
        crc.unlink()
    feed.send(click)
    assert found(jobs.user_counts_table(feed.folder).read(spark)) == [(DAY, "7", "1", 3)]
    assert found(jobs.blacklist_table(feed.folder).read(spark)) == [(DAY, "7")]
    assert jobs.read_passed(spark, feed.folder).count() == 3


def test_top3_follows_growing_counts(spark, tmp_path):
    feed = Feed(spark, tmp_path, jobs.start_area_top3)

    def send(**per_ad):
        feed.send(*[(DAY, "10:00:00", "N", 1, ad[1:]) for ad, n in per_ad.items() for _ in range(n)])
        return [r.value for r in jobs.read_top3_hash(spark, feed.folder).collect()]

    assert send(a1=3, a2=2, a3=1) == ['[{"1":3},{"2":2},{"3":1}]']
    assert send(a4=2) == ['[{"1":3},{"2":2},{"4":2}]']
    assert send(a3=4) == ['[{"3":5},{"1":3},{"2":2}]']


def test_stale_ads_leave_the_last_hour(spark, tmp_path):
    feed = Feed(spark, tmp_path, jobs.start_last_hour)
    feed.send((DAY, "10:00:00", "N", 1, 1), (DAY, "10:30:10", "N", 1, 1), (DAY, "10:30:20", "N", 1, 2))
    assert found(jobs.read_last_hour_hash(spark, feed.folder)) == [
        ("last_hour_click", "1", '[{"10:00":1},{"10:30":1}]'),
        ("last_hour_click", "2", '[{"10:30":1}]'),
    ]
    feed.send((DAY, "11:30:18", "N", 1, 1))
    assert found(jobs.read_last_hour_hash(spark, feed.folder)) == [
        ("last_hour_click", "1", '[{"11:30":1}]'),
        ("last_hour_click", "2", '[{"10:30":1}]'),
    ]
    feed.send((DAY, "12:00:00", "N", 1, 1))
    assert found(jobs.read_last_hour_hash(spark, feed.folder)) == [("last_hour_click", "1", '[{"11:30":1},{"12:00":1}]')]


def test_late_clicks_still_count(spark, tmp_path):
    feed = Feed(spark, tmp_path, jobs.start_last_hour)
    feed.send((DAY, "10:30:00", "N", 1, 1))
    feed.send((DAY, "10:31:00", "N", 1, 1))
    feed.send((DAY, "09:45:00", "N", 1, 1))
    (row,) = found(jobs.read_last_hour_hash(spark, feed.folder))
    assert row[2] == '[{"09:45":1},{"10:30":1},{"10:31":1}]'


DAYS = "day string, k string, n bigint"


def _keyed(tmp_path, **options):
    return KeyedTable(str(tmp_path / "t"), DAYS, ["day", "k"], by="day", fold_every=2, **options)


def _runs(tmp_path):
    return sorted(str(p.relative_to(tmp_path / "t")) for p in (tmp_path / "t").glob("level=*/run=*"))


def test_keyed_table_folds_and_replays(spark, tmp_path):
    table = _keyed(tmp_path)
    assert found(table.read(spark)) == [] and table.last_batch(spark) == -1
    for batch in range(9):
        rows = [("d1", f"k{batch}", batch), ("d2", "all", batch)]
        for _ in range(2):  # the second time is a replay, for some batches one of a fold
            table.write(spark.createDataFrame(rows, DAYS), batch)
            expected = [("d1", f"k{b}", b) for b in range(batch + 1)] + [("d2", "all", batch)]
            assert found(table.read(spark)) == expected and table.last_batch(spark) == batch
        assert found(table.read(spark, batch - 1).where("k = 'all'")) == [("d2", "all", batch - 1)] * (batch > 0)
    # Eight batches make one run of level 3; of lower levels only the newest folded block is left.
    assert _runs(tmp_path) == [f"level={r}" for r in ("0/run=6", "0/run=7", "0/run=8", "1/run=2", "1/run=3", "2/run=0", "2/run=1", "3/run=0")]


def test_keyed_table_rewrites_only_what_its_batches_touched(spark, tmp_path):
    table = _keyed(tmp_path)
    for batch, day in enumerate(["d1", "d1", "d2", "d2", "d3"]):
        table.write(spark.createDataFrame([(day, "k", batch)], DAYS), batch)
    folded = {r: sorted(p.name for p in (tmp_path / "t" / r).glob("day=*")) for r in _runs(tmp_path) if r >= "level=1"}
    assert folded == {"level=1/run=0": ["day=d1"], "level=1/run=1": ["day=d2"], "level=2/run=0": ["day=d1", "day=d2"]}


def _files_read(df):
    """Files that the scans of a query opened."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    stack, files = [plan.finalPhysicalPlan() if "AdaptiveSparkPlan" in plan.nodeName() else plan], 0
    while stack:
        node = stack.pop()
        children = node.children()
        stack += [children.apply(i) for i in range(children.size())]
        if node.nodeName().startswith("ShuffleQueryStage"):
            stack.append(node.plan())
        if node.nodeName().startswith("Scan parquet"):
            files += node.metrics().apply("numFiles").value()
    return files


def test_lookups_open_only_the_days_asked_for(spark, tmp_path):
    table = _keyed(tmp_path)
    for batch in range(6):
        rows = [(f"d{d}", f"k{batch}", d) for d in range(batch, batch + 4)]
        table.write(spark.createDataFrame(rows, DAYS).coalesce(1), batch)
    asked = spark.createDataFrame([("d1", "k0"), ("d8", "k5")], "day string, k string")
    of_days = values_of(asked, "day")
    rows = table.read(spark, None, lambda t: t.where(of_days).join(asked, ["day", "k"], "left_semi"))
    assert found(rows) == [("d1", "k0", 1), ("d8", "k5", 8)]
    # d1 lies in batches 0 and 1, folded into one run; d8 in batch 5 alone.
    assert _files_read(rows) == 2
    assert _files_read(table.read(spark)) > 6


def test_values_of_names_values_or_their_range(spark, monkeypatch):
    rows = spark.createDataFrame([("a",), ("c",), (None,)], "k string")
    probe = spark.createDataFrame([("a",), ("b",), ("c",), ("d",), (None,)], "k string")
    assert [r[0] for r in probe.where(values_of(rows, "k")).collect()] == ["a", "c", None]
    monkeypatch.setattr("clickmetrics.streaming.tables.MOST_VALUES", 1)
    assert [r[0] for r in probe.where(values_of(rows, "k")).collect()] == ["a", "b", "c", None]
    assert probe.where(values_of(rows.limit(0), "k")).collect() == []


def test_keyed_table_with_batches_left_out(spark, tmp_path):
    table = _keyed(tmp_path)
    for batch in (3, 4, 11, 20):
        before = found(table.read(spark, batch - 1))
        for _ in range(2):  # the second time is a replay
            assert found(table.read(spark, batch - 1)) == before
            table.write(spark.createDataFrame([("d", f"k{batch}", batch)], DAYS), batch)
        assert len(found(table.read(spark))) == len(before) + 1


def test_rows_read_before_a_fold_can_still_be_written(spark, tmp_path):
    table = _keyed(tmp_path)
    for batch in (0, 1, 2, 3, 9):
        old = table.read(spark, batch - 1)  # its files must outlive the folds of the write below
        table.write(old.unionByName(spark.createDataFrame([("d", f"k{batch}", batch)], DAYS)), batch)
    assert found(table.read(spark)) == [("d", f"k{b}", b) for b in (0, 1, 2, 3, 9)]


def test_keyed_table_ignores_an_unfinished_fold(spark, tmp_path):
    table = _keyed(tmp_path)
    for batch in range(2):
        table.write(spark.createDataFrame([("d", f"k{batch}", batch)], DAYS), batch)
    (tmp_path / "t" / "level=1" / "run=0").mkdir(parents=True)
    assert found(table.read(spark, 4)) == [("d", "k0", 0), ("d", "k1", 1)]
    table.write(spark.createDataFrame([("d", "k5", 5)], DAYS), 5)
    assert found(table.read(spark)) == [("d", "k0", 0), ("d", "k1", 1), ("d", "k5", 5)]


def test_batch_table_is_the_last_batch(spark, tmp_path):
    table = BatchTable(str(tmp_path / "t"), COUNTS)
    assert found(table.read(spark)) == [] and table.last_batch(spark) == -1
    for batch in (0, 1, 2, 5):
        before = found(table.read(spark))
        for _ in range(2):
            assert found(table.read(spark, batch - 1)) == before
            table.write(lines(spark, str(batch)).selectExpr("value AS k", f"{batch}L AS n"), batch)
            assert found(table.read(spark)) == [(str(batch), batch)]
    assert sorted(p.name for p in (tmp_path / "t").iterdir()) == ["batch_id=2", "batch_id=5"]


def _random_clicks(seed):
    """Batches of clicks around midnight, with gaps of minutes and hours and with late ones."""
    rng = random.Random(seed)
    now, batches = millis(DAY, "23:20:00"), []
    for _ in range(9):
        now += rng.choice([1_000, 40_000, 600_000, 1_500_000, 9_000_000])
        rows = [now] + [now - rng.choice([0, 3_000, 70_000, 2_000_000, 4_000_000]) for _ in range(rng.randrange(6))]
        batches.append([(t, rng.randrange(3)) for t in rows])
    return batches


def test_evicting_hour_equals_the_batch_query(spark, tmp_path, small_epochs):
    inbox, folder, seen = tmp_path / "in", str(tmp_path / "job"), []
    inbox.mkdir()
    for k, batch in enumerate(_random_clicks(2)):
        text = [f"{t},N,city,1,{ad}" for t, ad in batch]
        (inbox / f"{k}.txt").write_text("\n".join(text))
        clicks = parse_ads(stream_ads_files(spark, str(inbox)))
        jobs.start_last_hour(clicks, folder, trigger=NOW).awaitTermination()  # every batch after a restart
        if k % 3 == 2:  # run the batch once more, as after a failure before its commit
            for name in (str(k), f".{k}.crc"):
                (Path(folder) / "checkpoint" / "commits" / name).unlink(missing_ok=True)
            jobs.start_last_hour(clicks, folder, trigger=NOW).awaitTermination()
        seen += text
        expected = A.last_hour_json(parse_ads(lines(spark, *seen)))
        assert found(jobs.read_last_hour_hash(spark, folder)) == found(expected)


def test_hour_opens_expired_panes_only(spark, tmp_path):
    feed = Feed(spark, tmp_path, jobs.start_last_hour)
    for minute in range(0, 50, 5):
        feed.send((DAY, f"10:{minute:02}:00", "N", 1, 1))
    feed.send((DAY, "11:07:00", "N", 1, 1))
    tables = jobs.HourTables(feed.folder)
    newest, start = tables.time(spark)
    assert newest == millis(DAY, "11:07:00") and start == millis(DAY, "10:07:05")
    # What the next batch would take off if it came at 11:11: the one pane of 10:10.
    gone = tables.panes.read(spark, start, millis(DAY, "10:11:00"), 99)
    assert found(gone.select("minute")) == [(millis(DAY, "10:10:00"),)] and _files_read(gone) == 1
    # Panes that left the hour before the last batch began are removed.
    slots = sorted(int(p.name[5:]) for p in (tmp_path / "job" / "panes").glob("slot=*"))
    assert slots[0] >= millis(DAY, "09:45:05") // 60_000 and len(slots) == 11


def test_hour_by_arrival(spark, tmp_path):
    """Files count by their modification time, whatever time their clicks carry."""
    inbox, folder = tmp_path / "in", str(tmp_path / "job")
    inbox.mkdir()
    sent = []
    for k, (minutes, clocks) in enumerate([(0, ["03:00:00", "23:59:00"]), (30, ["03:00:10"]), (61, ["01:00:00"]), (95, ["03:00:20"])]):
        (inbox / f"{k}.txt").write_text("\n".join(f"{millis(DAY, c)},N,city,1,7" for c in clocks))
        sent.append((millis(DAY) + minutes * 60_000, clocks))
        files = spark._jvm.org.apache.hadoop.fs.Path(str(inbox / f"{k}.txt"))
        files.getFileSystem(spark._jsc.hadoopConfiguration()).setTimes(files, sent[-1][0], -1)
        clicks = parse_ads(stream_ads_files(spark, str(inbox), arrival=True))
        jobs.start_last_hour(clicks, folder, trigger=NOW, time="arrival").awaitTermination()
        start = sent[-1][0] - 3_595_000
        expected = Counter(c[:5] for at, clocks in sent if at >= start for c in clocks)
        got = {r["hmString"]: r["n"] for r in jobs.read_last_hour(spark, folder).collect()}
        assert got == expected
    stamp_files(spark, str(inbox), 1000)
    assert all(f.stat().st_mtime == 1 for f in inbox.glob("*.txt"))


def test_rejected_lines_survive_a_restart(spark, tmp_path):
    inbox, folder = tmp_path / "in", str(tmp_path / "job")
    inbox.mkdir()
    for k, text in enumerate([f"{millis(DAY)},N,c,1,2\nbroken", f"x,N,c,1,2\n{millis(DAY)},N,c,1", f"{millis(DAY)},N,c,3,4"]):
        (inbox / f"{k}.txt").write_text(text)
        if k == 2:  # batch 1 runs again, as after a failure before its commit
            for name in ("1", ".1.crc"):
                (Path(folder) / "checkpoint" / "commits" / name).unlink(missing_ok=True)
        jobs.start_checked_append(stream_ads_files(spark, str(inbox)), folder, trigger=NOW).awaitTermination()
    clicks, rejected = jobs.read_checked(spark, folder)
    assert sorted(r["userId"] for r in clicks.collect()) == ["1", "3"]
    assert found(rejected) == [(f"{millis(DAY)},N,c,1", "missing field"), ("broken", "missing field"), ("x,N,c,1,2", "bad time")]
    assert found(jobs.read_line_counts(spark, folder)) == [("bad time", 1), ("good", 2), ("missing field", 2)]


def test_console_sink(spark, tmp_path, log):
    query = jobs.start_console(parse_ads(stream_ads_files(spark, log)), trigger=NOW)
    query.awaitTermination()
    assert query.exception() is None
