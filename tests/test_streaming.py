import random
from datetime import datetime, timedelta

from conftest import rows

from footfall.operators import anomaly
from footfall.sources.adapter import feed_from_events, messages_from_events
from footfall.sources.logs import activity, write_log
from footfall.streaming import quarter_hour as live

SCHEMA = live.EVENTS
KINDS = ["view", "click", "purchase", "signup"]


def make_events(spark, start, count, seed, minutes=300):
    random.seed(seed)
    data = [
        (seed * 100_000 + i, start + timedelta(minutes=random.uniform(0, minutes)), random.randint(0, 8),
         random.choice(KINDS), 1.0, f'{{"k": {random.randint(0, 20)}}}')
        for i in range(count)
    ]
    return spark.createDataFrame(data, SCHEMA)


def run_once(spark, source, target):
    slots = live.stream_slots(live.stream_activity(spark, source, "*.parquet"))
    live.run_slots(slots, target, trigger={"availableNow": True}).awaitTermination()


def batch_slots(events):
    return anomaly.slot_metrics(activity(feed_from_events(events), messages_from_events(events)))


COLUMNS = ["ts", "users_feed", "views", "likes", "ctr", "users_messenger", "messages"]


def closed(slots, newest):
    limit = newest - timedelta(hours=1, minutes=15)
    return rows(slots.where(slots.ts <= limit), *COLUMNS)


def test_closed_slots_equal_the_batch_report(spark, tmp_path):
    source, target = str(tmp_path / "events"), str(tmp_path / "out")
    events = make_events(spark, datetime(2024, 1, 1, 8), 900, 1)
    events.write.parquet(source)
    run_once(spark, source, target)
    newest = events.agg({"ts": "max"}).first()[0]
    assert rows(live.read_slots(spark, target), *COLUMNS) == closed(batch_slots(events), newest)
    assert live.read_slots(spark, target).count() > 10


def test_later_files_continue_where_the_stream_stopped(spark, tmp_path):
    source, target = str(tmp_path / "events"), str(tmp_path / "out")
    first = make_events(spark, datetime(2024, 1, 1, 8), 500, 1)
    # the second file starts inside the hour the watermark still allows
    second = make_events(spark, datetime(2024, 1, 1, 12, 10), 500, 2)
    first.write.parquet(source)
    run_once(spark, source, target)
    early = live.read_slots(spark, target).count()
    second.write.mode("append").parquet(source)
    run_once(spark, source, target)
    both = first.unionByName(second)
    newest = both.agg({"ts": "max"}).first()[0]
    assert rows(live.read_slots(spark, target), *COLUMNS) == closed(batch_slots(both), newest)
    assert live.read_slots(spark, target).count() > early
    run_once(spark, source, target)  # nothing new
    assert rows(live.read_slots(spark, target), *COLUMNS) == closed(batch_slots(both), newest)


def test_stream_alerts_equal_the_batch_rule(spark, tmp_path):
    source, target = str(tmp_path / "events"), str(tmp_path / "out")
    for seed, hour in ((1, 8), (2, 12)):
        make_events(spark, datetime(2024, 1, 1, hour, 20), 400, seed, minutes=230).write.mode("append").parquet(source)
        run_once(spark, source, target)
    slots = live.read_slots(spark, target)
    expected = anomaly.band_breaks(anomaly.iqr_bands(anomaly.metric_series(slots), live=True))
    got = live.read_alerts(spark, target)
    assert rows(got, "metric", "ts", "value", "low", "up") == rows(expected, "metric", "ts", "value", "low", "up")
    assert got.count() > 0


def test_alerts_survive_a_quiet_gap(spark, tmp_path):
    """Five hours of traffic, almost four quiet days, a burst: history counts slots, not days."""
    source, target = str(tmp_path / "events"), str(tmp_path / "out")
    for seed, moment, count in (
        (1, datetime(2024, 1, 1, 8), 500), (2, datetime(2024, 1, 5, 6), 1500), (3, datetime(2024, 1, 5, 12), 600),
    ):
        make_events(spark, moment, count, seed, minutes=240).write.mode("append").parquet(source)
        run_once(spark, source, target)
    slots = live.read_slots(spark, target)
    expected = anomaly.band_breaks(anomaly.iqr_bands(anomaly.metric_series(slots), live=True))
    got = live.read_alerts(spark, target)
    assert rows(got, "metric", "ts", "value", "low", "up") == rows(expected, "metric", "ts", "value", "low", "up")
    assert got.where("ts >= '2024-01-05' and ts < '2024-01-05 07:00:00'").count() > 0  # the start of the burst


def test_a_batch_reads_as_much_however_long_the_stream_runs(spark, tmp_path, monkeypatch):
    source, target = str(tmp_path / "events"), str(tmp_path / "out")
    read = []
    reader = type(spark.read)
    plain = reader.parquet

    def counted(self, *paths, **options):
        found = plain(self, *paths, **options)
        if any(str(p).startswith(target) for p in paths):
            read.append(len(found.inputFiles()))
        return found

    monkeypatch.setattr(reader, "parquet", counted)
    per_run = []
    for i in range(6):
        events = make_events(spark, datetime(2024, 1, 1, 8) + timedelta(hours=3 * i), 200, i + 1, minutes=170)
        events.coalesce(1).write.mode("append").parquet(source)
        read.clear()
        run_once(spark, source, target)
        per_run.append(max(read))
    monkeypatch.undo()
    stored = len(list((tmp_path / "out" / "slots").rglob("*.parquet")))
    most = 2 * 4 + 1  # a batch's slots in four files for each of two days, and the recent ones
    assert max(per_run) <= most < stored
    assert len(list((tmp_path / "out" / "recent").glob("batch=*"))) <= 2
    slots = live.read_slots(spark, target)
    expected = anomaly.band_breaks(anomaly.iqr_bands(anomaly.metric_series(slots), live=True))
    assert rows(live.read_alerts(spark, target), "metric", "ts") == rows(expected, "metric", "ts")


def test_the_stream_reads_both_logs(spark, tmp_path):
    events = make_events(spark, datetime(2024, 1, 1, 8), 900, 1)
    feed, messages = feed_from_events(events), messages_from_events(events)
    for log, name in ((feed, "feed"), (messages, "messages")):
        write_log(log, str(tmp_path / name))
    target = str(tmp_path / "out")
    both = live.stream_logs(spark, str(tmp_path / "feed"), str(tmp_path / "messages"))
    live.run_slots(live.stream_slots(both), target, trigger={"availableNow": True}).awaitTermination()
    newest = events.agg({"ts": "max"}).first()[0]
    assert rows(live.read_slots(spark, target), *COLUMNS) == closed(batch_slots(events), newest)
    one_day = live.read_slots(spark, target, datetime(2024, 1, 2).date())
    assert one_day.count() == 0
    assert "PartitionFilters: [isnotnull(date" in one_day._jdf.queryExecution().executedPlan().toString()


def test_estimated_users_stay_close(spark, tmp_path):
    source, target = str(tmp_path / "events"), str(tmp_path / "out")
    events = make_events(spark, datetime(2024, 1, 1, 8), 900, 1)
    events.write.parquet(source)
    slots = live.stream_slots(live.stream_activity(spark, source, "*.parquet"), approx=True)
    live.run_slots(slots, target, trigger={"availableNow": True}).awaitTermination()
    newest = events.agg({"ts": "max"}).first()[0]
    assert rows(live.read_slots(spark, target), *COLUMNS) == closed(batch_slots(events), newest)  # few users: exact
