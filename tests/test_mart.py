from datetime import date, datetime

import pytest
from conftest import rows

from footfall.functions.calendar import AsOf
from footfall.operators import mart
from footfall.plans import reports
from footfall.schema import MART_COUNTS
from footfall.sources.mart_sink import read_mart

DAY = "2024-01-01"


@pytest.fixture()
def logs(make_feed, make_messages):
    feed = make_feed(
        [(0, f"{DAY} 10:00:00", "view", {"gender": 0, "age": 25, "os": "Android"}),
         (0, f"{DAY} 10:05:00", "like", {"gender": 0, "age": 25, "os": "Android"})]
    )
    messages = make_messages(
        # user 0 sends and receives, 5 only sends, 7 only receives
        [(0, 7, f"{DAY} 11:00:00", {"gender": 0, "age": 25, "os": "Android"}),
         (0, 7, f"{DAY} 11:01:00", {"gender": 0, "age": 25, "os": "Android"}),
         (5, 0, f"{DAY} 11:02:00", {"gender": 1, "age": 40, "os": "iOS"})]
    )
    return feed, messages


def test_user_day_merges_both_services(logs):
    feed, messages = logs
    merged = reports.user_days(feed, messages, date(2024, 1, 1), date(2024, 1, 1))
    assert rows(merged, "user_id", "gender", "age", "os", *MART_COUNTS) == [
        (0, "female", 25, "Android", 1, 1, 1, 2, 1, 1),
        (5, "male", 40, "iOS", 0, 0, 0, 1, 0, 1),
        (7, None, None, None, 0, 0, 2, 0, 1, 0),
    ]


def test_receiver_profile_is_not_the_senders(logs):
    _, messages = logs
    assert set(mart.received_user_day(messages).columns) == {
        "user_id", "event_date", "messages_received", "users_received"
    }


def test_every_cut_sums_to_the_same_totals(logs):
    merged = reports.user_days(*logs, date(2024, 1, 1), date(2024, 1, 1))
    whole = mart.daily_mart(merged)
    totals = merged.agg({c: "sum" for c in MART_COUNTS}).first().asDict()
    for dim in mart.DIMENSIONS:
        cut = whole.where(whole.dimension == dim).agg({c: "sum" for c in MART_COUNTS}).first().asDict()
        assert cut == totals


def test_one_pass_equals_three_cuts(logs):
    merged = reports.user_days(*logs, date(2024, 1, 1), date(2024, 1, 1))
    three = mart.mart_cut(merged, "gender")
    for dim in ("age", "os"):
        three = three.unionByName(mart.mart_cut(merged, dim))
    assert rows(mart.daily_mart(merged)) == rows(three)
    assert ("2024-01-01", "age", "25") in rows(three, "event_date", "dimension", "dimension_value")


def test_two_days_stay_apart(make_feed, make_messages):
    feed = make_feed([(1, "2024-01-01 10:00:00", "view"), (1, "2024-01-02 10:00:00", "view")])
    messages = make_messages([(1, 2, "2024-01-02 10:00:00")])
    merged = reports.user_days(feed, messages, date(2024, 1, 1), date(2024, 1, 2))
    assert rows(merged, "user_id", "event_date", "views", "messages_sent") == [
        (1, "2024-01-01", 1, 0), (1, "2024-01-02", 1, 1), (2, "2024-01-02", 0, 0),
    ]


def test_profile_that_changes_during_a_day_counts_once(make_feed):
    feed = make_feed(
        [(1, f"{DAY} 10:00:00", "view", {"os": "Android"}), (1, f"{DAY} 12:00:00", "view", {"os": "iOS"})]
    )
    assert rows(mart.feed_user_day(feed), "user_id", "views", "os") == [(1, 2, "iOS")]


def test_job_run_twice_changes_nothing(spark, logs, tmp_path):
    as_of, path = AsOf(datetime(2024, 1, 2, 11)), str(tmp_path / "mart")
    reports.mart_job(*logs, as_of, path)
    once = rows(read_mart(spark, path))
    reports.mart_job(*logs, as_of, path)
    assert rows(read_mart(spark, path)) == once
    assert once
