"""What the physical plans must and must not contain."""

import re
from datetime import date, datetime
from pathlib import Path

import pytest

from footfall.functions.calendar import AsOf
from footfall.operators import anomaly, daily, experiments, mart, posts, retention, series
from footfall.plans import reports
from footfall.sources.adapter import load_feed, load_messages
from footfall.sources.logs import activity

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="provided tables not found")
FIRST, LAST = date(2024, 1, 1), date(2024, 1, 30)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    execution = df._jdf.queryExecution()
    df._jdf.collectToPython()
    return execution.executedPlan().toString().split("== Initial Plan ==")[0]


def exchanges(text):
    return len(re.findall(r"Exchange hashpartitioning", text))


@pytest.fixture(scope="module")
def feed(spark):
    return load_feed(spark, FOLDER)


@pytest.fixture(scope="module")
def messages(spark):
    return load_messages(spark, FOLDER)


def per_user_plans(feed, messages):
    both = activity(feed, messages)
    return {
        "feed_daily": daily.feed_daily(feed, FIRST, LAST),
        "app_dau": daily.app_dau(both, FIRST, LAST),
        "overlap": daily.audience_overlap(both, "all"),
        "per_user": daily.actions_per_user(both, FIRST, LAST),
        "cohorts": retention.cohort_retention(feed, FIRST, LAST),
        "weekly": retention.weekly_audience(feed, FIRST, LAST),
        "return": retention.new_user_return(feed),
        "mart": mart.daily_mart(reports.user_days(feed, messages, FIRST, LAST)),
        "users": experiments.user_ctr(feed, FIRST, LAST, [1, 2]),
        "smoothed": experiments.smoothed_ctr(experiments.user_ctr(feed, FIRST, LAST, [1, 2]), [1, 2]),
        "posts": posts.post_stats(feed),
        "profiles": series.published_by_hour(feed),
    }


def test_no_population_in_one_task(feed, messages):
    for name, df in per_user_plans(feed, messages).items():
        text = plan(df)
        assert "SinglePartition" not in text, name
        assert "CartesianProduct" not in text and "NestedLoopJoin" not in text, name
        assert "Window" not in text, name


def below_first_exchange(text):
    return text[text.rindex("Exchange hashpartitioning"):]


def test_cohorts_shuffle_users_once_without_sorting_events(feed):
    for df in (
        retention.cohort_retention(feed, FIRST, LAST),
        retention.weekly_audience(feed, FIRST, LAST),
    ):
        text = plan(df)
        assert exchanges(text) == 2
        assert "SortAggregate" not in text and "ObjectHashAggregate" not in text
    for df in (
        retention.cohort_retention(feed, FIRST, LAST, "source"),
        retention.new_user_return(feed),
    ):
        assert "Sort" not in below_first_exchange(plan(df))


def test_user_days_hash_events_and_sort_only_user_days(feed, messages):
    for df in (
        mart.feed_user_day(feed),
        mart.sent_user_day(messages),
        mart.received_user_day(messages),
        mart.message_user_day(messages),
    ):
        below = below_first_exchange(plan(df))
        assert "HashAggregate" in below
        assert "Sort" not in below


def test_both_directions_come_from_one_scan(feed, messages):
    assert plan(mart.message_user_day(messages)).count("FileScan") == 1
    assert plan(reports.user_days(feed, messages)).count("FileScan") == 2
    pair = mart.messenger_user_day(mart.sent_user_day(messages), mart.received_user_day(messages))
    one = mart.message_user_day(messages).select(pair.columns)
    assert one.exceptAll(pair).count() == 0 and pair.exceptAll(one).count() == 0


def test_day_over_day_reads_each_log_once(feed, messages):
    slots = anomaly.slot_metrics(activity(feed, messages))
    text = plan(anomaly.day_over_day(anomaly.metric_series(slots), 0.3))
    assert text.count("FileScan") == 2
    assert "Join" not in text


def test_merging_services_shuffles_nothing_again(feed, messages):
    sides = [
        mart.feed_user_day(feed),
        mart.sent_user_day(messages),
        mart.received_user_day(messages),
    ]
    alone = sum(exchanges(plan(side)) for side in sides)
    together = mart.user_day(sides[0], mart.messenger_user_day(sides[1], sides[2]))
    assert exchanges(plan(together)) == alone
    one_pass = mart.user_day(sides[0], mart.message_user_day(messages))
    assert exchanges(plan(one_pass)) < alone


def test_time_range_and_columns_reach_the_scan(feed, messages):
    text = plan(daily.app_dau(activity(feed, messages), date(2024, 1, 24), LAST))
    scans = [line for line in text.splitlines() if "FileScan" in line]
    assert len(scans) == 2
    for scan in scans:
        assert "GreaterThanOrEqual(ts" in scan
        assert "value" not in scan.split("ReadSchema")[1] and "props" not in scan.split("ReadSchema")[1]


def test_group_totals_reuse_the_user_shuffle(feed):
    users = experiments.user_ctr(feed, FIRST, LAST, [0, 1, 2, 3])
    for df in (
        experiments.smoothed_ctr(users, [0, 1, 2, 3]),
        experiments.linearized(users, [(0, 3), (1, 2)]),
    ):
        assert "ReusedExchange" in final_plan(df)


def test_report_tables(spark, feed, messages):
    as_of = AsOf(datetime(2024, 1, 31, 11))
    app = reports.app_report(feed, messages, as_of, FIRST)
    assert set(app) == {
        "text", "dau", "actions_per_user", "retention_feed", "retention_messenger",
        "weekly_audience_feed", "weekly_audience_messenger",
    }
    assert app["text"].first()["text"].startswith("App report for 2024-01-30.")
    assert app["dau"].count() == 3 * 7
    assert app["weekly_audience_feed"].columns == ["this_week", "new", "retained", "lost"]
    for name, table in app.items():  # the logs are not read again
        assert "event_id" not in plan(table) and "events.parquet" not in plan(table), name
    short = reports.feed_report(feed, as_of)
    assert short["week"].count() == 7 and short["text"].count() == 1


def test_experiment_report_lists_every_method(feed):
    report = reports.experiment_report(feed, date(2024, 1, 15), date(2024, 1, 21), 2, 1, buckets=5)
    assert [(r.metric, r.method) for r in report.collect()] == [
        ("ctr", "welch"), ("ctr", "mann_whitney"),
        ("smoothed_ctr", "welch"), ("smoothed_ctr", "mann_whitney"),
        ("bucket_ctr", "welch"), ("bucket_ctr", "mann_whitney"),
        ("bucket_q90", "mann_whitney"), ("linearized_likes", "welch"),
    ]
