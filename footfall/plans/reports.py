"""The scheduled jobs as functions of their input logs and an explicit moment.

Scheduling and delivery belong to the caller. Each function returns the tables and
texts a job would send. ``app_report`` and ``experiment_report`` write a reduced input to
the scratch folder when called (and the rank tests of the latter run jobs); the rest is
unevaluated. ``footfall.session.scratch`` deletes such tables at the end of a block.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions.calendar import AsOf, within
from footfall.operators import anomaly, daily, experiments, mart, retention
from footfall.session import materialise
from footfall.sources.logs import activity
from footfall.sources.mart_sink import write_mart

RETENTION_DAYS = 21


def user_days(
    feed: DataFrame, messages: DataFrame, first: date | None = None, last: date | None = None
) -> DataFrame:
    """Mart metrics per user and day, for a range of days or the whole logs."""
    end = None if last is None else last + timedelta(days=1)
    feed, messages = within(feed, first, end), within(messages, first, end)
    return mart.user_day(mart.feed_user_day(feed), mart.message_user_day(messages))


def mart_job(feed: DataFrame, messages: DataFrame, as_of: AsOf, path: str) -> None:
    """Compute yesterday's mart and store it; running it again changes nothing."""
    day = as_of.yesterday
    write_mart(mart.daily_mart(user_days(feed, messages, day, day)), path, days=[day])


def feed_report(feed: DataFrame, as_of: AsOf) -> dict[str, DataFrame]:
    """Text for yesterday and the table behind the seven-day chart."""
    yesterday = daily.feed_daily(feed, as_of.yesterday, as_of.yesterday, digits=2)
    week = daily.feed_daily(feed, as_of.days_ago(7), as_of.yesterday, digits=4)
    return {"text": daily.feed_report(yesterday), "week": week.orderBy("date")}


def app_report(
    feed: DataFrame, messages: DataFrame, as_of: AsOf, history_start: date
) -> dict[str, DataFrame]:
    """Text for yesterday and the tables behind the six charts.

    ``history_start`` is the first day of the weekly audience chart. Both logs are read
    once, into a table of user-days in the scratch folder that all parts are read from.
    """
    days = materialise(daily.user_activity(activity(feed, messages)), "user-days")
    in_feed, in_messenger = days.where("feed_actions > 0"), days.where("messages > 0")
    yesterday, since = as_of.yesterday, as_of.days_ago(RETENTION_DAYS)
    week_ago, today = as_of.days_ago(7), as_of.today
    dates = [since + timedelta(days=i) for i in range(RETENTION_DAYS + 1)]

    def between(first: date, last: date) -> DataFrame:
        return days.where(F.col("date").between(F.lit(first), F.lit(last)))

    def cohorts(log: DataFrame) -> DataFrame:
        return retention.cohort_matrix(retention.cohort_retention(log, since, today), dates)

    def weeks(log: DataFrame) -> DataFrame:
        return retention.status_matrix(retention.weekly_audience(log, history_start, today))

    def long(table: DataFrame) -> DataFrame:
        return daily.melt_metrics(table, ["date"])

    one, week = between(yesterday, yesterday), between(week_ago, today)
    return {
        "text": daily.app_report(daily.dau_of_days(one), daily.totals_of_days(one)),
        "dau": long(daily.dau_of_days(week)),
        "actions_per_user": long(daily.per_user_of_days(week)),
        "retention_feed": cohorts(in_feed),
        "retention_messenger": cohorts(in_messenger),
        "weekly_audience_feed": weeks(in_feed),
        "weekly_audience_messenger": weeks(in_messenger),
    }


def alert_job(feed: DataFrame, messages: DataFrame, as_of: AsOf) -> DataFrame:
    """Messages for the metrics whose newest closed slot is out of bounds."""
    slots = anomaly.quarter_hour_metrics(activity(feed, messages), as_of)
    bands = anomaly.iqr_bands(anomaly.metric_series(slots))
    return anomaly.alert_messages(anomaly.latest_alerts(bands))


def experiment_report(
    feed: DataFrame, first: date, last: date, test: int, control: int, buckets: int = 50
) -> DataFrame:
    """Every test of one experiment side by side: statistic and p per method.

    The per-user table is written once and read by all tests.
    """
    users = materialise(
        experiments.user_ctr(feed, first, last, [control, test]), "experiment-users"
    )
    smoothed = experiments.smoothed_ctr(users, [control, test])
    bucketed = materialise(experiments.bucketize(users, buckets), "experiment-buckets")
    rows = []
    for name, table, metric in [
        ("ctr", users, "ctr"),
        ("smoothed_ctr", smoothed, "smoothed_ctr"),
        ("bucket_ctr", bucketed, "bucket_ctr"),
    ]:
        rows.append(_row(name, "welch", "t", experiments.welch(table, metric, test, control)))
        rows.append(
            _row(name, "mann_whitney", "u", experiments.mann_whitney(table, metric, test, control))
        )
    rows.append(
        _row("bucket_q90", "mann_whitney", "u",
             experiments.mann_whitney(bucketed, "ctr9", test, control))
    )
    linear = experiments.welch_linearized(users, [(control, test)])
    rows.append(_row("linearized_likes", "welch", "t", linear))
    report = rows[0]
    for row in rows[1:]:
        report = report.unionByName(row)
    return report


def _row(metric: str, method: str, statistic: str, result: DataFrame) -> DataFrame:
    return result.select(
        F.lit(metric).alias("metric"),
        F.lit(method).alias("method"),
        F.col(statistic).cast("double").alias("statistic"),
        "p_value",
    )
