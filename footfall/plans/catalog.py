"""Named queries over a folder of the provided tables.

Each query reads the whole event table through the adapter, applies operators with
fixed parameters and returns a DataFrame in a form that two engines print alike:
doubles rounded to six digits, dates and timestamps as text.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.functions.calendar import AsOf, within_days
from footfall.operators import (
    anomaly, daily, experiments, mart, posts, resampling, retention, series, sketches, user_state,
)
from footfall.operators.ranks import histogram
from footfall.plans import reports
from footfall.session import materialise, scratch_path
from footfall.sources.adapter import load_feed, load_messages
from footfall.sources.logs import activity, feed_actions, message_actions, peek, write_log
from footfall.sources.mart_sink import read_mart, write_mart
from footfall.streaming import quarter_hour as live

AS_OF = AsOf(datetime(2024, 1, 31))
ALERT_AS_OF = AsOf(datetime(2024, 1, 30, 23, 50))
SINCE = AS_OF.days_ago(reports.RETENTION_DAYS)
FIRST_DAY = date(2024, 1, 1)  # of the weekly audience report's range
LOG_DAY = "day"
STATE_HORIZON = user_state.Horizon(FIRST_DAY, 93)
STATE_BUCKETS = 8
AA_WEEK = (date(2024, 1, 8), date(2024, 1, 14))
AB_WEEK = (date(2024, 1, 15), date(2024, 1, 21))
DROP_DAY = date(2024, 1, 20)
PAIRS = [(0, 3), (1, 2)]
ALL_GROUPS = [0, 1, 2, 3]
SLICES = ["os", "gender", "age", "country", "city", "source"]
BUCKETS = 50
AA_ITERATIONS = 10_000
#: A group with fewer users is not sampled and has its size and null statistics in every row.
AA_SAMPLE, AA_SMALL_SAMPLE = 500, 3
AA_SEED = 11
BOOTSTRAP_SEED = 23
REPLICATES = 2_000
BINS = 20
QQ_PROBS = [i / 20 for i in range(1, 20)]
DAY_TOLERANCE = 0.3

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def comparable(df: DataFrame) -> DataFrame:
    columns = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            rounded = F.round(column.cast("double"), 6)
            column = F.when(rounded == 0, F.lit(0.0)).otherwise(rounded)  # no negative zero
        elif isinstance(field.dataType, (T.DateType, T.TimestampNTZType, T.TimestampType)):
            column = column.cast("string")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def query(function: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return comparable(function(spark, folder))

    QUERIES[function.__name__] = run
    return function


def _activity(spark: SparkSession, folder: str, located: bool = False) -> DataFrame:
    return activity(load_feed(spark, folder, located), load_messages(spark, folder, located))


# --- sources ---------------------------------------------------------------


@query
def feed_peek(spark, folder):
    columns = ["time", "user_id", "post_id", "action"]
    return peek(load_feed(spark, folder, located=True), 5, order=columns)


@query
def activity_union(spark, folder):
    return _activity(spark, folder, located=True)


@query
def mart_roundtrip(spark, folder):
    path = scratch_path(spark, "mart")
    feed, messages = load_feed(spark, folder), load_messages(spark, folder)
    write_mart(mart.daily_mart(_all_user_days(spark, folder)), path)
    reports.mart_job(feed, messages, AS_OF, path)  # a retried day must not count twice
    return read_mart(spark, path)


# --- daily metrics ---------------------------------------------------------


@query
def feed_yesterday(spark, folder):
    return daily.feed_daily(load_feed(spark, folder), AS_OF.yesterday, AS_OF.yesterday, 2)


@query
def feed_last7(spark, folder):
    return reports.feed_report(load_feed(spark, folder), AS_OF)["week"]


@query
def feed_last7_log(spark, folder):
    """The same table from a stored log, of which eight day folders are read."""
    path, _ = _logs(spark, folder)
    feed = feed_actions(spark, path, AS_OF.days_ago(7), AS_OF.today, day_column=LOG_DAY)
    return reports.feed_report(feed, AS_OF)["week"]


@query
def app_dau_yesterday(spark, folder):
    return daily.app_dau(_activity(spark, folder), AS_OF.yesterday, AS_OF.yesterday)


@query
def app_dau_week(spark, folder):
    return daily.app_dau(_activity(spark, folder), AS_OF.days_ago(7), AS_OF.today)


@query
def app_dau_week_log(spark, folder):
    first, last = AS_OF.days_ago(7), AS_OF.today
    feed, messages = _stored_logs(spark, folder, first, last + timedelta(days=1))
    return daily.app_dau(activity(feed, messages), first, last)


@query
def app_dau_long(spark, folder):
    return daily.melt_metrics(app_dau_week(spark, folder), ["date"])


@query
def action_totals(spark, folder):
    return daily.action_totals(_activity(spark, folder), AS_OF.yesterday, AS_OF.yesterday)


@query
def actions_per_user(spark, folder):
    return daily.actions_per_user(_activity(spark, folder), AS_OF.days_ago(7), AS_OF.today)


@query
def audience_overlap(spark, folder):
    return daily.audience_overlap(_activity(spark, folder))


@query
def audience_overlap_total(spark, folder):
    return daily.audience_overlap(_activity(spark, folder), "all")


@query
def feed_by_slice(spark, folder):
    return daily.feed_by_slice(load_feed(spark, folder, located=True), SLICES)


def _stored_logs(spark, folder, start=None, end=None):
    feed, messages = _logs(spark, folder)
    return (
        feed_actions(spark, feed, start, end, day_column=LOG_DAY),
        message_actions(spark, messages, start, end, day_column=LOG_DAY),
    )


@query
def feed_today(spark, folder):
    return daily.feed_today(load_feed(spark, folder), ALERT_AS_OF)


@query
def feed_report(spark, folder):
    return reports.feed_report(load_feed(spark, folder), AS_OF)["text"]


def _app_report(spark, folder, table):
    feed, messages = load_feed(spark, folder), load_messages(spark, folder)
    return reports.app_report(feed, messages, AS_OF, FIRST_DAY)[table]


@query
def app_report(spark, folder):
    return _app_report(spark, folder, "text")


@query
def app_report_dau(spark, folder):
    return _app_report(spark, folder, "dau")


@query
def app_report_actions_per_user(spark, folder):
    return _app_report(spark, folder, "actions_per_user")


@query
def app_report_retention_feed(spark, folder):
    return _app_report(spark, folder, "retention_feed")


@query
def app_report_retention_messenger(spark, folder):
    return _app_report(spark, folder, "retention_messenger")


@query
def app_report_weekly_feed(spark, folder):
    return _app_report(spark, folder, "weekly_audience_feed")


@query
def app_report_weekly_messenger(spark, folder):
    return _app_report(spark, folder, "weekly_audience_messenger")


@query
def feed_dau(spark, folder):
    return daily.dau(load_feed(spark, folder))


@query
def posts_viewed_daily(spark, folder):
    return daily.posts_viewed_daily(load_feed(spark, folder))


# --- retention and audience ------------------------------------------------


@query
def first_seen(spark, folder):
    return retention.first_seen(load_feed(spark, folder), SINCE)


@query
def retention_feed(spark, folder):
    return retention.cohort_retention(load_feed(spark, folder), SINCE, AS_OF.today)


@query
def retention_messenger(spark, folder):
    return retention.cohort_retention(load_messages(spark, folder), SINCE, AS_OF.today)


@query
def retention_matrix(spark, folder):
    dates = [SINCE + timedelta(days=i) for i in range(reports.RETENTION_DAYS + 1)]
    return retention.cohort_matrix(retention_feed(spark, folder), dates)


@query
def retention_by_source(spark, folder):
    return retention.retention_by(load_feed(spark, folder), "source", SINCE, AS_OF.today)


@query
def retention_mean(spark, folder):
    return retention.retention_mean(retention_by_source(spark, folder), "source")


@query
def campaign_cohort(spark, folder):
    return retention.new_user_return(load_feed(spark, folder))


@query
def dau_change_by_dim(spark, folder):
    feed = load_feed(spark, folder, located=True)
    return retention.dau_change_by(feed, DROP_DAY, ["country", "city", "os", "gender", "source"])


@query
def weekly_audience_feed(spark, folder):
    return retention.weekly_audience(load_feed(spark, folder), FIRST_DAY, AS_OF.today)


@query
def weekly_audience_messenger(spark, folder):
    return retention.weekly_audience(load_messages(spark, folder), FIRST_DAY, AS_OF.today)


@query
def weekly_matrix(spark, folder):
    return retention.status_matrix(weekly_audience_feed(spark, folder))


# --- the same from a state of users, of which a run reads one day more ------


def _feed_state(spark, folder):
    """The history up to three days ago at once, then day by day; the last day is run twice."""
    path = scratch_path(spark, "feed-log")
    write_log(load_feed(spark, folder), path)

    def log(first, last):
        return feed_actions(spark, path, first, last + timedelta(days=1), day_column=LOG_DAY)

    store = user_state.StateStore(spark, scratch_path(spark, "user-state"), STATE_HORIZON, STATE_BUCKETS)
    store.merge(log(FIRST_DAY, AS_OF.days_ago(3)))
    store.merge_days(lambda day: log(day, day), AS_OF.days_ago(2), AS_OF.today)
    store.merge(log(AS_OF.today, AS_OF.today))
    return store.read()


@query
def state_first_seen(spark, folder):
    return user_state.state_first_seen(_feed_state(spark, folder), SINCE)


@query
def state_retention(spark, folder):
    return user_state.state_retention(_feed_state(spark, folder), STATE_HORIZON, SINCE, AS_OF.today)


@query
def state_weekly_audience(spark, folder):
    return user_state.state_weekly_audience(_feed_state(spark, folder), STATE_HORIZON, FIRST_DAY, AS_OF.today)


@query
def state_campaign_cohort(spark, folder):
    return user_state.state_new_user_return(_feed_state(spark, folder), STATE_HORIZON)


@query
def state_dau(spark, folder):
    return user_state.state_dau(_feed_state(spark, folder), STATE_HORIZON, FIRST_DAY, AS_OF.today)


# --- the same from sketches of days --------------------------------------------


def _audience_days(spark, folder):
    path = scratch_path(spark, "audience-days")
    sketches.write_days(sketches.audience_days(_activity(spark, folder)), path)
    return sketches.read_days(spark, path, sketches.AUDIENCE, FIRST_DAY, AS_OF.today)


@query
def uniq_week_check(spark, folder):
    """Users of every cut over seven days, and whether a union of stored sketches has them within 3 %."""
    feed, path = load_feed(spark, folder, located=True), scratch_path(spark, "user-cube")
    sketches.write_days(sketches.user_cube(feed, SLICES), path)
    week = sketches.read_days(spark, path, sketches.CUBE, AS_OF.days_ago(7), AS_OF.yesterday)
    keys = ["dimension", "dimension_value"]
    estimated = sketches.cube_users(week).select(*keys, F.col("users").alias("estimate"), F.lit(0).alias("exact"))
    users = sketches.cut_rows(within_days(feed, AS_OF.days_ago(7), AS_OF.yesterday), SLICES)
    exact = users.groupBy(*keys).agg(F.lit(0).alias("estimate"), F.count_distinct("user_id").alias("exact"))
    both = estimated.unionByName(exact)
    summed = both.groupBy(*keys).agg(F.sum("exact").alias("users"), F.sum("estimate").alias("estimate"))
    near = F.abs(F.col("estimate") - F.col("users")) <= 0.03 * F.col("users")
    return summed.select(*keys, "users", near.alias("estimate_is_near"))


@query
def audience_overlap_sketch(spark, folder):
    return sketches.overlap(_audience_days(spark, folder))


@query
def audience_overlap_total_sketch(spark, folder):
    return sketches.overlap(_audience_days(spark, folder), "all")


@query
def weekly_audience_feed_sketch(spark, folder):
    return sketches.weekly_audience(_audience_days(spark, folder), "feed", FIRST_DAY, AS_OF.today)


@query
def weekly_audience_messenger_sketch(spark, folder):
    return sketches.weekly_audience(_audience_days(spark, folder), "messenger", FIRST_DAY, AS_OF.today)


# --- daily mart ------------------------------------------------------------


@query
def feed_user_day(spark, folder):
    return mart.feed_user_day(load_feed(spark, folder))


@query
def sent_user_day(spark, folder):
    return mart.sent_user_day(load_messages(spark, folder))


@query
def received_user_day(spark, folder):
    return mart.received_user_day(load_messages(spark, folder))


@query
def messenger_user_day(spark, folder):
    return mart.messenger_user_day(sent_user_day(spark, folder), received_user_day(spark, folder))


@query
def user_day(spark, folder):
    return mart.user_day(feed_user_day(spark, folder), messenger_user_day(spark, folder))


def _all_user_days(spark, folder):
    feed, messages = load_feed(spark, folder), load_messages(spark, folder)
    return reports.user_days(feed, messages)


@query
def mart_gender(spark, folder):
    return mart.mart_cut(_all_user_days(spark, folder), "gender")


@query
def mart_age(spark, folder):
    return mart.mart_cut(_all_user_days(spark, folder), "age")


@query
def mart_os(spark, folder):
    return mart.mart_cut(_all_user_days(spark, folder), "os")


@query
def daily_mart(spark, folder):
    return mart.daily_mart(_all_user_days(spark, folder))


@query
def daily_mart_log(spark, folder):
    feed, messages = _stored_logs(spark, folder)
    return mart.daily_mart(reports.user_days(feed, messages))


# --- experiments -----------------------------------------------------------


def _ab_users(spark, folder, groups=(1, 2)):
    return experiments.user_ctr(load_feed(spark, folder), *AB_WEEK, list(groups))


def _aa_users(spark, folder):
    return experiments.user_ctr(load_feed(spark, folder), *AA_WEEK, [2, 3])


def _buckets(spark, folder):
    return experiments.bucketize(_ab_users(spark, folder), BUCKETS)


def _aa_tests(spark, folder, n=AA_SAMPLE):
    return resampling.aa_simulation(_aa_users(spark, folder), 2, 3, AA_ITERATIONS, n, AA_SEED)


@query
def split_balance(spark, folder):
    users = load_feed(spark, folder).select("user_id").distinct()
    return experiments.assign_group(users, "split", 4).groupBy("split_group").agg(
        F.count("*").alias("users")
    )


@query
def user_ctr(spark, folder):
    return _ab_users(spark, folder, ALL_GROUPS)


@query
def group_sizes(spark, folder):
    return experiments.group_sizes(_aa_users(spark, folder))


@query
def welch_ctr(spark, folder):
    return experiments.welch(_ab_users(spark, folder), "ctr", 2, 1)


@query
def mwu_ctr(spark, folder):
    return experiments.mann_whitney(_ab_users(spark, folder), "ctr", 2, 1)


@query
def aa_stats(spark, folder):
    return _aa_tests(spark, folder).select("iteration", "n_a", "n_b", "mean_a", "mean_b", "t", "dof")


@query
def aa_stats_spread(spark, folder):
    """The same with a smaller sample."""
    tests = _aa_tests(spark, folder, AA_SMALL_SAMPLE)
    return tests.select("iteration", "n_a", "n_b", "mean_a", "mean_b", "t", "dof")


@query
def aa_pvalues(spark, folder):
    return _aa_tests(spark, folder).select("iteration", "p_value")


@query
def aa_fpr(spark, folder):
    return resampling.false_positive_rate(_aa_tests(spark, folder))


def _histograms(df, columns, by=()):
    """One histogram per column, each over its own range."""
    parts = [
        histogram(df, c, BINS, list(by)).select(F.lit(c).alias("variable"), "*") for c in columns
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def ctr_histogram(spark, folder):
    return histogram(_ab_users(spark, folder), "ctr", BINS, ["exp_group"])


@query
def linearized_histogram(spark, folder):
    users = experiments.linearized(_ab_users(spark, folder, ALL_GROUPS), PAIRS)
    return histogram(
        experiments.pick_groups(users, [0, 3]), "linearized_likes", BINS, ["exp_group"]
    )


@query
def smoothed_histogram(spark, folder):
    return histogram(smoothed_ctr(spark, folder), "smoothed_ctr", BINS, ["exp_group"])


@query
def pvalue_histogram(spark, folder):
    return histogram(materialise(aa_pvalues(spark, folder), "p-values"), "p_value", BINS)


@query
def bootstrap_histogram(spark, folder):
    replicates = materialise(bucket_bootstrap(spark, folder), "replicates")
    return histogram(replicates, "replicate_ctr", BINS, ["exp_group"])


@query
def bucket_histograms(spark, folder):
    buckets = materialise(_buckets(spark, folder), "buckets")
    return _histograms(buckets, ["bucket_ctr", "ctr9"], ["exp_group"])


@query
def smoothed_ctr(spark, folder):
    return experiments.smoothed_ctr(_ab_users(spark, folder), [1, 2])


@query
def welch_smoothed(spark, folder):
    return experiments.welch(smoothed_ctr(spark, folder), "smoothed_ctr", 2, 1)


@query
def mwu_smoothed(spark, folder):
    return experiments.mann_whitney(smoothed_ctr(spark, folder), "smoothed_ctr", 2, 1)


@query
def poisson_bootstrap(spark, folder):
    return resampling.poisson_bootstrap(_ab_users(spark, folder), REPLICATES, BOOTSTRAP_SEED)


@query
def poisson_bootstrap_pooled(spark, folder):
    return resampling.pooled_bootstrap(_ab_users(spark, folder), REPLICATES, BOOTSTRAP_SEED)


@query
def bucket_bootstrap(spark, folder):
    users = _ab_users(spark, folder)
    return resampling.bucket_bootstrap(users, BUCKETS, REPLICATES, BOOTSTRAP_SEED)


@query
def bootstrap_diff(spark, folder):
    return resampling.bootstrap_diff(bucket_bootstrap(spark, folder), 2, 1)


@query
def bucket_ctr(spark, folder):
    return _buckets(spark, folder)


@query
def mwu_bucket(spark, folder):
    return experiments.mann_whitney(_buckets(spark, folder), "bucket_ctr", 1, 2)


@query
def welch_bucket(spark, folder):
    return experiments.welch(_buckets(spark, folder), "bucket_ctr", 1, 2)


@query
def mwu_bucket_q90(spark, folder):
    return experiments.mann_whitney(_buckets(spark, folder), "ctr9", 1, 2)


@query
def overall_ctr(spark, folder):
    controls = [control for control, _ in PAIRS]
    return experiments.overall_ctr(_ab_users(spark, folder, ALL_GROUPS), controls)


@query
def linearized_likes(spark, folder):
    return experiments.linearized(_ab_users(spark, folder, ALL_GROUPS), PAIRS)


@query
def welch_linearized(spark, folder):
    return experiments.welch_linearized(_ab_users(spark, folder, ALL_GROUPS), PAIRS)


@query
def experiment_report(spark, folder):
    return reports.experiment_report(load_feed(spark, folder), *AB_WEEK, 2, 1, BUCKETS)


# --- anomalies -------------------------------------------------------------


@query
def quarter_hour(spark, folder):
    return anomaly.quarter_hour_metrics(_activity(spark, folder), ALERT_AS_OF).orderBy("ts")


@query
def quarter_hour_filled(spark, folder):
    slots = anomaly.quarter_hour_metrics(_activity(spark, folder), ALERT_AS_OF, fill_gaps=True)
    return slots.orderBy("ts")


def _series(spark, folder):
    return anomaly.metric_series(
        anomaly.quarter_hour_metrics(_activity(spark, folder), ALERT_AS_OF)
    )


@query
def iqr_bands(spark, folder):
    return anomaly.iqr_bands(_series(spark, folder))


@query
def latest_alerts(spark, folder):
    return anomaly.latest_alerts(iqr_bands(spark, folder))


@query
def alert_messages(spark, folder):
    feed, messages = load_feed(spark, folder), load_messages(spark, folder)
    return reports.alert_job(feed, messages, ALERT_AS_OF)


@query
def day_over_day(spark, folder):
    return anomaly.day_over_day(_series(spark, folder), DAY_TOLERANCE)


@query
def band_breaks(spark, folder):
    """Every break over the whole history, each point judged as the newest one."""
    slots = anomaly.slot_metrics(_activity(spark, folder))
    return anomaly.band_breaks(anomaly.iqr_bands(anomaly.metric_series(slots), live=True))


def _logs(spark, folder):
    """Folders of both logs, written by day from the event table."""
    paths = scratch_path(spark, "feed-log"), scratch_path(spark, "message-log")
    write_log(load_feed(spark, folder), paths[0])
    write_log(load_messages(spark, folder), paths[1])
    return paths


def _run_stream(spark, folder):
    target = scratch_path(spark, "stream")
    slots = live.stream_slots(live.stream_logs(spark, *_logs(spark, folder)))
    live.run_slots(slots, target, trigger={"availableNow": True}).awaitTermination()
    return target


@query
def stream_quarter_hour(spark, folder):
    return live.read_slots(spark, _run_stream(spark, folder))


@query
def stream_alerts(spark, folder):
    return live.read_alerts(spark, _run_stream(spark, folder))


# --- posts and series ------------------------------------------------------


@query
def post_actions(spark, folder):
    return posts.post_actions(load_feed(spark, folder))


@query
def post_describe(spark, folder):
    return posts.describe(post_actions(spark, folder), ["like", "view"])


@query
def post_skew(spark, folder):
    with_ctr = posts.post_ctr(post_actions(spark, folder))
    return posts.shape(with_ctr, ["like", "view", "ctr"])


@query
def post_histograms(spark, folder):
    with_ctr = materialise(posts.post_ctr(post_actions(spark, folder)), "posts")
    return _histograms(with_ctr, ["like", "view", "ctr"])


@query
def post_zscore(spark, folder):
    return posts.zscore(post_actions(spark, folder), ["like", "view"])


@query
def qq_like_view(spark, folder):
    return posts.qq_table(post_zscore(spark, folder), "like", "view", QQ_PROBS)


@query
def post_stats(spark, folder):
    return posts.post_stats(load_feed(spark, folder))


@query
def mean_lifetime(spark, folder):
    return posts.mean_lifetime(post_stats(spark, folder))


@query
def post_corr(spark, folder):
    return posts.corr_matrix(post_stats(spark, folder), ["likes", "views", "ctr", "life_time"])


@query
def hourly_actions(spark, folder):
    return series.hourly(load_feed(spark, folder)).select("day_h", "actions").orderBy("day_h")


@query
def stl_hourly(spark, folder):
    return series.decompose(series.hourly(load_feed(spark, folder)))


@query
def stl_hourly_by_os(spark, folder):
    return series.decompose(series.hourly(load_feed(spark, folder), "os"))


@query
def classical_hourly(spark, folder):
    return series.classical_decompose(series.hourly(load_feed(spark, folder)))


@query
def actions_by_hour(spark, folder):
    return series.by_hour(load_feed(spark, folder))


@query
def posts_by_hour(spark, folder):
    return series.published_by_hour(load_feed(spark, folder))


@query
def hour_profiles(spark, folder):
    return series.hour_profiles(load_feed(spark, folder))
