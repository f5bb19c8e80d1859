"""Daily product metrics, audience overlap and report texts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions.calendar import AsOf, day, slot, within, within_days
from footfall.functions.ratios import likes, messages, ratio, views


def feed_daily(
    feed: DataFrame, first: date | None = None, last: date | None = None, digits: int | None = None
) -> DataFrame:
    """Users, views, likes and CTR of the feed for each day."""
    if first is not None and last is not None:
        feed = within_days(feed, first, last)
    daily = feed.groupBy(day().alias("date")).agg(
        F.count_distinct("user_id").alias("dau"), views().alias("views"), likes().alias("likes")
    )
    ctr = ratio(F.col("likes"), F.col("views"))
    return daily.withColumn("ctr", ctr if digits is None else F.round(ctr, digits))


def dau(feed: DataFrame, approx: bool = False) -> DataFrame:
    """Daily users over the whole history, exact or estimated (HyperLogLog++, 5 % by default)."""
    users = F.approx_count_distinct("user_id") if approx else F.count_distinct("user_id")
    return feed.groupBy(day().alias("date")).agg(users.alias("dau"))


def posts_viewed_daily(feed: DataFrame) -> DataFrame:
    """Distinct posts viewed per day, largest first."""
    return (
        feed.where(F.col("action") == "view")
        .groupBy(day().alias("date"))
        .agg(F.count_distinct("post_id").alias("posts"))
        .orderBy(F.desc("posts"), "date")
    )


def feed_by_slice(feed: DataFrame, dims: list[str]) -> DataFrame:
    """Daily feed metrics cut by each dimension in turn, in long form."""
    combined = feed.groupBy(day().alias("date"), "user_id", *dims).agg(
        views().alias("views"), likes().alias("likes")
    )
    counted = count_by_value(
        combined.withColumn("dau", F.lit(1)), ["date"], dims, ["dau"], ["views", "likes"]
    )
    return counted.withColumn("ctr", ratio(F.col("likes"), F.col("views")))


def count_by_value(
    combined: DataFrame, keys: list[str], dims: list[str], flags: list[str], counts: list[str]
) -> DataFrame:
    """Per value of each dimension: users with each 0/1 flag set, and sums of the counts.

    Takes rows already reduced to keys, user and all dimensions. A user with one such
    row (nearly all of them) needs no further distinct and is summed straight into the
    few result groups; only users whose dimensions changed are kept apart by id.
    """
    rows_of_user = F.count("*").over(Window.partitionBy(*keys, "user_id"))
    apart = "_user"
    ids = [*keys, apart, *flags, *counts]
    long = (
        combined.withColumn(apart, F.when(rows_of_user > 1, F.col("user_id")))
        .select(*ids, *[F.col(d).cast("string").alias(d) for d in dims])
        .unpivot(ids, dims, "dimension", "dimension_value")
    )
    groups = [*keys, "dimension", "dimension_value"]
    merged = long.groupBy(*groups, apart).agg(
        *[F.sum(c).alias(c) for c in [*flags, *counts]]
    )
    once = [
        F.when(F.col(apart).isNull(), F.col(f)).otherwise(F.least(F.col(f), F.lit(1))).alias(f)
        for f in flags
    ]
    return (
        merged.select(*groups, *once, *counts)
        .groupBy(*groups)
        .agg(*[F.sum(c).alias(c) for c in [*flags, *counts]])
    )


def user_days(activity: DataFrame, by_day: bool = True) -> DataFrame:
    """One row per user (and day) with a flag for each service used."""
    keys = [day().alias("date"), F.col("user_id")] if by_day else [F.col("user_id")]
    sent = F.col("action") == "message"
    return activity.groupBy(*keys).agg(
        F.bool_or(~sent).alias("in_feed"), F.bool_or(sent).alias("in_messenger")
    )


def user_activity(activity: DataFrame) -> DataFrame:
    """Counts per user and day over both services: the one input of the app report.

    ``time`` is the day's midnight, so that operators over logs take this table too.
    """
    sent = F.col("action") == "message"
    per_day = activity.groupBy("user_id", day().alias("date")).agg(
        likes().alias("likes"),
        views().alias("views"),
        messages().alias("messages"),
        F.count_if(~sent).alias("feed_actions"),
    )
    return per_day.withColumn("time", F.col("date").cast("timestamp_ntz"))


def dau_of_days(days: DataFrame) -> DataFrame:
    """``app_dau`` from user-days."""
    return days.groupBy("date").agg(
        F.count("*").alias("dau_app"),
        F.count_if(F.col("messages") > 0).alias("dau_messenger"),
        F.count_if(F.col("feed_actions") > 0).alias("dau_feed"),
    )


def totals_of_days(days: DataFrame) -> DataFrame:
    """``action_totals`` from user-days."""
    return days.groupBy("date").agg(*[F.sum(c).alias(c) for c in ("likes", "views", "messages")])


def per_user_of_days(days: DataFrame) -> DataFrame:
    """``actions_per_user`` from user-days."""
    return days.groupBy("date").agg(
        *[
            ratio(F.sum(c), F.count_if(F.col(c) > 0)).alias(f"{c}_per_user")
            for c in ("likes", "views", "messages")
        ]
    )


def app_dau(activity: DataFrame, first: date, last: date, approx: bool = False) -> DataFrame:
    """Daily users of the app, the messenger and the feed, from one pass over both logs.

    ``approx`` estimates them without a shuffle of users.
    """
    if approx:
        user, sent = F.col("user_id"), F.col("action") == "message"
        return within_days(activity, first, last).groupBy(day().alias("date")).agg(
            F.approx_count_distinct(user).alias("dau_app"),
            F.approx_count_distinct(F.when(sent, user)).alias("dau_messenger"),
            F.approx_count_distinct(F.when(~sent, user)).alias("dau_feed"),
        )
    return (
        user_days(within_days(activity, first, last))
        .groupBy("date")
        .agg(
            F.count("*").alias("dau_app"),
            F.count_if("in_messenger").alias("dau_messenger"),
            F.count_if("in_feed").alias("dau_feed"),
        )
    )


def audience_overlap(activity: DataFrame, period: str = "day") -> DataFrame:
    """Users of both services, of the feed only and of the messenger only.

    ``period='day'`` counts per day, ``period='all'`` over the whole history.
    """
    if period not in ("day", "all"):
        raise ValueError("period must be 'day' or 'all'")
    segment = (
        F.when(F.col("in_feed") & F.col("in_messenger"), "both")
        .when(F.col("in_feed"), "feed_only")
        .otherwise("messenger_only")
        .alias("segment")
    )
    keys = [F.col("date"), segment] if period == "day" else [segment]
    return user_days(activity, period == "day").groupBy(*keys).agg(F.count("*").alias("users"))


def action_totals(activity: DataFrame, first: date, last: date) -> DataFrame:
    """Likes, views and messages per day."""
    return (
        within_days(activity, first, last)
        .groupBy(day().alias("date"))
        .agg(likes().alias("likes"), views().alias("views"), messages().alias("messages"))
    )


def actions_per_user(activity: DataFrame, first: date, last: date) -> DataFrame:
    """Each action's count per user who did it, by day."""
    per_user = (
        within_days(activity, first, last)
        .groupBy(day().alias("date"), "user_id")
        .agg(likes().alias("likes"), views().alias("views"), messages().alias("messages"))
    )
    return per_user.groupBy("date").agg(
        *[
            ratio(F.sum(name), F.count_if(F.col(name) > 0)).alias(f"{name}_per_user")
            for name in ("likes", "views", "messages")
        ]
    )


def feed_today(feed: DataFrame, as_of: AsOf) -> DataFrame:
    """Feed metrics of the current day by quarter hour, up to the moment of the report."""
    return (
        within(feed, as_of.today, as_of.now)
        .groupBy(slot().alias("ts"))
        .agg(
            F.count_distinct("user_id").alias("users"),
            views().alias("views"),
            likes().alias("likes"),
        )
        .withColumn("ctr", ratio(F.col("likes"), F.col("views")))
        .orderBy("ts")
    )


def melt_metrics(df: DataFrame, ids: list[str]) -> DataFrame:
    """Wide metrics to ``(ids, variable, value)``, as a multi-line chart wants them."""
    columns = [c for c in df.columns if c not in ids]
    return df.select(*ids, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        ids, columns, "variable", "value"
    )


def _lines(heading: str, pairs: list[tuple[str, str]]) -> list:
    parts = [F.lit(heading)]
    for label, column in pairs:
        parts += [F.lit(f"\n{label} = "), F.coalesce(F.col(column).cast("string"), F.lit("n/a"))]
    return parts


def feed_report(daily: DataFrame) -> DataFrame:
    """One report text per day of ``feed_daily``."""
    body = _lines("", [("DAU", "dau"), ("views", "views"), ("likes", "likes")])
    text = F.concat(
        F.lit("Feed report for "),
        F.date_format("date", "yyyy-MM-dd"),
        F.lit(":"),
        *body,
        F.lit("\nCTR = "),
        F.when(F.col("ctr").isNull(), "n/a").otherwise(F.format_string("%.2f", "ctr")),
    )
    return daily.select("date", text.alias("text"))


def app_report(dau: DataFrame, totals: DataFrame) -> DataFrame:
    """One text per day over both services, from ``app_dau`` and ``action_totals``."""
    text = F.concat(
        F.lit("App report for "),
        F.date_format("date", "yyyy-MM-dd"),
        F.lit(".\n"),
        *_lines(
            "\nDAU:",
            [
                ("DAU_app", "dau_app"),
                ("DAU_messenger", "dau_messenger"),
                ("DAU_feed", "dau_feed"),
            ],
        ),
        *_lines(
            "\n\nUser activity:",
            [("likes", "likes"), ("views", "views"), ("messages", "messages")],
        ),
    )
    return dau.join(totals, "date").select("date", text.alias("text"))
