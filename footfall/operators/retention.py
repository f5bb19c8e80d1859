"""Cohorts, weekly audience and reasons for a move in daily users."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions.bitsets import collect_bits, has_bit, members, merge_bits
from footfall.functions.calendar import day, within, within_days
from footfall.functions.ratios import ratio
from footfall.operators.daily import count_by_value


def first_seen(log: DataFrame, since: date) -> DataFrame:
    """First active day per user, for users first seen on or after ``since``."""
    return (
        log.groupBy("user_id")
        .agg(F.min(day()).alias("start_date"))
        .where(F.col("start_date") >= F.lit(since))
    )


def _users_by_first(log: DataFrame, dim: str, parts: list, whole: list) -> DataFrame:
    """One row per user with the value ``dim`` had at the user's first action.

    ``parts`` aggregate per user and value, by hash; ``whole`` reduce those few rows once
    they lie together. Of several first actions at one time the smallest value counts.
    """
    per_value = log.groupBy("user_id", dim).agg(F.min("time").alias("_first"), *parts)
    first = F.min(F.struct("_first", dim)).getField(dim).alias(dim)
    return per_value.repartition("user_id").groupBy("user_id").agg(first, *whole)


def cohort_retention(
    log: DataFrame, since: date, until: date, by: str | None = None
) -> DataFrame:
    """Active users per cohort start day and day, for users first seen on or after ``since``.

    The first day comes from the whole history; active days are kept up to ``until``.
    ``by`` separates cohorts by a column's value at the user's first action. One shuffle
    moves one small row per user (and value).
    """
    size = (until - since).days + 1
    parts = [F.min(day()).alias("start_date"), *collect_bits(F.datediff(day(), F.lit(since)), size)]
    if by is None:
        users = log.groupBy("user_id").agg(*parts)
    else:
        users = _users_by_first(log, by, parts, [F.min("start_date").alias("start_date"), *merge_bits(size)])
    keys = [by] if by else []
    new = users.where(F.col("start_date") >= F.lit(since))
    return cohort_cells(new.select(*keys, "start_date", F.explode(members(size)).alias("offset")), since, keys)


def cohort_cells(active: DataFrame, origin: date, keys: list[str]) -> DataFrame:
    """Users per cohort and day, from a row per user and active day (``offset`` from ``origin``)."""
    return active.groupBy(
        *keys, "start_date", F.date_add(F.lit(origin), F.col("offset")).alias("date")
    ).agg(F.count("*").alias("active_users"))


def cohort_matrix(retention: DataFrame, dates: list[date]) -> DataFrame:
    """Cohorts as rows and the given days as columns, so the schema is fixed."""
    return (
        retention.withColumn("date", F.col("date").cast("string"))
        .groupBy("start_date")
        .pivot("date", [d.isoformat() for d in dates])
        .agg(F.first("active_users"))
        .orderBy("start_date")
    )


def retention_by(log: DataFrame, dim: str, since: date, until: date) -> DataFrame:
    """Cohort counts with day number, cohort size and rate for each value of ``dim``."""
    cells = cohort_retention(log, since, until, dim).withColumn(
        "day_number", F.datediff("date", "start_date")
    )
    # Every member of a cohort is active on day 0, so that cell is the cohort size.
    cohort = Window.partitionBy(dim, "start_date")
    size = F.max(F.when(F.col("day_number") == 0, F.col("active_users"))).over(cohort)
    return cells.withColumn("cohort_size", size).withColumn(
        "rate", ratio(F.col("active_users"), F.col("cohort_size"))
    )


def retention_mean(rates: DataFrame, dim: str) -> DataFrame:
    """Mean retention per value of ``dim`` and day number; NULL day number is the overall mean."""
    return rates.groupingSets(
        [[F.col(dim), F.col("day_number")], [F.col(dim)]], F.col(dim), F.col("day_number")
    ).agg(F.avg("rate").alias("mean_rate"), F.count("*").alias("cells"))


def new_user_return(log: DataFrame, dim: str = "source") -> DataFrame:
    """New users per day and first source, and how many of them came back the next day.

    The first even and the first odd day of a user are enough: the earlier one is
    the start, and the next day was active exactly if the other one is that day.
    """
    number = F.unix_date(day())
    parts = [
        F.min(F.when(number % 2 == 0, number)).alias("even"),
        F.min(F.when(number % 2 != 0, number)).alias("odd"),
    ]
    whole = [F.min(c).alias(c) for c in ("even", "odd")]
    return (
        _users_by_first(log, dim, parts, whole)
        .groupBy(F.date_from_unix_date(F.least("even", "odd")).alias("start_date"), dim)
        .agg(
            F.count("*").alias("new_users"),
            F.count_if(F.abs(F.col("even") - F.col("odd")) == 1).alias("returned_next_day"),
        )
        .withColumn("return_rate", ratio(F.col("returned_next_day"), F.col("new_users")))
    )


def dau_change_by(log: DataFrame, on: date, dims: list[str]) -> DataFrame:
    """Where a day's change in users came from.

    For each value of each dimension: users the day before, users on the day,
    the change, its share of the whole change, and its rank (largest drop first).
    """
    before = on - timedelta(days=1)
    rows = within_days(log, before, on).select(
        "user_id",
        F.lit("all").alias("all"),
        *[F.col(d).cast("string").alias(d) for d in dims],
        (day() == F.lit(before)).cast("int").alias("users_before"),
        (day() == F.lit(on)).cast("int").alias("users_on"),
    )
    flags = ["users_before", "users_on"]
    combined = rows.groupBy("user_id", "all", *dims).agg(*[F.max(f).alias(f) for f in flags])
    counts = count_by_value(combined, [], ["all", *dims], flags, []).withColumn(
        "change", F.col("users_on") - F.col("users_before")
    )
    # not a filter: that would be pushed down and cost a second scan
    total = counts.agg(F.max(F.when(F.col("dimension") == "all", F.col("change")))).scalar()
    largest_drop = Window.partitionBy("dimension").orderBy("change", "dimension_value")
    return (
        counts.withColumn("share_of_change", ratio(F.col("change"), total))
        .where(F.col("dimension") != "all")
        .withColumn("drop_rank", F.row_number().over(largest_drop))
    )


def weekly_audience(log: DataFrame, first: date, as_of: date) -> DataFrame:
    """New, retained and lost users per week from the week of ``first`` to that of ``as_of``.

    A user is new in a week if absent the week before, and lost in the week after
    the last of consecutive active weeks; lost users count negative. The week after
    ``as_of`` has not started and is left out. Each user occurs once per week and
    status, so counts need no distinct.
    """
    origin = first - timedelta(days=first.weekday())
    weeks = (as_of - origin).days // 7 + 1
    index = F.floor(F.datediff(day(), F.lit(origin)) / 7).cast("int")
    users = within(log, origin, None).groupBy("user_id").agg(*collect_bits(index, weeks))

    return audience_entries(users, members(weeks), lambda week: has_bit(week, weeks), origin, weeks)


def audience_entries(
    users: DataFrame, active: Column, is_active: Callable[[Column], Column], origin: date, weeks: int
) -> DataFrame:
    """New, retained and lost users per week, from a row per user with its ``active`` weeks."""

    def entry(week_number: Column, status: Column, sign: int) -> Column:
        return F.struct(
            F.date_add(F.lit(origin), (week_number * 7).cast("int")).alias("this_week"),
            status.alias("status"),
            F.lit(sign).alias("sign"),
        )

    def was_active(week_number: Column) -> Column:
        return F.coalesce((week_number >= 0) & is_active(week_number), F.lit(False))

    seen = F.transform(
        active,
        lambda w: entry(w, F.when(was_active(w - 1), "retained").otherwise("new"), 1),
    )
    left = F.transform(
        F.filter(active, lambda w: (w < weeks - 1) & ~was_active(w + 1)),
        lambda w: entry(w + 1, F.lit("lost"), -1),
    )
    return (
        users.select(F.explode(F.concat(seen, left)).alias("entry"))
        .select("entry.*")
        .groupBy("this_week", "status")
        .agg(F.sum("sign").alias("num_users"))
        .select(
            "this_week", F.date_sub("this_week", 7).alias("previous_week"), "status", "num_users"
        )
    )


def status_matrix(audience: DataFrame) -> DataFrame:
    """Weeks as rows (text, for chart labels) and statuses as columns."""
    return (
        audience.withColumn("this_week", F.col("this_week").cast("string"))
        .groupBy("this_week")
        .pivot("status", ["new", "retained", "lost"])
        .agg(F.first("num_users"))
        .orderBy("this_week")
    )
