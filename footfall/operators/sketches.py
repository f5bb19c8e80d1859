"""Distinct users and audience sets from sketches of days.

A sketch of a day is a few kilobytes whatever the number of users, is made without a shuffle of
users, and adds up: any range of days, or any group of cuts, is a union of stored rows. The exact
operators (``daily``, ``retention``) stay the reference; a sketch says what a year of days costs
too much to say exactly.

* ``user_cube`` counts: HyperLogLog, standard error about ``1.04 / sqrt(2**precision)``.
* ``audience_days`` keeps sets: theta sketches, exact up to ``2**precision`` users. Beyond that a
  size has a standard error of ``2**(-precision / 2)`` of the union of the sets it is made from, so
  a small difference of two large audiences is known only to that part of them.

A null user is nobody; a null dimension value is a value of its own; days without rows have no row,
and an empty log gives an empty table.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.functions.calendar import day

#: Logarithm of the size of a sketch: about 0.8 % either way.
PRECISION = 14

CUBE = "dimension string, dimension_value string, users binary, date date"
AUDIENCE = "feed binary, messenger binary, date date"


# --- distinct users by cut ---------------------------------------------------


def cut_rows(log: DataFrame, dims: Sequence[str]) -> DataFrame:
    """``date, dimension, dimension_value, user_id`` once per row and cut, the cut ``all`` first."""

    def cut(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("dimension"), value.cast("string").alias("dimension_value"))

    cuts = F.array(cut("all", F.lit("all")), *[cut(name, F.col(name)) for name in dims])
    return log.select(day().alias("date"), "user_id", F.explode(cuts).alias("cut")).select("date", "cut.*", "user_id")


def user_cube(log: DataFrame, dims: Sequence[str], precision: int = PRECISION) -> DataFrame:
    """A sketch of the users of every day and value of each dimension, from one pass over the log."""
    return (
        cut_rows(log, dims)
        .groupBy("date", "dimension", "dimension_value")
        .agg(F.hll_sketch_agg("user_id", precision).alias("users"))
    )


def cube_users(cube: DataFrame, keys: Sequence[str] = ("dimension", "dimension_value")) -> DataFrame:
    """Estimated distinct users per ``keys``, over whatever days and cuts ``cube`` holds."""
    return cube.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("users")).alias("users"))


# --- sets of users -------------------------------------------------------------


def audience_days(activity: DataFrame, precision: int = PRECISION) -> DataFrame:
    """The set of users of the feed and that of the messenger, for every day."""
    user, sent = F.col("user_id"), F.col("action") == "message"
    return activity.groupBy(day().alias("date")).agg(
        F.theta_sketch_agg(F.when(~sent, user), precision).alias("feed"),
        F.theta_sketch_agg(F.when(sent, user), precision).alias("messenger"),
    )


def overlap(days: DataFrame, period: str = "day", precision: int = PRECISION) -> DataFrame:
    """``audience_overlap`` from stored days; a segment without users has no row."""
    if period not in ("day", "all"):
        raise ValueError("period must be 'day' or 'all'")
    keys = ["date"] if period == "day" else []
    sets = days.groupBy(*keys).agg(*[F.theta_union_agg(c, precision).alias(c) for c in ("feed", "messenger")])
    segments = {
        "both": F.theta_intersection("feed", "messenger"),
        "feed_only": F.theta_difference("feed", "messenger"),
        "messenger_only": F.theta_difference("messenger", "feed"),
    }
    return _sizes(sets, keys, "segment", "users", {name: (1, found) for name, found in segments.items()})


def weekly_audience(
    days: DataFrame, service: str, first: date, as_of: date, precision: int = PRECISION
) -> DataFrame:
    """``retention.weekly_audience`` from stored days: new, retained and (negative) lost users.

    A week is the union of its days. Every week is also the previous one of the week after it, so the
    pairs of weeks come from one grouping without a join.
    """
    origin = first - timedelta(days=first.weekday())
    last = as_of - timedelta(days=as_of.weekday())
    week = F.date_sub("date", F.weekday("date")).alias("week")
    weeks = (
        days.where((F.col("date") >= F.lit(origin)) & (F.col("date") < F.lit(last + timedelta(days=7))))
        .groupBy(week)
        .agg(F.theta_union_agg(service, precision).alias("users"))
    )
    roles = F.array(
        F.struct(F.col("week").alias("this_week"), F.lit(True).alias("now")),
        F.struct(F.date_add("week", 7).alias("this_week"), F.lit(False).alias("now")),
    )
    sides = weeks.select("users", F.explode(roles).alias("role")).select("users", "role.*")
    pairs = (
        sides.where(F.col("this_week") <= F.lit(last))
        .groupBy("this_week")
        .agg(*[  # a side without a week is an empty set
            F.theta_union_agg(F.when(side, F.col("users")), precision).alias(name)
            for name, side in (("now", F.col("now")), ("before", ~F.col("now")))
        ])
        .withColumn("previous_week", F.date_sub("this_week", 7))
    )
    statuses = {
        "new": (1, F.theta_difference("now", "before")),
        "retained": (1, F.theta_intersection("now", "before")),
        "lost": (-1, F.theta_difference("before", "now")),
    }
    return _sizes(pairs, ["this_week", "previous_week"], "status", "num_users", statuses)


def _sizes(
    sets: DataFrame, keys: list[str], label: str, size: str, found: dict[str, tuple[int, Column]]
) -> DataFrame:
    """One row per set that is not empty, with its signed size."""
    entries = [
        F.struct(F.lit(name).alias(label), (F.theta_sketch_estimate(users) * sign).cast("long").alias(size))
        for name, (sign, users) in found.items()
    ]
    rows = sets.select(*keys, F.explode(F.array(*entries)).alias("entry")).select(*keys, "entry.*")
    return rows.where(F.col(size) != 0)


# --- stored days -----------------------------------------------------------------


def write_days(sketches: DataFrame, path: str) -> None:
    """Store the days present in ``sketches``; a day that is written again replaces itself."""
    (
        sketches.repartition("date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date")
        .parquet(path)
    )


def read_days(spark: SparkSession, path: str, schema: str, first: date, last: date) -> DataFrame:
    """Stored days from ``first`` to ``last``; no other day's folder is opened."""
    return spark.read.schema(schema).parquet(path).where(F.col("date").between(F.lit(first), F.lit(last)))
