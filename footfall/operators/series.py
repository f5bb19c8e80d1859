"""Hourly activity, its decomposition, and profiles by hour of day."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions.calendar import hour_start
from footfall.functions.ratios import ratio
from footfall.functions.smoothing import robust_stl

SERIES = "series"


def hourly(feed: DataFrame, by: str | None = None) -> DataFrame:
    """Actions per hour; with ``by`` one series per value, otherwise one named ``all``."""
    name = F.col(by).cast("string") if by else F.lit("all")
    return feed.groupBy(name.alias(SERIES), hour_start().alias("day_h")).agg(
        F.count("user_id").alias("actions")
    )


def fill_hours(series: DataFrame) -> DataFrame:
    """Add the missing hours between each series' first and last as zeros."""
    spine = series.groupBy(SERIES).agg(
        F.sequence(F.min("day_h"), F.max("day_h"), F.expr("interval 1 hour")).alias("hours")
    )
    return (
        spine.select(SERIES, F.explode("hours").alias("day_h"))
        .join(series, [SERIES, "day_h"], "left")
        .withColumn("actions", F.coalesce("actions", F.lit(0)))
    )


def decompose(series: DataFrame, period: int = 24) -> DataFrame:
    """Robust seasonal-trend decomposition, one task per series.

    The event log has been reduced to one row per hour, so a series is bounded by
    the hours of history however busy its slice is.
    """
    schema = (
        f"{SERIES} string, day_h timestamp_ntz, observed double, trend double, "
        "seasonal double, resid double, weight double"
    )

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("day_h")
        observed = rows["actions"].to_numpy(dtype="float64")
        if len(observed) < 2 * period:
            gap = np.full(len(observed), np.nan)
            trend, seasonal, weight = gap, gap, gap
        else:
            trend, seasonal, weight = robust_stl(observed, period)
        return pd.DataFrame(
            {
                SERIES: rows[SERIES].to_numpy(),
                "day_h": rows["day_h"].to_numpy(),
                "observed": observed,
                "trend": trend,
                "seasonal": seasonal,
                "resid": observed - trend - seasonal,
                "weight": weight,
            }
        )

    return fill_hours(series).groupBy(SERIES).applyInPandas(fit, schema)


def classical_decompose(series: DataFrame, period: int = 24) -> DataFrame:
    """Additive decomposition: centred moving average, mean per hour of day, remainder.

    For an even period the average spans ``period + 1`` hours with half weight at
    both ends. Trend and remainder are NULL for the first and last half period.
    """
    half = period // 2
    filled = fill_hours(series)
    ordered = Window.partitionBy(SERIES).orderBy("day_h")
    wide = ordered.rowsBetween(-half, half)
    inner = ordered.rowsBetween(-half + 1, half - 1) if period % 2 == 0 else wide
    total = (
        (F.sum("actions").over(wide) + F.sum("actions").over(inner)) / 2
        if period % 2 == 0
        else F.sum("actions").over(wide)
    )
    full = F.count("*").over(wide) == 2 * half + 1
    detrended = filled.withColumn("trend", F.when(full, total / period)).withColumn(
        "detrended", F.col("actions") - F.col("trend")
    )
    hours = F.unix_date(F.to_date("day_h")) * 24 + F.hour("day_h")
    position = F.pmod(hours, F.lit(period))
    detrended = detrended.withColumn("position", position)
    seasons = (
        detrended.groupBy(SERIES, "position")
        .agg(F.avg("detrended").alias("raw"))
        .withColumn("seasonal", F.col("raw") - F.avg("raw").over(Window.partitionBy(SERIES)))
        .select(SERIES, "position", "seasonal")
    )
    return detrended.join(seasons, [SERIES, "position"]).select(
        SERIES,
        "day_h",
        F.col("actions").cast("double").alias("observed"),
        "trend",
        "seasonal",
        (F.col("detrended") - F.col("seasonal")).alias("resid"),
    )


def by_hour(feed: DataFrame) -> DataFrame:
    """Actions by hour of day."""
    return (
        feed.groupBy(F.hour("time").alias("hour"))
        .agg(F.count("user_id").alias("actions"))
        .orderBy("hour")
    )


def published_by_hour(feed: DataFrame) -> DataFrame:
    """Posts by the hour of day of their first action, which stands for publication."""
    return (
        feed.groupBy("post_id")
        .agg(F.min("time").alias("publication_time"))
        .groupBy(F.hour("publication_time").alias("hour"))
        .agg(F.count("*").alias("posts"))
        .orderBy("hour")
    )


def hour_profiles(feed: DataFrame) -> DataFrame:
    """Share of actions and of publications by hour of day, with the peak hours marked.

    At most 24 rows remain when the profiles are compared.
    """
    both = by_hour(feed).join(published_by_hour(feed), "hour", "full_outer")
    whole_day = Window.partitionBy(F.lit(1))
    filled = both.select(
        "hour",
        F.coalesce("actions", F.lit(0)).alias("actions"),
        F.coalesce("posts", F.lit(0)).alias("posts"),
    )
    for name in ("actions", "posts"):
        filled = filled.withColumn(
            f"{name}_share", ratio(F.col(name), F.sum(name).over(whole_day))
        ).withColumn(f"{name}_peak", F.col(name) == F.max(name).over(whole_day))
    return filled
