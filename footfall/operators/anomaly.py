"""Quarter-hour metrics, interquartile bands and alerts.

Everything after ``quarter_hour_metrics`` works on one row per slot and metric, so
the windows below are bounded by elapsed time, not by traffic.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions.calendar import SLOT_MINUTES, AsOf, slot, within
from footfall.functions.ratios import likes, messages, ratio, views

METRICS = ["users_feed", "views", "likes", "ctr", "users_messenger", "messages"]
_ZERO_WHEN_EMPTY = [m for m in METRICS if m != "ctr"]


def slot_metrics(activity: DataFrame) -> DataFrame:
    """The six metrics of every 15-minute slot with any activity."""
    per_user = activity.groupBy(slot().alias("ts"), "user_id").agg(
        views().alias("views"), likes().alias("likes"), messages().alias("messages")
    )
    return (
        per_user.groupBy("ts")
        .agg(
            F.count_if(F.col("views") > 0).alias("users_feed"),
            F.sum("views").alias("views"),
            F.sum("likes").alias("likes"),
            F.count_if(F.col("messages") > 0).alias("users_messenger"),
            F.sum("messages").alias("messages"),
        )
        .select(
            "ts",
            F.to_date("ts").alias("date"),
            F.date_format("ts", "HH:mm").alias("hm"),
            "users_feed",
            "views",
            "likes",
            ratio(F.col("likes"), F.col("views")).alias("ctr"),
            "users_messenger",
            "messages",
        )
    )


def quarter_hour_metrics(activity: DataFrame, as_of: AsOf, fill_gaps: bool = False) -> DataFrame:
    """Slots since yesterday's midnight, the open slot left out.

    ``fill_gaps`` adds the slots without any activity as zeros; by default they are
    absent and the bands below count slots rather than time.
    """
    recent = slot_metrics(within(activity, as_of.yesterday, as_of.open_slot))
    if not fill_gaps:
        return recent
    first = F.lit(f"{as_of.yesterday} 00:00:00").cast("timestamp_ntz")
    final = F.lit(str(as_of.open_slot - timedelta(minutes=SLOT_MINUTES))).cast("timestamp_ntz")
    spine = activity.sparkSession.range(1).select(
        F.explode(F.sequence(first, final, F.expr(f"interval {SLOT_MINUTES} minutes"))).alias("ts")
    )
    return (
        spine.join(recent, "ts", "left")
        .select(
            "ts",
            F.to_date("ts").alias("date"),
            F.date_format("ts", "HH:mm").alias("hm"),
            *[
                F.coalesce(m, F.lit(0)).alias(m) if m in _ZERO_WHEN_EMPTY else F.col(m)
                for m in METRICS
            ],
        )
    )


def metric_series(slots: DataFrame) -> DataFrame:
    """Wide slots to ``(ts, metric, value)``."""
    return slots.select("ts", *[F.col(m).cast("double").alias(m) for m in METRICS]).unpivot(
        ["ts"], METRICS, "metric", "value"
    )


def iqr_bands(
    series: DataFrame, a: float = 3.0, n: int = 5, live: bool = False
) -> DataFrame:
    """Bounds for each point from the quartiles of the previous ``n`` points.

    The bounds are widened by ``a`` interquartile ranges and smoothed with a centred
    mean of ``n`` points. They need ``n`` earlier defined values; otherwise they are
    NULL and the smoothing uses what there is. ``live`` smooths without looking ahead,
    which gives each point the bounds it had while it was the newest one.
    """
    ordered = Window.partitionBy("metric").orderBy("ts")
    previous = ordered.rowsBetween(-n, -1)
    # a centred window of an even length reaches one point further back
    around = ordered.rowsBetween(-(n // 2), 0 if live else (n - 1) // 2)
    full = F.count("value").over(previous) == n
    quarters = series.withColumn(
        "q25", F.when(full, F.percentile("value", 0.25).over(previous))
    ).withColumn("q75", F.when(full, F.percentile("value", 0.75).over(previous)))
    spread = F.col("q75") - F.col("q25")
    return (
        quarters.withColumn("up", F.col("q75") + F.lit(a) * spread)
        .withColumn("low", F.col("q25") - F.lit(a) * spread)
        .withColumn("up", F.avg("up").over(around))
        .withColumn("low", F.avg("low").over(around))
        .withColumn("previous_value", F.lag("value").over(ordered))
    )


def outside() -> Column:
    """The point lies beyond either bound; unknown bounds raise no alert."""
    return F.coalesce(
        (F.col("value") < F.col("low")) | (F.col("value") > F.col("up")), F.lit(False)
    )


def latest_alerts(bands: DataFrame) -> DataFrame:
    """The newest point of each metric and whether it lies outside its bounds."""
    columns = ["ts", "value", "previous_value", "low", "up"]
    newest = bands.groupBy("metric").agg(F.max_by(F.struct(*columns), "ts").alias("p"))
    return newest.select("metric", "p.*").withColumn("is_alert", outside())


def band_breaks(bands: DataFrame) -> DataFrame:
    """Every point outside its bounds, for judging the rule on past data."""
    return bands.where(outside()).select("metric", "ts", "value", "low", "up")


def alert_messages(alerts: DataFrame) -> DataFrame:
    """Text for each metric in alert: value and change from the previous point.

    Without a previous value, or with a previous value of zero, the change is "n/a".
    """
    change = F.abs(1 - ratio(F.col("value"), F.col("previous_value")))
    text = F.concat(
        F.lit("Metric "),
        F.col("metric"),
        F.lit(":\ncurrent value "),
        F.format_string("%.2f", "value"),
        F.lit("\nchange from previous value "),
        F.when(change.isNull(), "n/a").otherwise(F.format_string("%.2f%%", change * 100)),
    )
    return alerts.where("is_alert").select("metric", "ts", text.alias("text"))


def day_over_day(series: DataFrame, tolerance: float) -> DataFrame:
    """Each point against the same slot a day earlier, where there is one.

    One pass: the earlier point is the only one in a range frame of exactly a day. The
    frame counts seconds from the calendar fields, so no time zone takes part.
    """
    clock = F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")
    seconds = F.unix_date(F.to_date("ts")).cast("bigint") * 86_400 + clock
    earlier = Window.partitionBy("metric").orderBy("_second").rangeBetween(-86_400, -86_400)
    change = ratio(F.col("value"), F.col("day_before")) - 1
    return (
        series.withColumn("_second", seconds)
        .withColumn("_points", F.count("*").over(earlier))
        .withColumn("day_before", F.max("value").over(earlier))
        .where("_points > 0")
        .select("ts", "metric", "value", "day_before")
        .withColumn("change", change)
        .withColumn("is_alert", F.coalesce(F.abs("change") > tolerance, F.lit(False)))
    )
