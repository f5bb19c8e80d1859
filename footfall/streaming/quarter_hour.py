"""Quarter-hour metrics and alerts over live logs.

The stream has the shape of the batch report: actions are counted per slot and
user, then per slot. Both steps are event-time windows in append mode, so a slot is
emitted once, when the watermark has passed its end, and distinct users are exact.
State is one row per user and open slot.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from footfall.functions.calendar import SLOT_MINUTES
from footfall.functions.ratios import likes, messages, ratio, views
from footfall.operators.anomaly import iqr_bands, metric_series, outside
from footfall.schema import FEED, MESSAGES, conform
from footfall.session import remove_path
from footfall.sources.adapter import EVENTS, feed_from_events, messages_from_events
from footfall.sources.logs import activity

SLOTS = (
    "ts timestamp_ntz, users_feed bigint, views bigint, likes bigint, ctr double, "
    "users_messenger bigint, messages bigint"
)


def stream_logs(
    spark: SparkSession, feed: str, messages: str, pattern: str = "*.parquet"
) -> DataFrame:
    """Both logs as one stream over files that arrive in their folders (day folders or not)."""

    def arriving(folder: str, schema) -> DataFrame:
        files = spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(folder)
        return conform(files, schema)

    return activity(arriving(feed, FEED), arriving(messages, MESSAGES))


def stream_activity(spark: SparkSession, folder: str, pattern: str = "events*.parquet") -> DataFrame:
    """Both logs as one stream over event files that arrive in ``folder``."""
    events = (
        spark.readStream.schema(EVENTS).option("pathGlobFilter", pattern).parquet(folder)
    )
    return activity(feed_from_events(events), messages_from_events(events))


def stream_slots(activity: DataFrame, lateness: str = "1 hour", approx: bool = False) -> DataFrame:
    """The six metrics of every slot the watermark has closed.

    ``approx`` estimates distinct users (HyperLogLog++), with one state row per open slot.
    """
    timed = (
        activity.select("user_id", "action", F.col("time").cast("timestamp").alias("time"))
        .withWatermark("time", lateness)
    )
    if approx:
        sent = F.col("action") == "message"
        viewed = F.col("action") == "view"
        slots = timed.groupBy(F.window("time", f"{SLOT_MINUTES} minutes")).agg(
            F.approx_count_distinct(F.when(viewed, F.col("user_id"))).alias("users_feed"),
            views().alias("views"),
            likes().alias("likes"),
            F.approx_count_distinct(F.when(sent, F.col("user_id"))).alias("users_messenger"),
            messages().alias("messages"),
        )
        return _closed(slots)
    per_user = timed.groupBy(F.window("time", f"{SLOT_MINUTES} minutes"), "user_id").agg(
        views().alias("views"), likes().alias("likes"), messages().alias("messages")
    )
    slots = per_user.groupBy("window").agg(
        F.count_if(F.col("views") > 0).alias("users_feed"),
        F.sum("views").alias("views"),
        F.sum("likes").alias("likes"),
        F.count_if(F.col("messages") > 0).alias("users_messenger"),
        F.sum("messages").alias("messages"),
    )
    return _closed(slots)


def _closed(slots: DataFrame) -> DataFrame:
    return slots.select(
        F.col("window.start").cast("timestamp_ntz").alias("ts"),
        "users_feed",
        "views",
        "likes",
        ratio(F.col("likes"), F.col("views")).alias("ctr"),
        "users_messenger",
        "messages",
    )


def run_slots(
    slots: DataFrame,
    folder: str,
    a: float = 3.0,
    n: int = 5,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Keep a table of closed slots and a table of alerts under ``folder``.

    Each micro-batch owns one folder per table and overwrites it when retried, so a
    restart repeats nothing. Every newly closed slot is judged as if it were the newest
    one: its bands need the ``n + n // 2`` slots before it, whatever their age. A batch
    leaves the last so many slots as the next one's history, so a batch reads its own
    slots and one small file however long the stream has run.
    """
    spark = slots.sparkSession
    history = n + n // 2

    def store(batch: DataFrame, number: int) -> None:
        mine, before = (f"batch={i:012d}" for i in (number, number - 1))
        batch.withColumn("date", F.to_date("ts")).write.mode("overwrite").partitionBy("date").parquet(
            f"{folder}/slots/{mine}"
        )
        new = _stored(spark, f"{folder}/slots/{mine}")
        known = new
        if number > 0:
            known = new.unionByName(spark.read.schema(SLOTS).parquet(f"{folder}/recent/{before}"))
        known.orderBy(F.desc("ts")).limit(history).write.mode("overwrite").parquet(
            f"{folder}/recent/{mine}"
        )
        oldest = new.agg(F.min("ts")).first()[0]
        if oldest is not None:
            bands = iqr_bands(metric_series(known), a, n, live=True)
            since = F.lit(str(oldest)).cast("timestamp_ntz")
            alerts = bands.where(outside() & (F.col("ts") >= since))
            alerts.select("metric", "ts", "value", "previous_value", "low", "up").write.mode(
                "overwrite"
            ).parquet(f"{folder}/alerts/{mine}")
        remove_path(spark, f"{folder}/recent/batch={number - 2:012d}")

    return (
        slots.writeStream.outputMode("append")
        .foreachBatch(store)
        .option("checkpointLocation", f"{folder}/progress")
        .trigger(**(trigger or {"processingTime": f"{SLOT_MINUTES} minutes"}))
        .start()
    )


def _stored(spark: SparkSession, path: str) -> DataFrame:
    """The slots that one batch has stored."""
    return spark.read.schema(f"{SLOTS}, date date").parquet(path).drop("date")


def read_slots(
    spark: SparkSession, folder: str, first: date | None = None, last: date | None = None
) -> DataFrame:
    """The closed slots, of the days ``first`` to ``last`` if given; other days are not read."""
    stored = spark.read.schema(f"{SLOTS}, date date").parquet(f"{folder}/slots")
    if first is not None:
        stored = stored.where(F.col("date") >= F.lit(first))
    if last is not None:
        stored = stored.where(F.col("date") <= F.lit(last))
    return stored.select(*[c.split()[0] for c in SLOTS.split(", ")])


def read_alerts(spark: SparkSession, folder: str) -> DataFrame:
    schema = (
        "metric string, ts timestamp_ntz, value double, previous_value double, "
        "low double, up double"
    )
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(f"{folder}/alerts")
