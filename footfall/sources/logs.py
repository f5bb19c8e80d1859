"""Feed and message logs stored as Parquet."""

from __future__ import annotations

from datetime import date, datetime, time, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.schema import FEED, MESSAGES, conform


def _read(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    start: date | datetime | None,
    end: date | datetime | None,
    time_type: str,
    day_column: str | None,
) -> DataFrame:
    """A log with ``start <= time < end``, read with its schema.

    The bounds are literals of the type ``time`` is stored in, so they reach the scan; the
    cast to the log's own type comes after. ``day_column`` names day folders, of which only
    those within the bounds are read.
    """
    stored = T.StructType()
    for field in schema:
        stored = stored.add(field.name, time_type if field.name == "time" else field.dataType)
    if day_column:
        stored = stored.add(day_column, T.DateType())
    log = spark.read.schema(stored).parquet(path)

    def literal(value: date | datetime):
        if not isinstance(value, datetime):
            value = datetime.combine(value, time.min)
        return F.lit(value.isoformat(sep=" ")).cast(time_type)

    if start is not None:
        log = log.where(F.col("time") >= literal(start))
        if day_column:
            log = log.where(F.col(day_column) >= F.lit(_day(start)))
    if end is not None:
        log = log.where(F.col("time") < literal(end))
        if day_column:
            last = end - timedelta(microseconds=1) if isinstance(end, datetime) else end - timedelta(days=1)
            log = log.where(F.col(day_column) <= F.lit(_day(last)))
    return conform(log, schema)


def _day(value: date | datetime) -> date:
    return value.date() if isinstance(value, datetime) else value


def feed_actions(
    spark: SparkSession,
    path: str,
    start: date | datetime | None = None,
    end: date | datetime | None = None,
    time_type: str = "timestamp_ntz",
    day_column: str | None = None,
) -> DataFrame:
    """Feed log with ``start <= time < end``.

    ``time_type`` is how the files store ``time`` (``timestamp`` or ``timestamp_ntz``) and
    ``day_column`` the name of their day folders, if any; both bounds reach the scan.
    """
    return _read(spark, path, FEED, start, end, time_type, day_column)


def message_actions(
    spark: SparkSession,
    path: str,
    start: date | datetime | None = None,
    end: date | datetime | None = None,
    time_type: str = "timestamp_ntz",
    day_column: str | None = None,
) -> DataFrame:
    """Message log with ``start <= time < end``; options as for the feed."""
    return _read(spark, path, MESSAGES, start, end, time_type, day_column)


def write_log(log: DataFrame, path: str, day_column: str = "day") -> None:
    """Append a log to day folders, each day's rows in time order."""
    (
        log.withColumn(day_column, F.to_date("time"))
        .repartition(day_column, F.pmod(F.xxhash64("user_id"), F.lit(8)))  # a day may be large
        .sortWithinPartitions(day_column, "time")
        .write.mode("append")
        .partitionBy(day_column)
        .parquet(path)
    )


def peek(df: DataFrame, n: int = 5, order: list[str] | None = None) -> DataFrame:
    """The first ``n`` rows, to learn the columns; ordered when the answer must be stable."""
    return (df.orderBy(*order) if order else df).limit(n)


def activity(feed: DataFrame, messages: DataFrame) -> DataFrame:
    """One log of both services; a sent message is the action ``message``."""
    shared = [c for c in feed.columns if c in messages.columns and c != "action"]
    return feed.select(*shared, "action").unionByName(
        messages.select(*shared, F.lit("message").alias("action"))
    )
