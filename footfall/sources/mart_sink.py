"""The daily mart on disk."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.schema import MART, conform
from footfall.session import remove_path


def write_mart(mart: DataFrame, path: str, days: Sequence[date] = ()) -> None:
    """Add days to the mart, creating it if absent.

    Only the days present in ``mart`` are replaced, so a retried day overwrites
    itself instead of being counted twice. ``days`` are those the caller owns: one of
    them without rows loses the rows it had.
    """
    (
        conform(mart, MART)
        .repartition("event_date")
        .sortWithinPartitions("event_date", "dimension", "dimension_value")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("event_date")
        .parquet(path)
    )
    for day in days:
        if mart.where(F.col("event_date") == F.lit(day)).isEmpty():
            remove_path(mart.sparkSession, f"{path}/event_date={day.isoformat()}")


def read_mart(spark: SparkSession, path: str) -> DataFrame:
    return conform(spark.read.schema(MART).parquet(path), MART)
