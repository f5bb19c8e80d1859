"""Ratio metrics. A zero denominator gives NULL, never an error or infinity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def likes() -> Column:
    return F.count_if(F.col("action") == "like")


def views() -> Column:
    return F.count_if(F.col("action") == "view")


def messages() -> Column:
    return F.count_if(F.col("action") == "message")
