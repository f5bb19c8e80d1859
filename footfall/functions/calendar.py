"""Time columns and the explicit "now" used by every report."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, time, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLOT_MINUTES = 15


@dataclass(frozen=True)
class AsOf:
    """The moment a report is run for."""

    now: datetime

    @property
    def today(self) -> date:
        return self.now.date()

    def days_ago(self, n: int) -> date:
        return self.today - timedelta(days=n)

    @property
    def yesterday(self) -> date:
        return self.days_ago(1)

    @property
    def open_slot(self) -> datetime:
        """Start of the quarter hour that has not ended yet."""
        return self.now.replace(
            minute=self.now.minute // SLOT_MINUTES * SLOT_MINUTES, second=0, microsecond=0
        )


def moment(value: date | datetime) -> Column:
    """A zone-less timestamp literal; it folds into the scan's pushed filters."""
    if not isinstance(value, datetime):
        value = datetime.combine(value, time.min)
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def within(df: DataFrame, start: date | datetime | None, end: date | datetime | None) -> DataFrame:
    """Rows with ``start <= time < end``; either bound may be absent."""
    if start is not None:
        df = df.where(F.col("time") >= moment(start))
    if end is not None:
        df = df.where(F.col("time") < moment(end))
    return df


def within_days(df: DataFrame, first: date, last: date) -> DataFrame:
    """Rows of the calendar days ``first`` to ``last``, both included."""
    return within(df, first, last + timedelta(days=1))


def day(column: str = "time") -> Column:
    return F.to_date(F.col(column))


def slot(column: str = "time") -> Column:
    """Start of the 15-minute slot."""
    return F.window(F.col(column), f"{SLOT_MINUTES} minutes").start


def hour_start(column: str = "time") -> Column:
    """Start of the hour, in the column's own timestamp type."""
    return F.window(F.col(column), "1 hour").start
