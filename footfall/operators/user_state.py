"""What is known of every user, kept up to date by one day's log at a time.

Retention, weekly audience, daily users and campaign return depend on a user's first action and active
days only. A state holds those: one row per user with the day, time and source of the first action and
the active days as bits. A day's log is reduced to the same form and merged by minimum and ``bit_or``,
so a run reads one day and the state, however long the history is. Both operations may be repeated and come in any
order: a day merged twice changes nothing, and a late day is merged when it arrives.

The state is dealt into buckets of users (``sources/buckets.py``). A merge is a full outer join in which
only the day's users are shuffled, and writes a new version beside the old one. The newest complete version counts, so
a run that dies leaves the state as it was.

Days outside the horizon are not held as bits, but a first action always counts. ``roll`` moves the horizon on, whole
words of bits at a time, so a row does not grow with the history.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.functions.bitsets import WORD, collect_bits, members, merge_bits
from footfall.functions.calendar import day
from footfall.functions.ratios import ratio
from footfall.operators.retention import audience_entries, cohort_cells
from footfall.sources.buckets import forget, is_complete, read_bucketed, write_bucketed


@dataclass(frozen=True)
class Horizon:
    """The days that a state can tell apart: ``days`` of them from ``origin`` on."""

    origin: date
    days: int

    @property
    def words(self) -> list[str]:
        return [f"_bits{w}" for w in range((self.days + WORD - 1) // WORD)]

    def check(self, first: date, last: date) -> None:
        if first < self.origin or last >= self.origin + timedelta(days=self.days):
            raise ValueError(f"{first} to {last} is outside the state's days from {self.origin}")


def reduce_log(log: DataFrame, horizon: Horizon, dim: str = "source") -> DataFrame:
    """The state of a stretch of log alone: ``user_id, start_date, first, _bits*``.

    ``first`` is the time and ``dim`` of the user's first action (of several at one time the smallest value).
    Actions without a user are left out.
    """
    log = log.where(F.col("user_id").isNotNull())
    offset = F.datediff(day(), F.lit(horizon.origin))
    per_value = log.groupBy("user_id", dim).agg(F.min("time").alias("time"), *collect_bits(offset, horizon.days))
    whole = per_value.repartition("user_id").groupBy("user_id").agg(
        F.min(F.struct("time", F.col(dim).alias("value"))).alias("first"), *merge_bits(horizon.days)
    )
    return whole.select("user_id", F.to_date("first.time").alias("start_date"), "first", *horizon.words)


def merge_states(known: DataFrame, more: DataFrame, horizon: Horizon) -> DataFrame:
    """Both states as one; only a side that does not lie by user is shuffled."""
    a, b = known.alias("a"), more.alias("b")
    both = a.join(b, F.col("a.user_id") == F.col("b.user_id"), "full_outer")
    zero = F.lit(0).cast("bigint")

    def either(word: str):
        return F.coalesce(F.col(f"a.{word}"), zero).bitwiseOR(F.coalesce(F.col(f"b.{word}"), zero)).alias(word)

    return both.select(
        F.coalesce("a.user_id", "b.user_id").alias("user_id"),
        F.least("a.start_date", "b.start_date").alias("start_date"),
        F.least("a.first", "b.first").alias("first"),
        *[either(w) for w in horizon.words],
    )


def roll(state: DataFrame, horizon: Horizon, words: int = 1) -> tuple[DataFrame, Horizon]:
    """The state and its horizon, ``words`` words of days later; the oldest days are forgotten."""
    later = replace(horizon, origin=horizon.origin + timedelta(days=words * WORD))
    names = horizon.words
    moved = [F.col(names[w + words]) if w + words < len(names) else F.lit(0).cast("bigint") for w in range(len(names))]
    # a horizon that ends inside a word has no days in that word's rest
    return state.select("user_id", "start_date", "first", *[c.alias(n) for c, n in zip(moved, names)]), later


# --- stored states --------------------------------------------------------------------------


class StateStore:
    """Versions of a state under one folder, of which the newest complete one counts."""

    def __init__(self, spark: SparkSession, path: str, horizon: Horizon, buckets: int, keep: int = 2):
        self.spark, self.path, self.horizon, self.buckets, self.keep = spark, path.rstrip("/"), horizon, buckets, keep

    def _versions(self) -> list[int]:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        files = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(folder):
            return []
        names = [entry.getPath().getName() for entry in files.listStatus(folder)]
        return sorted(int(n.removeprefix("version=")) for n in names if n.startswith("version="))

    def _at(self, version: int) -> str:
        return f"{self.path}/version={version:08d}"

    def newest(self) -> int | None:
        return max((v for v in self._versions() if is_complete(self.spark, self._at(v))), default=None)

    def read(self) -> DataFrame:
        version = self.newest()
        if version is None:
            raise ValueError(f"no complete state under {self.path}")
        return read_bucketed(self.spark, self._at(version))

    def merged(self, log: DataFrame) -> DataFrame:
        """The state with a stretch of log; nothing is written."""
        more = reduce_log(log, self.horizon)
        return more if self.newest() is None else merge_states(self.read(), more, self.horizon)

    def merge(self, log: DataFrame) -> None:
        """Write a version that knows ``log`` too, and delete all but the newest versions."""
        version = self.newest()
        following = 0 if version is None else version + 1
        write_bucketed(self.merged(log), self._at(following), "user_id", self.buckets)
        for old in self._versions():
            if old <= following - self.keep:
                forget(self.spark, self._at(old))

    def merge_days(self, read: Callable[[date], DataFrame], first: date, last: date) -> None:
        """Merge each day's log in turn; ``read`` opens one day."""
        for number in range((last - first).days + 1):
            self.merge(read(first + timedelta(days=number)))


# --- results --------------------------------------------------------------------------------


def _active(state: DataFrame, horizon: Horizon, first: date, last: date):
    """Active days between ``first`` and ``last``, as day numbers from the origin."""
    horizon.check(first, last)
    low, high = (first - horizon.origin).days, (last - horizon.origin).days
    return F.filter(members(horizon.days), lambda d: (d >= low) & (d <= high))


def state_first_seen(state: DataFrame, since: date) -> DataFrame:
    """``first_seen`` from a state."""
    return state.where(F.col("start_date") >= F.lit(since)).select("user_id", "start_date")


def state_retention(state: DataFrame, horizon: Horizon, since: date, until: date, by: str | None = None) -> DataFrame:
    """``cohort_retention`` from a state; ``by`` names the first action's value."""
    users = state.where(F.col("start_date") >= F.lit(since))
    keys = [F.col("first.value").alias(by)] if by else []
    days = _active(state, horizon, since, until)
    cells = users.select(*keys, "start_date", F.explode(days).alias("offset"))
    return cohort_cells(cells, horizon.origin, [by] if by else [])


def state_dau(state: DataFrame, horizon: Horizon, first: date, last: date) -> DataFrame:
    """``dau`` of the days ``first`` to ``last`` from a state."""
    days = state.select(F.explode(_active(state, horizon, first, last)).alias("offset"))
    return days.groupBy(F.date_add(F.lit(horizon.origin), F.col("offset")).alias("date")).agg(F.count("*").alias("dau"))


def state_weekly_audience(state: DataFrame, horizon: Horizon, first: date, as_of: date) -> DataFrame:
    """``weekly_audience`` from a state."""
    origin = first - timedelta(days=first.weekday())
    last = origin + timedelta(days=(as_of - origin).days // 7 * 7 + 6)
    low = (origin - horizon.origin).days
    within = _active(state, horizon, origin, min(last, horizon.origin + timedelta(days=horizon.days - 1)))
    weeks = F.array_distinct(F.transform(within, lambda d: F.floor((d - low) / 7).cast("int")))
    users = state.select(weeks.alias("weeks"))
    return audience_entries(
        users, F.col("weeks"), lambda w: F.array_contains("weeks", w), origin, (as_of - origin).days // 7 + 1
    )


def state_new_user_return(state: DataFrame, horizon: Horizon, dim: str = "source") -> DataFrame:
    """``new_user_return`` from a state: users by first day and first value, and those active the day after.

    First days must lie within the horizon, which has to hold the day after too.
    """
    offset = F.datediff("start_date", F.lit(horizon.origin))
    back = F.array_contains(members(horizon.days), offset + 1)
    return (
        state.groupBy("start_date", F.col("first.value").alias(dim))
        .agg(F.count("*").alias("new_users"), F.count_if(back).alias("returned_next_day"))
        .withColumn("return_rate", ratio(F.col("returned_next_day"), F.col("new_users")))
    )
