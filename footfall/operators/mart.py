"""The daily mart: per-user-day metrics of both services, cut by user dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions.calendar import day
from footfall.functions.ratios import likes, views
from footfall.schema import MART_COUNTS

DIMENSIONS = ["gender", "age", "os"]
UNKNOWN = "unknown"


#: The profile columns carried through are those the mart is cut by.
PROFILE = DIMENSIONS


def _profile() -> list:
    return [F.max(c).alias(c) for c in PROFILE]


def feed_user_day(feed: DataFrame) -> DataFrame:
    """Views and likes per user and day, with the user's profile.

    Events are first counted per distinct profile. That pass needs no maximum of
    a text column, which Spark can only compute by sorting, so every event goes
    through hash aggregation and only user-days are sorted, once, after they have
    been placed by user and day.
    """
    counted = feed.groupBy("user_id", day().alias("event_date"), *PROFILE).agg(
        views().alias("views"), likes().alias("likes")
    )
    placed = counted.repartition("user_id", "event_date")
    return placed.groupBy("user_id", "event_date").agg(
        F.sum("views").alias("views"), F.sum("likes").alias("likes"), *_profile()
    )


def sent_user_day(messages: DataFrame) -> DataFrame:
    """Messages sent and people written to, per sender and day.

    Events are counted per receiver and profile by hash first, as in the feed.
    """
    counted = messages.groupBy(
        "user_id", day().alias("event_date"), "receiver_id", *PROFILE
    ).agg(F.count("receiver_id").alias("n"))
    pairs = (
        counted.repartition("user_id", "event_date")
        .groupBy("user_id", "event_date", "receiver_id")
        .agg(F.sum("n").alias("n"), *_profile())
    )
    return pairs.groupBy("user_id", "event_date").agg(
        F.sum("n").alias("messages_sent"), F.count("receiver_id").alias("users_sent"), *_profile()
    )


def received_user_day(messages: DataFrame) -> DataFrame:
    """Messages received and people they came from, per receiver and day.

    The log holds the sender's profile only, so a receiver's is not taken from it.
    """
    return messages.groupBy(F.col("receiver_id").alias("user_id"), day().alias("event_date")).agg(
        F.count("user_id").alias("messages_received"),
        F.count_distinct("user_id").alias("users_received"),
    )


def _merge(sides: list[DataFrame], counts: list[str], profile: list) -> DataFrame:
    """Full outer merge of sides that hold one row per user and day.

    Written as a union and a grouping on the key the sides are already
    partitioned by, so merging shuffles nothing again; a missing count is zero.
    """
    merged = sides[0]
    for side in sides[1:]:
        merged = merged.unionByName(side, allowMissingColumns=True)
    return merged.groupBy("user_id", "event_date").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts], *profile
    )


def messenger_user_day(sent: DataFrame, received: DataFrame) -> DataFrame:
    """Both directions per user and day; a missing direction is zero."""
    counts = ["messages_sent", "users_sent", "messages_received", "users_received"]
    return _merge([sent, received], counts, _profile())


def message_user_day(messages: DataFrame) -> DataFrame:
    """Both directions per user and day from one scan; equals ``messenger_user_day``.

    Each message becomes a row of its sender and one of its receiver. The log holds the
    sender's profile only.
    """
    types = dict(messages.dtypes)
    unknown = [F.lit(None).cast(types[c]).alias(c) for c in PROFILE]
    sent = F.struct("user_id", F.col("receiver_id").alias("other"), F.lit(True).alias("sent"), *PROFILE)
    received = F.struct(
        F.col("receiver_id").alias("user_id"), F.col("user_id").alias("other"), F.lit(False).alias("sent"), *unknown
    )
    rows = messages.select(day().alias("event_date"), F.explode(F.array(sent, received)).alias("m"))
    counted = rows.select("event_date", "m.*").groupBy("user_id", "event_date", "other", "sent", *PROFILE).agg(
        F.count("other").alias("n")
    )
    pairs = (
        counted.repartition("user_id", "event_date")
        .groupBy("user_id", "event_date", "other", "sent")
        .agg(F.sum("n").alias("n"), *_profile())
    )

    def direction(name: str, is_sent: bool) -> list:
        of = F.col("sent") == is_sent
        total = F.coalesce(F.sum(F.when(of, F.col("n"))), F.lit(0))
        return [total.alias(f"messages_{name}"), F.count(F.when(of, F.col("other"))).alias(f"users_{name}")]

    return pairs.groupBy("user_id", "event_date").agg(
        *direction("sent", True), *direction("received", False), *_profile()
    )


def user_day(*sides: DataFrame) -> DataFrame:
    """All six metrics per user and day, zero where a service was not used.

    Takes the feed's user-days first, then the messenger's (merged or as sent and
    received). The profile comes from the user's own rows on the first side that has
    it; without any it is NULL.
    """
    ranked = []
    for rank, side in enumerate(sides):
        own = [c for c in PROFILE if c in side.columns]
        known = [F.when(F.col(c).isNotNull(), F.struct(F.lit(rank), c)).alias(c) for c in own]
        ranked.append(side.select(*[c for c in side.columns if c not in own], *known))
    preferred = [F.min(c).getField(c).alias(c) for c in PROFILE]
    merged = _merge(ranked, MART_COUNTS, preferred)
    gender = F.when(F.col("gender") == 1, "male").when(F.col("gender") == 0, "female")
    return merged.select(
        "user_id", "event_date", gender.alias("gender"), "age", "os", *MART_COUNTS
    )


def _sums() -> list:
    return [F.sum(c).alias(c) for c in MART_COUNTS]


def _label(dim: str):
    return F.coalesce(F.col(dim).cast("string"), F.lit(UNKNOWN))


def mart_cut(user_days: DataFrame, dim: str) -> DataFrame:
    """The mart rows of one dimension."""
    return (
        user_days.groupBy("event_date", _label(dim).alias("dimension_value"))
        .agg(*_sums())
        .select("event_date", F.lit(dim).alias("dimension"), "dimension_value", *MART_COUNTS)
    )


def daily_mart(user_days: DataFrame) -> DataFrame:
    """All three cuts from one pass over the user-days.

    The cut a row belongs to is read from the grouping itself rather than from
    which key is NULL, and unknown values are labelled before grouping.
    """
    labelled = user_days.select("event_date", *[_label(d).alias(d) for d in DIMENSIONS], *MART_COUNTS)
    keys = [F.col("event_date"), *[F.col(d) for d in DIMENSIONS]]
    cuts = labelled.groupingSets(
        [[F.col("event_date"), F.col(d)] for d in DIMENSIONS], *keys
    ).agg(*_sums(), *[F.grouping(d).alias(f"without_{d}") for d in DIMENSIONS])
    present = {d: F.col(f"without_{d}") == 0 for d in DIMENSIONS}
    name = F.coalesce(*[F.when(p, F.lit(d)) for d, p in present.items()])
    value = F.coalesce(*[F.when(p, F.col(d)) for d, p in present.items()])
    return cuts.select(
        "event_date", name.alias("dimension"), value.alias("dimension_value"), *MART_COUNTS
    )
