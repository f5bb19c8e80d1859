"""Feed and message logs derived from a generic ``events`` table.

The event table has no likes, no user profile and users who are active nearly
every day, which makes retention trivial. Each event user therefore stands for
two accounts: one is active on the days before a hashed start day and in hashed
gap weeks, the other on all remaining days. Every event row is kept, and both
accounts have staggered starts and weeks without activity. Some users change their source. Posts and receivers are
numbered within blocks of users, so their number grows with the users.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.functions.hashing import seeded_hash
from footfall.schema import FEED, MESSAGES, conform

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)

EPOCH = "2024-01-01"
BLOCK = 150  # users who share a set of posts

# One hash seed per derived column.
SEEDS = {
    "start": 1,
    "gap": 2,
    "age": 3,
    "os": 4,
    "gender": 5,
    "source": 6,
    "exp_group": 7,
    "nation": 8,
    "city": 9,
    "moves": 10,
}
MOVE_DAY = 15  # from then on every fifth user comes from the other source


def _draw(name: str, key: Column, n: int) -> Column:
    return seeded_hash(SEEDS[name], key) % F.lit(n)


def _profiled(events: DataFrame, nation: DataFrame | None) -> DataFrame:
    raw = F.col("user_id")
    days = F.datediff(F.to_date("ts"), F.lit(EPOCH).cast("date"))
    weeks = F.floor(days / 7)
    settled = (days >= _draw("start", raw, 20)) & (_draw("gap", raw * 4096 + weeks, 3) != 0)
    base = events.select(
        (raw * 2 + F.when(settled, 1).otherwise(0)).cast("bigint").alias("user_id"),
        F.col("ts").alias("time"),
        "event_type",
        F.regexp_extract("props", "([0-9]+)", 1).cast("bigint").alias("k"),
        days.alias("d"),
        F.floor(raw / BLOCK).alias("block"),
    )
    user = F.col("user_id")
    moved = (F.col("d") >= MOVE_DAY) & (_draw("moves", user, 5) == 0)
    from_ads = (_draw("source", user, 2) == 0) != moved
    base = base.select(
        "*",
        (14 + _draw("age", user, 47)).cast("int").alias("age"),
        F.when(_draw("os", user, 3) == 0, "iOS").otherwise("Android").alias("os"),
        _draw("gender", user, 2).cast("int").alias("gender"),
        F.when(from_ads, "ads").otherwise("organic").alias("source"),
        _draw("exp_group", user, 4).cast("int").alias("exp_group"),
    )
    if nation is None:
        return base.withColumn("country", F.lit(None).cast("string")).withColumn(
            "city", F.lit(None).cast("string")
        )
    # The nation list is small; whether to broadcast it is left to its measured size.
    names = nation.select(
        F.col("n_nationkey").cast("bigint").alias("nation_key"), F.col("n_name").alias("country")
    )
    return (
        base.withColumn("nation_key", _draw("nation", user, 25))
        .join(names, "nation_key", "left")
        .withColumn(
            "city",
            F.concat_ws("-", "country", _draw("city", user, 3).cast("string")),
        )
    )


def feed_from_events(events: DataFrame, nation: DataFrame | None = None) -> DataFrame:
    """Feed log: clicks are likes; views, errors and signups are views.

    Without ``nation`` the country and city are NULL and no join is planned.
    """
    rows = _profiled(events.where(F.col("event_type") != "purchase"), nation)
    return conform(
        rows.withColumns(
            {
                "post_id": F.col("block") * 1000 + F.col("k") * 10 + F.floor(F.col("d") / 3),
                "action": F.when(F.col("event_type") == "click", "like").otherwise("view"),
            }
        ),
        FEED,
    )


def messages_from_events(events: DataFrame, nation: DataFrame | None = None) -> DataFrame:
    """Message log: each purchase is a message to the account numbered in its properties."""
    rows = _profiled(events.where(F.col("event_type") == "purchase"), nation)
    return conform(
        rows.withColumn("receiver_id", F.col("block") * 2 * BLOCK + F.col("k")), MESSAGES
    )


def load_events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{folder}/events.parquet")


def load_feed(spark: SparkSession, folder: str, located: bool = False) -> DataFrame:
    nation = spark.read.parquet(f"{folder}/nation.parquet") if located else None
    return feed_from_events(load_events(spark, folder), nation)


def load_messages(spark: SparkSession, folder: str, located: bool = False) -> DataFrame:
    nation = spark.read.parquet(f"{folder}/nation.parquet") if located else None
    return messages_from_events(load_events(spark, folder), nation)
