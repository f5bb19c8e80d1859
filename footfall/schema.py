"""Column contracts of the two logs and of the daily mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_PROFILE = [
    T.StructField("age", T.IntegerType()),
    T.StructField("os", T.StringType()),
    T.StructField("gender", T.IntegerType()),
    T.StructField("country", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("exp_group", T.IntegerType()),
]

#: One row per user action on a post; ``action`` is ``view`` or ``like``.
FEED = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("post_id", T.LongType()),
        T.StructField("time", T.TimestampNTZType()),
        T.StructField("action", T.StringType()),
        *_PROFILE,
    ]
)

#: One row per message sent; ``user_id`` is the sender.
MESSAGES = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("receiver_id", T.LongType()),
        T.StructField("time", T.TimestampNTZType()),
        *_PROFILE,
    ]
)

MART_COUNTS = [
    "views",
    "likes",
    "messages_received",
    "messages_sent",
    "users_received",
    "users_sent",
]

#: Long-form daily mart, partitioned by ``event_date`` on disk.
MART = T.StructType(
    [
        T.StructField("event_date", T.DateType()),
        T.StructField("dimension", T.StringType()),
        T.StructField("dimension_value", T.StringType()),
        *[T.StructField(name, T.LongType()) for name in MART_COUNTS],
    ]
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto ``schema``, casting where needed; fail on a missing column."""
    missing = [f.name for f in schema if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing from input: {', '.join(missing)}")
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema])
