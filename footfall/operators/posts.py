"""Post-level statistics: describe, shape, standardising, quantile comparison, correlation."""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions.ratios import likes, ratio, views
from footfall.operators.ranks import quantiles, quantiles_of, value_table

QUARTILES = {0.25: "q25", 0.5: "median", 0.75: "q75"}


def post_actions(feed: DataFrame) -> DataFrame:
    """Actions per post, one column per action; an action that never happened is NULL."""
    def seen(column):
        return F.nullif(column, F.lit(0))

    return feed.groupBy("post_id").agg(seen(likes()).alias("like"), seen(views()).alias("view"))


def long_form(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(variable, value)`` rows of the given columns."""
    return df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], columns, "variable", "value"
    )


def _power_sum(power: int) -> Column:
    """Sum of the powered deviations from the group's mean, over a value table."""
    return F.sum(F.col("n") * F.pow(F.col("value") - F.col("mean"), F.lit(power)))


def describe(df: DataFrame, columns: list[str], digits: int = 2) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum; missing counts as 0."""
    values = value_table(long_form(df.na.fill(0, columns), columns), ["variable"], "value")
    basics = values.groupBy("variable").agg(
        F.sum("n").alias("count"),
        F.round(F.max("mean"), digits).alias("mean"),
        F.round(F.sqrt(ratio(_power_sum(2), F.sum("n") - 1)), digits).alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    quarters = quantiles_of(values, ["variable"], list(QUARTILES))
    wide = quarters.groupBy("variable").agg(
        *[
            F.round(F.max(F.when(F.col("prob") == p, F.col("quantile"))), digits).alias(name)
            for p, name in QUARTILES.items()
        ]
    )
    return basics.join(wide, "variable").select(
        "variable", "count", "mean", "std", "min", *QUARTILES.values(), "max"
    )


def shape(df: DataFrame, columns: list[str]) -> DataFrame:
    """Skewness, mode, mean and median per column, and the side of the longer tail.

    The mode is the smallest of the most frequent values; skewness is the population form.
    """
    values = value_table(long_form(df, columns), ["variable"], "value").where(F.col("n") > 0)
    second, third = _power_sum(2) / F.sum("n"), _power_sum(3) / F.sum("n")
    basics = values.groupBy("variable").agg(
        ratio(third, F.pow(second, F.lit(1.5))).alias("skewness"),
        F.max("mean").alias("mean"),
        (-F.max(F.struct("n", (-F.col("value")).alias("negated")))["negated"]).alias("mode"),
    )
    median = quantiles_of(values, ["variable"], [0.5]).select(
        "variable", F.col("quantile").alias("median")
    )
    tail = (
        F.when(F.col("skewness") > 0, "right").when(F.col("skewness") < 0, "left").otherwise("none")
    )
    return basics.join(median, "variable").withColumn("longer_tail", tail)


def zscore(df: DataFrame, columns: list[str]) -> DataFrame:
    """Standardise columns by mean and sample deviation, leaving missing values missing."""
    stats = df.select(
        F.struct(
            *[F.avg(c).alias(f"mean_{c}") for c in columns],
            *[F.stddev_samp(c).alias(f"std_{c}") for c in columns],
        )
    ).scalar()
    return df.withColumns(
        {c: ratio(F.col(c) - stats[f"mean_{c}"], stats[f"std_{c}"]) for c in columns}
    )


def qq_table(df: DataFrame, a: str, b: str, probs: list[float]) -> DataFrame:
    """Quantiles of two columns side by side at the given probabilities."""
    table = quantiles(long_form(df, [a, b]), ["variable"], "value", probs)
    return table.groupBy("prob").agg(
        *[
            F.max(F.when(F.col("variable") == c, F.col("quantile"))).alias(f"quantile_{c}")
            for c in (a, b)
        ]
    )


def post_stats(feed: DataFrame) -> DataFrame:
    """Likes, views, CTR, first and last action and lifetime in midnights crossed, per post."""
    return (
        feed.groupBy("post_id")
        .agg(
            likes().alias("likes"),
            views().alias("views"),
            F.min("time").alias("min_time"),
            F.max("time").alias("max_time"),
        )
        .withColumn("ctr", ratio(F.col("likes"), F.col("views")))
        .withColumn("life_time", F.datediff("max_time", "min_time"))
    )


def post_ctr(actions: DataFrame) -> DataFrame:
    """CTR per post from ``post_actions``; NULL where either action is missing."""
    return actions.withColumn("ctr", ratio(F.col("like"), F.col("view")))


def mean_lifetime(posts: DataFrame) -> DataFrame:
    """Mean lifetime over all posts, in days."""
    return posts.agg(F.avg("life_time").alias("avg_life_time_days"))


def _correlation(a: str, b: str) -> Column:
    """Pearson correlation over complete pairs; NULL when either side is constant."""
    complete = F.col(a).isNotNull() & F.col(b).isNotNull()
    x, y = (F.when(complete, F.col(c).cast("double")) for c in (a, b))
    return ratio(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def corr_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlations in long form, both triangles, from one aggregation."""
    pairs = list(combinations_with_replacement(columns, 2))
    one_row = df.agg(*[_correlation(a, b).alias(f"{a}|{b}") for a, b in pairs])
    entries = []
    for a, b in pairs:
        for x, y in dict.fromkeys([(a, b), (b, a)]):
            entries.append(
                F.struct(F.lit(x).alias("a"), F.lit(y).alias("b"), F.col(f"{a}|{b}").alias("r"))
            )
    return one_row.select(F.explode(F.array(*entries)).alias("e")).select("e.*")
