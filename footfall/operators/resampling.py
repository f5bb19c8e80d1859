"""A/A simulation and Poisson bootstrap.

Draws are hashes, so re-run tasks repeat them; nothing is sampled with ``rand()``.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions.hashing import poisson1, salted_hash, seeded_hash
from footfall.functions.ratios import ratio
from footfall.operators.experiments import GROUP, moments, welch_columns
from footfall.operators.ranks import positions

_ROUNDS = 4


def _draw_positions(spark, group: int, size: int, n: int, iterations: int, seed: int) -> DataFrame:
    """``n`` distinct positions out of ``size`` for every iteration, without a shuffle.

    Each iteration permutes the numbers below the next square with a keyed Feistel
    network and takes the first ``n`` images that are positions. The square exceeds the
    size by about two parts in its root, so the cost depends on ``n`` alone, and one rule
    serves every size.
    """
    if size < n:
        raise ValueError(f"group {group} has {size} users, fewer than the sample of {n}")
    side = math.isqrt(size - 1) + 1
    # the images below ``size`` are ten deviations more than needed, or all there are
    attempts = min(side * side, math.ceil(n * side * side / size) + 10 * math.isqrt(n) + 20)

    def image(j: Column) -> Column:
        left, right = F.floor(j / side).cast("bigint"), j % side
        for turn in range(_ROUNDS):
            key = seeded_hash(seed + turn, F.lit(group), F.col("iteration"), right)
            left, right = right, (left + key) % side
        return left * side + right

    tried = F.transform(F.sequence(F.lit(0).cast("bigint"), F.lit(attempts - 1).cast("bigint")), image)
    drawn = F.slice(F.filter(tried, lambda p: p < size), 1, n)
    return (
        spark.range(iterations)
        .withColumnRenamed("id", "iteration")
        .select("iteration", F.explode(drawn).alias("position"))
    )


def aa_simulation(
    users: DataFrame,
    a: int,
    b: int,
    iterations: int = 10_000,
    n: int = 500,
    seed: int = 11,
    metric: str = "ctr",
) -> DataFrame:
    """Repeated t-tests between samples without replacement from two equal groups.

    One row per iteration with the moments of both samples, t, degrees of freedom
    and p. Users with an undefined metric are not sampled. A group of fewer than ``n``
    users has no sample: every row gives its size and null statistics.
    Numbering the users runs jobs and writes a scratch table.
    """
    spark = users.sparkSession
    pool = users.where(F.col(GROUP).isin([a, b]) & F.col(metric).isNotNull()).select(
        GROUP, "user_id", metric
    )
    numbered = positions(pool, [GROUP], "user_id", "position", "aa-users")
    counted = numbered.groupBy(GROUP).agg(F.count("*").alias("size"))
    sizes = {row[GROUP]: row["size"] for row in counted.collect()}  # two rows
    sampled = []
    for side, group in (("a", a), ("b", b)):
        size = sizes.get(group, 0)
        if size < n:
            sampled.append(_without_sample(spark, size, iterations, side))
            continue
        draws = _draw_positions(spark, group, size, n, iterations, seed)
        members = numbered.where(F.col(GROUP) == group).select("position", metric)
        sampled.append(
            draws.join(members, "position")
            .groupBy("iteration")
            .agg(*moments(metric, F.lit(True), side))
            .withColumn(f"n_{side}", _complete(F.col(f"n_{side}"), n))
        )
    # both sides are already partitioned by iteration
    return welch_columns(sampled[0].join(sampled[1], "iteration"))


def _without_sample(spark: SparkSession, size: int, iterations: int, side: str) -> DataFrame:
    undefined = F.lit(None).cast("double")
    return spark.range(iterations).select(
        F.col("id").alias("iteration"),
        F.lit(size).cast("bigint").alias(f"n_{side}"),
        undefined.alias(f"mean_{side}"),
        undefined.alias(f"var_{side}"),
    )


def _complete(drawn: Column, n: int) -> Column:
    """The number drawn, or an error if an iteration found too few distinct users."""
    error = F.raise_error(F.lit("an iteration drew too few distinct users")).cast("bigint")
    return F.when(drawn < n, error).otherwise(drawn)


def false_positive_rate(tests: DataFrame, level: float = 0.05) -> DataFrame:
    """Percentage of tests at or below the level, and whether the split looks sound."""
    rate = F.round(
        ratio(F.count_if(F.col("p_value") <= level), F.count("p_value")) * 100, 2
    )
    return tests.agg(F.count("p_value").alias("tests"), rate.alias("false_positive_pct")).withColumn(
        "split_is_sound", F.col("false_positive_pct") <= F.lit(level * 100)
    )


def poisson_bootstrap(users: DataFrame, n: int = 2000, seed: int = 23) -> DataFrame:
    """Overall CTR of each group in ``n`` bootstrap replicates.

    Every user gets a Poisson(1) weight per replicate. Rows are generated and summed
    inside the task that reads the user, so only groups × replicates rows leave it.
    """
    weighted = users.select(
        GROUP,
        "user_id",
        "likes",
        "views",
        F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("replicate"),
    ).withColumn("w", poisson1(seeded_hash(seed, F.col("user_id"), F.col("replicate"))))
    return (
        weighted.groupBy(GROUP, "replicate")
        .agg(
            F.sum(F.col("w") * F.col("likes")).alias("likes"),
            F.sum(F.col("w") * F.col("views")).alias("views"),
        )
        .withColumn("replicate_ctr", ratio(F.col("likes"), F.col("views")))
    )


def bucket_bootstrap(
    users: DataFrame, buckets: int = 50, n: int = 2000, seed: int = 23, salt: str = "bucket"
) -> DataFrame:
    """The bootstrap over salted-hash buckets of users, which is the one to use at any size.

    Buckets are independent groups of users, so weighting them resamples users; the work
    is groups × buckets × replicates however many users there are.
    """
    placed = users.withColumn("bucket", salted_hash(salt, F.col("user_id")) % buckets)
    sums = placed.groupBy(GROUP, "bucket").agg(F.sum("likes").alias("likes"), F.sum("views").alias("views"))
    weighted = sums.select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("replicate")
    ).withColumn("w", poisson1(seeded_hash(seed, F.col(GROUP), F.col("bucket"), F.col("replicate"))))
    return (
        weighted.groupBy(GROUP, "replicate")
        .agg(
            F.sum(F.col("w") * F.col("likes")).alias("likes"),
            F.sum(F.col("w") * F.col("views")).alias("views"),
        )
        .withColumn("replicate_ctr", ratio(F.col("likes"), F.col("views")))
    )


def pooled_bootstrap(users: DataFrame, n: int = 2000, seed: int = 23, parts: int = 64) -> DataFrame:
    """The per-user bootstrap's exact distribution at the cost of distinct (likes, views) pairs.

    Users of a group with equal likes and views are pooled: the sum of their
    independent Poisson(1) weights is one Poisson draw with their number as the mean.
    Pooled rows are dealt to ``parts`` by hash; a part sorts its rows and draws matrices
    from a generator of its own, so the result does not depend on how rows are placed.
    """
    pooled = (
        users.groupBy(GROUP, "likes", "views")
        .agg(F.count("*").alias("members"))
        .withColumn("part", F.pmod(F.xxhash64(GROUP, "likes", "views"), F.lit(parts)))
    )

    def weigh(key, rows):
        group, part = key
        rows = rows.sort_values(["likes", "views"])
        rng = np.random.Generator(np.random.Philox(key=[seed, (int(group) & 0xFFFFFFFF) << 20 | int(part)]))
        likes, views = np.zeros(n, "int64"), np.zeros(n, "int64")
        for low in range(0, len(rows), 256):
            some = rows.iloc[low : low + 256]
            weights = rng.poisson(some["members"].to_numpy()[:, None], (len(some), n))
            likes += some["likes"].to_numpy() @ weights
            views += some["views"].to_numpy() @ weights
        return pd.DataFrame({GROUP: group, "replicate": np.arange(n), "likes": likes, "views": views})

    partial = pooled.groupBy(GROUP, "part").applyInPandas(
        weigh, f"{GROUP} int, replicate int, likes bigint, views bigint"
    )
    return (
        partial.groupBy(GROUP, "replicate")
        .agg(F.sum("likes").alias("likes"), F.sum("views").alias("views"))
        .withColumn("replicate_ctr", ratio(F.col("likes"), F.col("views")))
    )


def bootstrap_diff(replicates: DataFrame, a: int, b: int) -> DataFrame:
    """Spread of the replicate differences (a − b) and whether they leave out zero.

    There is one difference per replicate, so the exact percentiles are over a
    number of rows fixed by the caller.
    """
    ctr = {
        g: F.max(F.when(F.col(GROUP) == g, F.col("replicate_ctr"))) for g in (a, b)
    }
    diffs = replicates.groupBy("replicate").agg((ctr[a] - ctr[b]).alias("d"))
    return diffs.agg(
        F.count("d").alias("replicates"),
        F.avg("d").alias("mean_diff"),
        F.min("d").alias("min_diff"),
        F.percentile("d", 0.025).alias("low_diff"),
        F.percentile("d", 0.975).alias("high_diff"),
        F.max("d").alias("max_diff"),
    ).withColumn("excludes_zero", (F.col("min_diff") > 0) | (F.col("max_diff") < 0))
