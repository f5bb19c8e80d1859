"""Experiment splits, per-user metrics and significance tests."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions.calendar import within_days
from footfall.functions.hashing import salted_hash
from footfall.functions.ratios import likes, ratio, views
from footfall.functions.tails import normal_two_sided_p, t_two_sided_p
from footfall.operators.ranks import quantiles_of, running_totals, value_table

GROUP = "exp_group"


def assign_group(df: DataFrame, salt: str, n: int, name: str = "split_group") -> DataFrame:
    """Split users into ``n`` groups by a salted hash of their id."""
    return df.withColumn(name, (salted_hash(salt, F.col("user_id")) % n).cast("int"))


def user_ctr(feed: DataFrame, first: date, last: date, groups: list[int]) -> DataFrame:
    """Likes, views and CTR per user of the chosen groups; CTR is NULL without a view."""
    return (
        within_days(feed, first, last)
        .where(F.col(GROUP).isin(groups))
        .groupBy(GROUP, "user_id")
        .agg(likes().alias("likes"), views().alias("views"))
        .withColumn("ctr", ratio(F.col("likes"), F.col("views")))
    )


def pick_groups(users: DataFrame, groups: list[int]) -> DataFrame:
    """The users of the given groups."""
    return users.where(F.col(GROUP).isin(groups))


def group_sizes(users: DataFrame, metric: str = "ctr") -> DataFrame:
    """Users per group, and how many have the metric defined."""
    return users.groupBy(GROUP).agg(F.count("*").alias("users"), F.count(metric).alias(f"with_{metric}"))


def moments(metric: str, where: Column, prefix: str) -> list[Column]:
    """Count, mean and sample variance of a metric over the rows that satisfy ``where``."""
    value = F.when(where, F.col(metric).cast("double"))
    return [
        F.count(value).alias(f"n_{prefix}"),
        F.avg(value).alias(f"mean_{prefix}"),
        F.var_samp(value).alias(f"var_{prefix}"),
    ]


def welch_columns(df: DataFrame) -> DataFrame:
    """Add Welch's t, its degrees of freedom and p to rows of ``moments`` for a and b.

    A group of fewer than two values, or two constant groups, gives NULL.
    """
    share = {g: ratio(F.col(f"var_{g}"), F.col(f"n_{g}")) for g in "ab"}
    enough = (F.col("n_a") > 1) & (F.col("n_b") > 1)
    error = F.when(enough, F.sqrt(share["a"] + share["b"]))
    freedom = ratio(
        F.pow(share["a"] + share["b"], F.lit(2)),
        ratio(F.pow(share["a"], F.lit(2)), F.col("n_a") - 1)
        + ratio(F.pow(share["b"], F.lit(2)), F.col("n_b") - 1),
    )
    return (
        df.withColumn("diff", F.col("mean_a") - F.col("mean_b"))
        .withColumn("t", ratio(F.col("diff"), error))
        .withColumn("dof", F.when(enough, freedom))
        .withColumn("p_value", t_two_sided_p("t", "dof"))
    )


def welch(users: DataFrame, metric: str, a: int, b: int, group: str = GROUP) -> DataFrame:
    """Welch's t-test of ``metric`` between groups ``a`` and ``b``; ``diff`` is mean a − mean b.

    Undefined values are left out and counted in ``n_excluded``.
    """
    rows = users.where(F.col(group).isin([a, b]))
    stats = rows.agg(
        *moments(metric, F.col(group) == a, "a"),
        *moments(metric, F.col(group) == b, "b"),
        F.count_if(F.col(metric).isNull()).alias("n_excluded"),
    )
    return welch_columns(stats)


def mann_whitney(users: DataFrame, metric: str, a: int, b: int, group: str = GROUP) -> DataFrame:
    """Mann–Whitney U of group ``a`` against ``b``: tie- and continuity-corrected, two-sided.

    Works on distinct values with a count per group, so ties cost nothing and no
    window ever spans the population.
    """
    counts = (
        users.where(F.col(group).isin([a, b]) & F.col(metric).isNotNull())
        .groupBy(F.col(metric).cast("double").alias("value"))
        .agg(
            F.count_if(F.col(group) == a).alias("n_a"),
            F.count_if(F.col(group) == b).alias("n_b"),
        )
    )
    ranked = running_totals(counts, [], ["value"], {"below_b": "n_b"}, "mann-whitney")
    tied = (F.col("n_a") + F.col("n_b")).cast("double")
    stats = ranked.agg(
        F.sum("n_a").alias("n_a"),
        F.sum("n_b").alias("n_b"),
        F.sum(F.col("n_a") * (F.col("below_b") + F.col("n_b") / 2)).alias("u"),
        F.sum(tied * tied * tied - tied).alias("ties"),
    )
    pairs = F.col("n_a").cast("double") * F.col("n_b")
    size = (F.col("n_a") + F.col("n_b")).cast("double")
    variance = pairs / 12 * (size + 1 - ratio(F.col("ties"), size * (size - 1)))
    larger = F.greatest(F.col("u"), pairs - F.col("u"))
    z = ratio(larger - pairs / 2 - 0.5, F.sqrt(variance))
    p_value = F.least(normal_two_sided_p(F.greatest(F.col("z"), F.lit(0.0))), F.lit(1.0))
    return (
        stats.withColumn("z", z)
        .withColumn("p_value", F.when(F.col("z").isNotNull(), p_value))
        .drop("ties")
    )


def overall_ctr(users: DataFrame, groups: list[int]) -> DataFrame:
    """All likes over all views per group: at most one row per listed group."""
    return (
        pick_groups(users, groups)
        .groupBy(GROUP)
        .agg(F.sum("likes").alias("likes"), F.sum("views").alias("views"))
        .withColumn("overall_ctr", ratio(F.col("likes"), F.col("views")))
    )


def smoothed_ctr(users: DataFrame, groups: list[int], alpha: float = 5.0) -> DataFrame:
    """Per-user CTR pulled towards the group's overall CTR with weight ``alpha``."""
    overall = overall_ctr(users, groups).select(GROUP, "overall_ctr")
    smoothed = ratio(
        F.col("likes") + F.lit(alpha) * F.col("overall_ctr"), F.col("views") + F.lit(alpha)
    )
    # One row per listed group, so the broadcast does not grow with the data.
    return pick_groups(users, groups).join(F.broadcast(overall), GROUP).select(
        *users.columns, smoothed.alias("smoothed_ctr")
    )


def linearized(users: DataFrame, pairs: list[tuple[int, int]]) -> DataFrame:
    """``likes − control CTR · views`` per user, for (control, test) pairs of groups."""
    control_of = {g: control for control, test in pairs for g in (control, test)}
    if len(control_of) != 2 * len(pairs):
        raise ValueError("a group may occur in one pair only")
    # One entry per listed group. Totalled over all of them, so that this reads the
    # same shuffle of users as the rows below.
    overall = overall_ctr(users, list(control_of)).agg(
        F.map_from_entries(F.collect_list(F.struct(GROUP, "overall_ctr")))
    )
    control = F.lit(None).cast("int")
    for g, c in control_of.items():
        control = F.when(F.col(GROUP) == g, F.lit(c)).otherwise(control)
    return (
        pick_groups(users, list(control_of))
        .withColumn("control", control)
        .withColumn("control_ctr", F.try_element_at(overall.scalar(), F.col("control")))
        .withColumn("linearized_likes", F.col("likes") - F.col("control_ctr") * F.col("views"))
    )


def welch_linearized(users: DataFrame, pairs: list[tuple[int, int]]) -> DataFrame:
    """Welch's test on linearized likes for every pair, control first, in one pass."""
    rows = linearized(users, pairs)
    is_control = F.col(GROUP) == F.col("control")
    stats = rows.groupBy(F.col("control").alias("control_group")).agg(
        F.max(F.when(~is_control, F.col(GROUP))).alias("test_group"),
        *moments("linearized_likes", is_control, "a"),
        *moments("linearized_likes", ~is_control, "b"),
    )
    return welch_columns(stats)


def bucketize(users: DataFrame, n: int = 50, salt: str = "bucket", prob: float = 0.9) -> DataFrame:
    """Hash users into ``n`` buckets per group: bucket CTR and a quantile of user CTR.

    The quantile is the sorted element at ``floor(p * users)``; users without a
    CTR do not take part in it.
    """
    placed = users.withColumn("bucket", (salted_hash(salt, F.col("user_id")) % n).cast("int"))
    keys = [GROUP, "bucket"]
    values = value_table(
        placed,
        keys,
        "ctr",
        {"users": F.count("*"), "likes": F.sum("likes"), "views": F.sum("views")},
    )
    totals = values.groupBy(*keys).agg(
        F.sum("users").alias("users"),
        ratio(F.sum("likes"), F.sum("views")).alias("bucket_ctr"),
    )
    top = quantiles_of(values, keys, [prob], "index").select(*keys, F.col("quantile").alias("ctr9"))
    return totals.join(top, keys, "left")
