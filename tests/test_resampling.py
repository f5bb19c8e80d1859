import math
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from footfall.functions.hashing import poisson1, poisson1_thresholds, seeded_hash, seeded_index
from footfall.operators import resampling
from oracle.hashing import hash_int


@pytest.fixture(scope="module")
def users(spark):
    random.seed(9)
    data = [(g, 1000 * g + u, random.randint(0, 5), random.randint(1, 9)) for g in (2, 3) for u in range(120)]
    return spark.createDataFrame(data, "exp_group int, user_id long, likes long, views long").withColumn(
        "ctr", F.col("likes") / F.col("views")
    )


@pytest.mark.parametrize("n", [2, 10, 60, 120])
def test_samples_are_distinct_and_full(spark, n):
    draws = resampling._draw_positions(spark, 2, 120, n, 200, 7)
    per = draws.groupBy("iteration").agg(
        F.count("*").alias("n"), F.count_distinct("position").alias("d"),
        F.min("position").alias("low"), F.max("position").alias("high"),
    )
    assert per.count() == 200
    assert per.where(f"n <> {n} or d <> {n} or low < 0 or high > 119").count() == 0


@pytest.mark.parametrize("n", [3, 10, 60])
def test_every_position_is_equally_likely(spark, n):
    hits = resampling._draw_positions(spark, 2, 120, n, 3000, 7).groupBy("position").count().collect()
    expected = 3000 * n / 120
    sd = math.sqrt(expected * (1 - n / 120))
    assert len(hits) == 120
    assert all(abs(r["count"] - expected) < 5 * sd for r in hits)


def test_whole_group_can_be_the_sample(spark):
    assert resampling._draw_positions(spark, 2, 5, 5, 10, 1).count() == 50


def test_a_group_below_the_sample_shows_its_size_and_no_statistic(users):
    sizes = {r.exp_group: r["count"] for r in users.where("ctr IS NOT NULL").groupBy("exp_group").count().collect()}
    tests = resampling.aa_simulation(users, 2, 3, 10, 500)
    assert rows(tests, "iteration", "n_a", "n_b", "mean_a", "var_b", "t", "dof", "p_value") == [
        (i, sizes[2], sizes[3], None, None, None, None, None) for i in range(10)
    ]
    report = resampling.false_positive_rate(tests).first()
    assert (report["tests"], report["false_positive_pct"], report["split_is_sound"]) == (0, None, None)


def test_one_short_group_leaves_the_other_sampled(users):
    few = users.where("exp_group = 2").orderBy("user_id").limit(3).unionByName(users.where("exp_group = 3"))
    tests = resampling.aa_simulation(few, 2, 3, iterations=4, n=20)
    assert {(r.n_a, r.n_b, r.mean_a, r.t, r.p_value) for r in tests.collect()} == {(3, 20, None, None, None)}
    assert tests.where("mean_b IS NULL OR var_b IS NULL").count() == 0
    none = resampling.aa_simulation(users.where("exp_group = 3"), 2, 3, iterations=2, n=20)
    assert {(r.n_a, r.n_b, r.t) for r in none.collect()} == {(0, 20, None)}


@pytest.mark.parametrize("n", [2, 3])
def test_smallest_samples_have_statistics(users, n):
    tests = resampling.aa_simulation(users, 2, 3, iterations=50, n=n)
    assert {(r.n_a, r.n_b) for r in tests.collect()} == {(n, n)}
    assert tests.where("p_value IS NOT NULL AND p_value BETWEEN 0 AND 1").count() == tests.where("t IS NOT NULL").count() > 0


def test_the_sample_is_as_large_as_asked_for(users):
    tests = resampling.aa_simulation(users, 2, 3, iterations=5, n=100)
    assert {(r.n_a, r.n_b) for r in tests.collect()} == {(100, 100)}


def test_one_rule_draws_from_any_size(spark):
    """Sizes on either side of a square, and one that more than 32 bits number."""
    for size in (1, 2, 15, 16, 17, 2000, 3_000_000_000):
        n = min(size, 500)
        drawn = [r.position for r in resampling._draw_positions(spark, 2, size, n, 1, 3).collect()]
        assert len(set(drawn)) == n and min(drawn) >= 0 and max(drawn) < size


def test_pairs_are_drawn_together_as_often_as_any_other(spark):
    """Samples of two out of six: all fifteen pairs."""
    draws = resampling._draw_positions(spark, 2, 6, 2, 6000, 5).groupBy("iteration").agg(
        F.array_sort(F.collect_list("position")).alias("pair")
    )
    counts = [r["count"] for r in draws.groupBy("pair").count().collect()]
    assert len(counts) == 15
    assert all(abs(c - 400) < 5 * math.sqrt(400) for c in counts)


def test_simulation_is_repeatable_and_calibrated(users):
    tests = resampling.aa_simulation(users, 2, 3, iterations=1500, n=20, seed=5)
    again = resampling.aa_simulation(users.repartition(5), 2, 3, iterations=1500, n=20, seed=5)
    assert rows(tests, "iteration", F.round("t", 9)) == rows(again, "iteration", F.round("t", 9))
    report = resampling.false_positive_rate(tests).first()
    assert report["tests"] == 1500
    assert 1 < report["false_positive_pct"] < 12


def test_false_positive_rate_skips_undefined(spark):
    p = spark.createDataFrame([(0.01,), (0.05,), (0.5,), (None,)], "p_value double")
    row = resampling.false_positive_rate(p).first()
    assert (row["tests"], row["false_positive_pct"], row["split_is_sound"]) == (3, 66.67, False)


def test_poisson_weights_have_the_right_distribution(spark):
    n = 400_000
    draws = spark.range(n).select(poisson1(seeded_hash(3, F.col("id"))).alias("w"))
    counts = {r["w"]: r["count"] for r in draws.groupBy("w").count().collect()}
    for k in range(6):
        p = math.exp(-1) / math.factorial(k)
        assert abs(counts[k] - n * p) < 5 * math.sqrt(n * p * (1 - p))


def test_thresholds_rise_within_32_bits():
    bounds = poisson1_thresholds()
    assert bounds == sorted(set(bounds)) and 0 < bounds[0] and bounds[-1] < 2**32
    assert bounds[0] / 2**32 == pytest.approx(math.exp(-1), abs=1e-9)


def test_index_draws_cover_a_large_range(spark):
    size = 3_000_000_000  # more than 32 bits can spread evenly
    drawn = spark.range(20_000).select(seeded_index(1, size, F.col("id")).alias("i"))
    low = drawn.where(F.col("i") < size // 2).count()
    assert abs(low - 10_000) < 5 * math.sqrt(5_000)
    assert drawn.where((F.col("i") < 0) | (F.col("i") >= size)).count() == 0


def test_bootstrap_replicates(users):
    boot = resampling.poisson_bootstrap(users, n=400, seed=1)
    assert boot.count() == 800
    overall = users.groupBy("exp_group").agg((F.sum("likes") / F.sum("views")).alias("r"))
    averages = boot.groupBy("exp_group").agg(F.avg("replicate_ctr").alias("m"), F.stddev("replicate_ctr").alias("s"))
    for r in overall.join(averages, "exp_group").collect():
        assert abs(r["m"] - r["r"]) < 5 * r["s"] / math.sqrt(400)


def test_pooled_bootstrap_has_the_same_distribution(users):
    each = resampling.poisson_bootstrap(users, n=1500, seed=1)
    pooled = resampling.pooled_bootstrap(users, n=1500, seed=1)
    again = resampling.pooled_bootstrap(users.repartition(7), n=1500, seed=1)
    assert rows(pooled) == rows(again)

    def spread(df):
        stats = df.groupBy("exp_group").agg(
            F.avg("replicate_ctr").alias("m"), F.stddev("replicate_ctr").alias("s"), F.avg("views").alias("v")
        )
        return {r.exp_group: r for r in stats.collect()}

    a, b = spread(each), spread(pooled)
    for g in (2, 3):
        assert abs(a[g].m - b[g].m) < 5 * a[g].s / math.sqrt(750)
        assert 0.85 < a[g].s / b[g].s < 1.15
        assert a[g].v == pytest.approx(b[g].v, rel=0.02)


def test_bucket_bootstrap_spreads_like_users(spark):
    random.seed(12)
    data = [(1, u, random.randint(0, 5), random.randint(1, 9)) for u in range(4000)]
    many = spark.createDataFrame(data, "exp_group int, user_id long, likes long, views long")
    bucketed = resampling.bucket_bootstrap(many, 200, n=1000, seed=1)
    assert rows(bucketed) == rows(resampling.bucket_bootstrap(many.repartition(3), 200, n=1000, seed=1))
    stats = [df.agg(F.avg("replicate_ctr").alias("m"), F.stddev("replicate_ctr").alias("s")).first()
             for df in (bucketed, resampling.poisson_bootstrap(many, n=1000, seed=1))]
    assert abs(stats[0].m - stats[1].m) < 5 * stats[1].s / math.sqrt(500)
    assert 0.8 < stats[0].s / stats[1].s < 1.2


def test_bootstrap_difference(spark):
    data = [(1, i, 0.2) for i in range(4)] + [(2, i, 0.3 + 0.1 * i) for i in range(4)]
    row = resampling.bootstrap_diff(
        spark.createDataFrame(data, "exp_group int, replicate int, replicate_ctr double"), 2, 1
    ).first()
    assert row["replicates"] == 4 and row["excludes_zero"]
    assert row["mean_diff"] == pytest.approx(0.25)
    assert row["low_diff"] == pytest.approx(0.1 + 0.075 * 0.1)


def test_constant_hash_agrees_with_the_engine(spark):
    for value in (0, 1, 11, 23, 2**31 - 1):
        assert spark.range(1).select(F.hash(F.lit(value))).first()[0] & 0xFFFFFFFF == hash_int(value)
