import math
import random
from decimal import ROUND_HALF_UP, Decimal
from statistics import mean, stdev

import pytest
from conftest import rows

from footfall.operators import posts


@pytest.fixture(scope="module")
def per_post(spark):
    random.seed(4)
    data = [(i, random.randint(1, 9) if i % 7 else None, random.randint(1, 40)) for i in range(200)]
    return spark.createDataFrame(data, "post_id long, `like` long, `view` long"), data


def test_actions_that_never_happened_are_missing(make_feed):
    feed = make_feed(
        [(1, "2024-01-01 10:00:00", "view", {"post_id": 1}), (2, "2024-01-01 10:00:00", "like", {"post_id": 2})]
    )
    assert rows(posts.post_actions(feed), "post_id", "like", "view") == [(1, None, 1), (2, 1, None)]


def test_describe_counts_missing_as_zero(per_post):
    df, data = per_post
    row = posts.describe(df, ["like"]).first()
    likes = sorted(x[1] or 0 for x in data)
    assert row["count"] == 200 and row["min"] == 0 and row["max"] == 9
    # a tie in the last digit rounds away from zero
    half_up = Decimal(str(mean(likes))).quantize(Decimal("0.01"), ROUND_HALF_UP)
    assert Decimal(str(row["mean"])) == half_up
    assert row["std"] == pytest.approx(stdev(likes), abs=0.0051)
    assert row["median"] == (likes[99] + likes[100]) / 2


def test_zscore_skips_missing(per_post):
    df, data = per_post
    known = [x[1] for x in data if x[1] is not None]
    for r in posts.zscore(df, ["like"]).collect():
        raw = data[r.post_id][1]
        if raw is None:
            assert r["like"] is None
        else:
            assert r["like"] == pytest.approx((raw - mean(known)) / stdev(known))


def test_shape(spark):
    df = spark.createDataFrame([(1, 5), (1, 5), (2, 5), (9, 5)], "a long, b long")
    got = {r.variable: r for r in posts.shape(df, ["a", "b"]).collect()}
    assert got["a"]["mode"] == 1.0 and got["a"]["median"] == 1.5 and got["a"]["longer_tail"] == "right"
    assert got["b"]["mode"] == 5.0


def test_qq_of_a_column_with_itself(per_post):
    df, _ = per_post
    table = posts.qq_table(df.withColumn("copy", df["view"]), "view", "copy", [0.1, 0.5, 0.9])
    assert all(r.quantile_view == r.quantile_copy for r in table.collect())
    assert table.count() == 3


def test_lifetime_counts_midnights(make_feed):
    feed = make_feed(
        [(1, "2024-01-01 23:59:00", "view", {"post_id": 1}), (1, "2024-01-02 00:01:00", "view", {"post_id": 1}),
         (1, "2024-01-01 00:01:00", "view", {"post_id": 2}), (1, "2024-01-01 23:59:00", "view", {"post_id": 2})]
    )
    stats = posts.post_stats(feed)
    assert rows(stats, "post_id", "life_time") == [(1, 1), (2, 0)]
    assert posts.mean_lifetime(stats).first()[0] == 0.5


def test_correlations(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0, 7.0), (2.0, 4.0, 7.0), (3.0, 6.0, 7.0), (4.0, None, 7.0)], "a double, b double, c double"
    )
    got = {(r.a, r.b): r.r for r in posts.corr_matrix(df, ["a", "b", "c"]).collect()}
    assert len(got) == 9
    assert got["a", "b"] == pytest.approx(1.0) == got["b", "a"]
    assert got["a", "c"] is None and got["c", "c"] is None  # constant


def test_correlation_against_formula(per_post):
    df, data = per_post
    pairs = [(x[1], x[2]) for x in data if x[1] is not None]
    ma, mb = mean(a for a, _ in pairs), mean(b for _, b in pairs)
    expected = sum((a - ma) * (b - mb) for a, b in pairs) / math.sqrt(
        sum((a - ma) ** 2 for a, _ in pairs) * sum((b - mb) ** 2 for _, b in pairs)
    )
    got = {(r.a, r.b): r.r for r in posts.corr_matrix(df, ["like", "view"]).collect()}
    assert got["like", "view"] == pytest.approx(expected)
