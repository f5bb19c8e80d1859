from datetime import datetime, timedelta

import numpy as np
import pytest
from conftest import rows

from footfall.functions.smoothing import LocalLine, bisquare, moving_average, robust_stl
from footfall.operators import series

START = datetime(2024, 1, 1)


def weighted_line(y, span, x, weight=None):
    """A local line by plain weighted least squares at one point."""
    n, width = len(y), min(span, len(y))
    left = min(max(x - (span - 1) // 2, 0), n - width)
    where = np.arange(left, left + width)
    reach = max(x - left, left + width - 1 - x) + max(0, (span - n) // 2)
    r = np.abs(where - x) / reach
    w = np.where(r <= 0.001, 1.0, np.where(r <= 0.999, (1 - r**3) ** 3, 0.0))
    if weight is not None:
        w = w * weight[where]
    slope, level = np.polyfit(where, y[where], 1, w=np.sqrt(w))
    return slope * x + level


@pytest.mark.parametrize("n,span", [(40, 7), (40, 25), (12, 25), (30, 7)])
def test_local_line_is_weighted_least_squares(n, span):
    rng = np.random.default_rng(n + span)
    y, weight = rng.normal(size=n), rng.uniform(0.2, 1, size=n)
    at = np.arange(-1, n + 1)
    fit = LocalLine(n, span, at)
    np.testing.assert_allclose(fit(y), [weighted_line(y, span, x) for x in at], atol=1e-8)
    np.testing.assert_allclose(fit(y, weight), [weighted_line(y, span, x, weight) for x in at], atol=1e-8)


def test_moving_average():
    np.testing.assert_allclose(moving_average(np.arange(6.0), 3), [1, 2, 3, 4])


def test_exact_trend_and_season_are_recovered():
    t = np.arange(24 * 12.0)
    season = 5 * np.sin(2 * np.pi * t / 24)
    trend, seasonal, weight = robust_stl(10 + 0.1 * t + season, 24)
    np.testing.assert_allclose(trend, 10 + 0.1 * t, atol=0.02)
    np.testing.assert_allclose(seasonal, season, atol=0.02)


def test_outliers_are_left_to_the_remainder():
    rng = np.random.default_rng(1)
    t = np.arange(24 * 14.0)
    y = 50 + 8 * np.cos(2 * np.pi * t / 24) + rng.normal(scale=0.5, size=len(t))
    spiked = y.copy()
    spiked[100] += 60
    trend, seasonal, weight = robust_stl(spiked, 24)
    clean_trend, clean_seasonal, _ = robust_stl(y, 24)
    assert weight[100] < 0.01
    assert abs((spiked - trend - seasonal)[100] - 60) < 3
    np.testing.assert_allclose(trend, clean_trend, atol=0.5)


def test_bisquare_of_a_perfect_fit():
    assert (bisquare(np.zeros(5)) == 1).all()


def hourly(spark, values, name="all", skip=()):
    data = [(name, START + timedelta(hours=i), int(v)) for i, v in enumerate(values) if i not in skip]
    return spark.createDataFrame(data, "series string, day_h timestamp_ntz, actions long")


def test_parts_sum_to_the_series(spark):
    rng = np.random.default_rng(2)
    values = rng.integers(0, 40, 24 * 8)
    both = hourly(spark, values).unionByName(hourly(spark, values[::-1], "other"))
    parts = series.decompose(both).collect()
    assert len(parts) == 2 * len(values)
    for r in parts:
        assert r.trend + r.seasonal + r.resid == pytest.approx(r.observed)


def test_too_short_a_series_has_no_parts(spark):
    assert all(r.trend is None or np.isnan(r.trend) for r in series.decompose(hourly(spark, [1] * 30)).collect())


def test_missing_hours_become_zero(spark):
    filled = series.fill_hours(hourly(spark, [5] * 10, skip=(3, 4)))
    assert [r.actions for r in filled.orderBy("day_h").collect()] == [5, 5, 5, 0, 0, 5, 5, 5, 5, 5]


def test_classical_parts(spark):
    t = np.arange(24 * 6)
    values = 100 + t + np.where(t % 24 == 7, 24, 0)
    got = series.classical_decompose(hourly(spark, values)).orderBy("day_h").collect()
    assert got[0].trend is None and got[11].trend is None and got[-1].trend is None
    inner = [r for r in got if r.trend is not None]
    assert len(inner) == len(t) - 24
    for r in inner:
        hours = (r.day_h - START).total_seconds() / 3600
        assert r.trend == pytest.approx(100 + hours + 1)
        assert r.resid == pytest.approx(0, abs=1e-9)
    assert sum(r.seasonal for r in got[:24]) == pytest.approx(0)


def test_hour_profiles(make_feed):
    feed = make_feed(
        [(1, "2024-01-01 10:59:00", "like", {"post_id": 1}), (1, "2024-01-01 12:00:00", "view", {"post_id": 1}),
         (1, "2024-01-02 12:30:00", "view", {"post_id": 2}), (1, "2024-01-03 12:30:00", "view", {"post_id": 1})]
    )
    assert rows(series.by_hour(feed)) == [(10, 1), (12, 3)]
    assert rows(series.published_by_hour(feed)) == [(10, 1), (12, 1)]
    profile = rows(series.hour_profiles(feed), "hour", "actions_share", "posts_share", "actions_peak", "posts_peak")
    assert profile == [(10, 0.25, 0.5, False, True), (12, 0.75, 0.5, True, True)]


def test_hourly_by_slice(make_feed):
    feed = make_feed([(1, "2024-01-01 10:59:00", "like", {"os": "A"}), (1, "2024-01-01 10:00:00", "view", {"os": "B"})])
    assert rows(series.hourly(feed, "os")) == [("A", "2024-01-01T10:00:00", 1), ("B", "2024-01-01T10:00:00", 1)]
    assert rows(series.hourly(feed)) == [("all", "2024-01-01T10:00:00", 2)]
