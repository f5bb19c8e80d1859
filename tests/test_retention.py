from collections import Counter
from datetime import date, timedelta
import random

from conftest import rows

from footfall.operators import retention

MONDAY = date(2024, 1, 1)


def visits(make_feed, days_by_user, extra=None):
    return make_feed(
        [(u, f"{MONDAY + timedelta(days=d)} 12:00:00", "view", (extra or {}).get(u, {}))
         for u, days in days_by_user.items() for d in days]
    )


def test_weekly_statuses_follow_presence(make_feed):
    # {w}, {w, w+1}, {w, w+2}: a returner counts as new again
    log = visits(make_feed, {1: [0], 2: [0, 7], 3: [0, 14]})
    result = rows(retention.weekly_audience(log, MONDAY, MONDAY + timedelta(days=16)),
                  "this_week", "status", "num_users")
    assert result == [
        ("2024-01-01", "new", 3),
        ("2024-01-08", "lost", -2),
        ("2024-01-08", "retained", 1),
        ("2024-01-15", "lost", -1),
        ("2024-01-15", "new", 1),
    ]


def test_weekly_totals_over_a_long_history(make_feed):
    random.seed(5)
    days = {u: sorted(random.sample(range(700), 25)) for u in range(12)}  # more weeks than one word holds
    last = MONDAY + timedelta(days=699)
    result = rows(retention.weekly_audience(visits(make_feed, days), MONDAY, last),
                  "this_week", "status", "num_users")
    seen = {u: {d // 7 for d in ds} for u, ds in days.items()}
    expected = Counter()
    for weeks in seen.values():
        for w in weeks:
            expected[w, "retained" if w - 1 in weeks else "new"] += 1
            if w + 1 not in weeks and w + 1 <= 699 // 7:
                expected[w + 1, "lost"] -= 1
    assert result == sorted(
        (str(MONDAY + timedelta(days=7 * w)), s, n) for (w, s), n in expected.items()
    )


def test_retained_and_lost_make_up_last_week(make_feed):
    random.seed(6)
    days = {u: sorted(random.sample(range(42), 6)) for u in range(30)}
    cells = {(w, s): n for w, s, n in rows(
        retention.weekly_audience(visits(make_feed, days), MONDAY, MONDAY + timedelta(days=41)),
        "this_week", "status", "num_users")}
    weeks = sorted({w for w, _ in cells})

    def audience(w):
        return cells.get((w, "new"), 0) + cells.get((w, "retained"), 0)

    for earlier, later in zip(weeks, weeks[1:]):
        assert cells.get((later, "retained"), 0) - cells.get((later, "lost"), 0) == audience(earlier)


def test_cohorts_only_hold_recent_users(make_feed):
    log = visits(make_feed, {1: [0, 5, 6], 2: [5, 7], 3: [5, 6, 6]})
    since, until = MONDAY + timedelta(days=5), MONDAY + timedelta(days=10)
    assert rows(retention.cohort_retention(log, since, until)) == [
        ("2024-01-06", "2024-01-06", 2),
        ("2024-01-06", "2024-01-07", 1),
        ("2024-01-06", "2024-01-08", 1),
    ]


def test_long_horizon_matches_brute_force(make_feed):
    random.seed(7)
    days = {u: sorted(random.sample(range(200), 20)) for u in range(15)}
    since = 40
    result = rows(retention.cohort_retention(
        visits(make_feed, days), MONDAY + timedelta(days=since), MONDAY + timedelta(days=199)))
    expected = Counter()
    for ds in days.values():
        if ds[0] >= since:
            for d in ds:
                expected[str(MONDAY + timedelta(days=ds[0])), str(MONDAY + timedelta(days=d))] += 1
    assert result == sorted((*k, n) for k, n in expected.items())


def test_matrix_has_fixed_columns(make_feed):
    log = visits(make_feed, {1: [0, 1], 2: [1]})
    dates = [MONDAY + timedelta(days=i) for i in range(3)]
    matrix = retention.cohort_matrix(retention.cohort_retention(log, MONDAY, dates[-1]), dates)
    assert matrix.columns == ["start_date", "2024-01-01", "2024-01-02", "2024-01-03"]
    assert [tuple(r)[1:] for r in matrix.collect()] == [(1, 1, None), (None, 1, None)]


def test_rates_and_means(make_feed):
    log = visits(make_feed, {1: [0, 1], 2: [0]})
    rates = retention.retention_by(log, "source", MONDAY, MONDAY + timedelta(days=3))
    assert rows(rates, "day_number", "cohort_size", "rate") == [(0, 2, 1.0), (1, 2, 0.5)]
    means = rows(retention.retention_mean(rates, "source"), "day_number", "mean_rate", "cells")
    assert means == [(0, 1.0, 1), (1, 0.5, 1), (None, 0.75, 2)]


def test_next_day_return(make_feed):
    # the third user skips a day, the fourth comes back on an odd and an even day later
    log = visits(make_feed, {1: [0, 1], 2: [0], 3: [0, 2, 3], 4: [1, 2]})
    assert rows(retention.new_user_return(log), "start_date", "new_users", "returned_next_day") == [
        ("2024-01-01", 3, 1),
        ("2024-01-02", 1, 1),
    ]


def test_change_is_shared_out(make_feed):
    extra = {1: {"city": "a"}, 2: {"city": "a"}, 3: {"city": "b"}}
    log = visits(make_feed, {1: [0], 2: [0], 3: [0, 1]}, extra)
    change = retention.dau_change_by(log, MONDAY + timedelta(days=1), ["city"])
    assert rows(change, "dimension_value", "users_before", "users_on", "share_of_change", "drop_rank") == [
        ("a", 2, 0, 1.0, 1),
        ("b", 1, 1, 0.0, 2),
    ]


def test_first_seen(make_feed):
    log = visits(make_feed, {1: [0, 3], 2: [3]})
    assert rows(retention.first_seen(log, MONDAY + timedelta(days=1))) == [(2, "2024-01-04")]


def test_status_matrix(make_feed):
    audience = retention.weekly_audience(visits(make_feed, {1: [0, 7]}), MONDAY, MONDAY + timedelta(days=8))
    assert rows(retention.status_matrix(audience)) == [
        ("2024-01-01", 1, None, None),
        ("2024-01-08", None, 1, None),
    ]


def test_a_user_belongs_to_the_source_of_the_first_action(make_feed):
    log = make_feed([
        (1, "2024-01-01 10:00:00", "view", {"source": "ads"}),
        (1, "2024-01-05 10:00:00", "view", {"source": "organic"}),
        (2, "2024-01-01 09:00:00", "view", {"source": "organic"}),
        (2, "2024-01-01 09:00:00", "like", {"source": "ads"}),  # at the same time: the smaller value
        (2, "2024-01-02 09:00:00", "view", {"source": "organic"}),
    ])
    assert rows(retention.new_user_return(log), "start_date", "source", "new_users", "returned_next_day") == [
        ("2024-01-01", "ads", 2, 1)
    ]
    cells = retention.retention_by(log, "source", MONDAY, MONDAY + timedelta(days=6))
    assert rows(cells, "source", "start_date", "date", "active_users", "cohort_size") == [
        ("ads", "2024-01-01", "2024-01-01", 2, 2),
        ("ads", "2024-01-01", "2024-01-02", 1, 2),
        ("ads", "2024-01-01", "2024-01-05", 1, 2),
    ]
