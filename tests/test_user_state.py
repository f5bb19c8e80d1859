"""States of users, merged one day at a time, against the whole log."""

from datetime import date, timedelta

import pytest
from conftest import at, rows

from footfall.operators import daily, retention, user_state
from footfall.sources.buckets import write_bucketed
from footfall.sources.logs import feed_actions, write_log

FIRST, LAST = date(2024, 1, 1), date(2024, 1, 17)
HORIZON = user_state.Horizon(FIRST, 93)


@pytest.fixture(scope="module")
def log(make_feed):
    """Users with gaps, several sources, a tie at the first action, and one user with no days but the last."""
    found = []
    for user in range(12):
        for d in range(1, 18):
            if (user * 7 + d * (user % 4 + 1)) % 5 < 2 and d > user:
                source = {"source": "ads" if (user + d) % 3 else "organic"}
                found += [(user, f"2024-01-{d:02d} 10:00:00", "view", source)]
                found += [(user, f"2024-01-{d:02d} 23:59:59", "like", {"source": "ads"})]
    found += [(50, "2024-01-03 00:00:00", "view", {"source": s}) for s in ("organic", "ads")]
    found += [(51, "2024-01-17 12:00:00", "view")]
    return make_feed(found)


@pytest.fixture(scope="module")
def folder(log, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("log") / "feed")
    write_log(log, path)
    return path


def one_day(spark, folder, day):
    return feed_actions(spark, folder, day, day + timedelta(days=1), day_column="day")


def new_store(spark, tmp_path, keep=2):
    return user_state.StateStore(spark, str(tmp_path / "state"), HORIZON, 4, keep)


def everything(state):
    return rows(state, "user_id", "start_date", "first.time", "first.value", *HORIZON.words)


def test_daily_merges_equal_the_whole_log(spark, log, folder, tmp_path):
    store = new_store(spark, tmp_path)
    store.merge_days(lambda day: one_day(spark, folder, day), FIRST, date(2024, 1, 6))
    store.merge(feed_actions(spark, folder, date(2024, 1, 7), date(2024, 1, 18), day_column="day"))
    state = store.read()
    assert everything(state) == everything(user_state.reduce_log(log, HORIZON))
    since = date(2024, 1, 3)
    assert rows(user_state.state_first_seen(state, since)) == rows(retention.first_seen(log, since))
    names = ["start_date", "date", "active_users"]
    assert rows(user_state.state_retention(state, HORIZON, since, LAST), *names) == rows(
        retention.cohort_retention(log, since, LAST), *names
    )
    names = ["source", *names]
    assert rows(user_state.state_retention(state, HORIZON, since, LAST, "source"), *names) == rows(
        retention.cohort_retention(log, since, LAST, "source"), *names
    )
    assert rows(user_state.state_dau(state, HORIZON, FIRST, LAST), "date", "dau") == rows(
        daily.dau(log), "date", "dau"
    )
    names = ["this_week", "previous_week", "status", "num_users"]
    assert rows(user_state.state_weekly_audience(state, HORIZON, FIRST, LAST), *names) == rows(
        retention.weekly_audience(log, FIRST, LAST), *names
    )
    names = ["start_date", "source", "new_users", "returned_next_day", "return_rate"]
    assert rows(user_state.state_new_user_return(state, HORIZON), *names) == rows(retention.new_user_return(log), *names)


def test_a_repeated_or_late_day_is_counted_once(spark, log, folder, tmp_path):
    store = new_store(spark, tmp_path)
    store.merge(feed_actions(spark, folder, date(2024, 1, 3), date(2024, 1, 18), day_column="day"))
    for day in (date(2024, 1, 2), date(2024, 1, 1), date(2024, 1, 2), LAST):
        store.merge(one_day(spark, folder, day))
    assert everything(store.read()) == everything(user_state.reduce_log(log, HORIZON))


def test_a_merge_reads_one_day_and_leaves_the_state_in_place(spark, folder, tmp_path):
    store = new_store(spark, tmp_path)
    store.merge(feed_actions(spark, folder, FIRST, LAST, day_column="day"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = store.merged(one_day(spark, folder, LAST))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    log_scan = next(part for part in plan.split("FileScan")[1:] if "Bucketed: true" not in part)
    assert "day#" in log_scan and f">= {LAST})" in log_scan and f"<= {LAST})" in log_scan.split("PartitionFilters")[1]
    state_side = plan[plan.index("SortMergeJoin") :].split("FileScan")[0]
    assert "Bucketed: true" in plan[plan.index("SortMergeJoin") :].split("FileScan")[1]
    assert "Exchange" not in state_side


def test_an_unfinished_version_is_not_read_and_old_ones_go(spark, folder, tmp_path):
    store = new_store(spark, tmp_path)
    store.merge_days(lambda day: one_day(spark, folder, day), FIRST, date(2024, 1, 4))
    known = everything(store.read())
    assert store._versions() == [2, 3] and store.newest() == 3
    store.merged(one_day(spark, folder, date(2024, 1, 5))).write.parquet(f"{store._at(4)}/rows")  # died before its description
    assert store.newest() == 3 and everything(store.read()) == known
    store.merge(one_day(spark, folder, date(2024, 1, 5)))
    assert store.newest() == 4 and store._versions() == [3, 4]


def test_empty_days_and_rows_without_a_user(spark, log, make_feed, tmp_path):
    store = new_store(spark, tmp_path)
    with pytest.raises(ValueError, match="no complete state"):
        store.read()
    store.merge(log.limit(0))
    assert store.read().count() == 0
    store.merge(make_feed([(None, "2024-01-02 10:00:00", "view"), (7, "2024-01-02 10:00:00", "view")]))
    assert rows(store.read(), "user_id", "start_date") == [(7, "2024-01-02")]
    store.merge(log.limit(0))
    assert store.read().count() == 1


def test_days_outside_the_horizon_count_as_first_actions_only(spark, make_feed):
    log = make_feed([(1, "2023-12-30 10:00:00", "view"), (1, "2024-01-02 10:00:00", "view")])
    state = user_state.reduce_log(log, HORIZON)
    assert rows(state, "user_id", "start_date") == [(1, "2023-12-30")]
    assert rows(user_state.state_dau(state, HORIZON, FIRST, LAST), "date", "dau") == [("2024-01-02", 1)]
    with pytest.raises(ValueError, match="outside the state's days"):
        user_state.state_dau(state, HORIZON, date(2023, 12, 30), LAST)


def test_roll_forgets_the_oldest_word_of_days(spark, make_feed):
    log = make_feed([(1, "2024-01-02 10:00:00", "view"), (1, "2024-03-10 10:00:00", "view")])
    state, later = user_state.roll(user_state.reduce_log(log, HORIZON), HORIZON)
    assert later.origin == FIRST + timedelta(days=62)
    assert rows(user_state.state_dau(state, later, later.origin, date(2024, 3, 20)), "date", "dau") == [("2024-03-10", 1)]
    assert rows(state, "start_date") == [("2024-01-02",)]
    assert at("2024-01-02 10:00:00") == state.first()["first"]["time"]


def test_bucketed_tables_are_found_again_by_their_description(spark, tmp_path):
    path = str(tmp_path / "t")
    write_bucketed(spark.range(100).withColumnRenamed("id", "user_id"), path, "user_id", 4)
    from footfall.sources.buckets import _name, read_bucketed

    spark.sql(f"DROP TABLE {_name(path)}")  # as in another session
    text = read_bucketed(spark, path).groupBy("user_id").count()._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in text and "Exchange hashpartitioning" not in text
    assert read_bucketed(spark, path).count() == 100
