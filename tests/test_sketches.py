"""Sketches of days against exact counts."""

from datetime import date, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from footfall.operators import daily, retention, sketches
from footfall.sources.logs import activity

FIRST, LAST = date(2024, 1, 1), date(2024, 1, 21)


@pytest.fixture(scope="module")
def both(make_feed, make_messages):
    """Users of either service or both, with gaps, a null os and a null user."""
    feed, messages = [], []
    for user in range(60):
        for d in range(1, 22):
            if (user * 5 + d * (user % 3 + 1)) % 7 < 2 and user % 5:
                feed.append((user, f"2024-01-{d:02d} 08:00:00", "view", {"os": None if user % 9 == 0 else f"os{user % 2}"}))
            if (user + d * (user % 4 + 1)) % 6 == 0 and user % 3:
                messages.append((user, 1, f"2024-01-{d:02d} 09:00:00"))
    feed.append((None, "2024-01-03 08:00:00", "view"))
    return make_feed(feed), make_messages(messages)


def test_cube_counts_every_cut_of_every_range(both):
    feed, _ = both
    cube = sketches.user_cube(feed, ["os", "gender"]).cache()
    for first, last in ((1, 1), (1, 7), (3, 17)):
        bounds = F.col("date").between(F.lit(date(2024, 1, first)), F.lit(date(2024, 1, last)))
        exact = sketches.cut_rows(feed, ["os", "gender"]).where(bounds).groupBy("dimension", "dimension_value")
        assert rows(sketches.cube_users(cube.where(bounds))) == rows(exact.agg(F.count_distinct("user_id").alias("users")))


def test_days_add_up_to_the_range_within_the_error(spark):
    """At 200 000 users a sketch is an estimate; three standard errors are allowed."""
    log = spark.range(400_000).select(
        (F.col("id") % 200_000).alias("user_id"), F.lit("view").alias("action"), F.lit("a").alias("os"),
        F.timestamp_add("DAY", (F.col("id") % 7).cast("int"), F.lit("2024-01-01").cast("timestamp_ntz")).alias("time"),
    )
    for precision in (10, 14):
        cube = sketches.user_cube(log, ["os"], precision)
        found = sketches.cube_users(cube).collect()
        whole = log.agg(F.hll_sketch_estimate(F.hll_sketch_agg("user_id", precision))).first()[0]
        for row in found:
            assert abs(row.users / 200_000 - 1) < 3 * 1.04 / 2 ** (precision / 2)
            assert abs(row.users / whole - 1) < 3 * 1.04 / 2 ** (precision / 2)


@pytest.mark.parametrize("period", ["day", "all"])
def test_overlap_equals_the_exact_one(both, period):
    log = activity(*both).where("user_id is not null")
    found = sketches.overlap(sketches.audience_days(log), period)
    columns = ["date", "segment", "users"] if period == "day" else ["segment", "users"]
    assert rows(found, *columns) == rows(daily.audience_overlap(log, period), *columns)


@pytest.mark.parametrize("as_of", [date(2024, 1, 10), LAST, date(2024, 2, 20)])
def test_weekly_audience_equals_the_exact_one(both, as_of):
    feed, messages = (df.where("user_id is not null") for df in both)
    days = sketches.audience_days(activity(feed, messages)).cache()
    columns = ["this_week", "previous_week", "status", "num_users"]
    for service, log in (("feed", feed), ("messenger", messages)):
        exact = retention.weekly_audience(log.where(F.col("time") < F.lit(as_of + timedelta(days=7 - as_of.weekday()))), FIRST, as_of)
        found = sketches.weekly_audience(days, service, FIRST, as_of)
        assert rows(found, *columns) == rows(exact, *columns)


def test_sets_beyond_the_sketch_stay_within_the_error(spark):
    def log(first, n, action):
        return spark.range(first, first + n).select(
            F.col("id").alias("user_id"), F.lit(action).alias("action"), F.lit("2024-01-01").cast("timestamp_ntz").alias("time")
        )

    both = log(0, 120_000, "view").union(log(80_000, 100_000, "message"))
    found = {r.segment: r.users for r in sketches.overlap(sketches.audience_days(both, 12), "all", 12).collect()}
    for segment, exact in {"both": 40_000, "feed_only": 80_000, "messenger_only": 60_000}.items():
        assert abs(found[segment] - exact) < 3 * 180_000 / 2**6, segment


def test_a_day_written_again_replaces_itself(spark, both, tmp_path):
    log, path = activity(*both), str(tmp_path / "audience")
    days = sketches.audience_days(log)
    sketches.write_days(days, path)
    before = rows(sketches.overlap(sketches.read_days(spark, path, sketches.AUDIENCE, FIRST, LAST), "all"))
    sketches.write_days(days.where(F.col("date") == F.lit(date(2024, 1, 5))), path)
    stored = sketches.read_days(spark, path, sketches.AUDIENCE, FIRST, LAST)
    assert rows(sketches.overlap(stored, "all")) == before == rows(sketches.overlap(days, "all"))
    assert stored.count() == days.count()


def test_only_the_asked_days_are_opened(spark, both, tmp_path):
    path = str(tmp_path / "cube")
    sketches.write_days(sketches.user_cube(both[0], ["os"]), path)
    days = sketches.read_days(spark, path, sketches.CUBE, date(2024, 1, 3), date(2024, 1, 4))
    folders = {r[0].split("date=")[1][:10] for r in days.select(F.input_file_name()).distinct().collect()}
    assert folders == {"2024-01-03", "2024-01-04"}
    plan = days._jdf.queryExecution().executedPlan().toString()
    assert "date#" in plan.split("PartitionFilters")[1].split("]")[0]


def test_users_are_never_shuffled(both):
    log = activity(*both)
    for df in (sketches.user_cube(both[0], ["os"]), sketches.audience_days(log)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        for line in plan.splitlines():
            if "Exchange hashpartitioning" in line:
                assert "user_id" not in line.split("hashpartitioning")[1].split(")")[0]


def test_empty_logs(both):
    log = activity(*both).limit(0)
    assert sketches.cube_users(sketches.user_cube(log, ["os"])).count() == 0
    days = sketches.audience_days(log)
    assert sketches.overlap(days).count() == sketches.weekly_audience(days, "feed", FIRST, LAST).count() == 0
    assert sketches.overlap(days, "all").count() == 0
