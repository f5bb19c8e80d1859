"""One user, receiver and post hold a third of all rows; results must stay whole."""

import random
from collections import Counter, defaultdict
from datetime import date, datetime, timedelta

import pytest
from conftest import PROFILE, rows

from footfall.operators import daily, mart, posts, retention
from footfall.schema import FEED, MESSAGES

START = datetime(2024, 1, 1)
HOT = 0


def pick(others):
    return HOT if random.random() < 1 / 3 else random.choice(others)


@pytest.fixture(scope="module")
def feed_rows():
    random.seed(11)
    out = []
    for _ in range(3000):
        user = pick(range(1, 60))
        out.append(
            {**PROFILE, "user_id": user, "post_id": pick(range(1, 40)),
             "time": START + timedelta(minutes=random.randrange(14 * 1440)),
             "action": random.choice(["view", "view", "like"]),
             # the hot user and some others switch systems during a day
             "os": random.choice(["iOS", "Android"]) if user % 10 == 0 else "iOS",
             "age": 20 + user % 5}
        )
    return out


@pytest.fixture(scope="module")
def feed(spark, feed_rows):
    return spark.createDataFrame([tuple(r[f.name] for f in FEED) for r in feed_rows], FEED)


def test_slices(feed, feed_rows):
    users, views = defaultdict(set), Counter()
    for r in feed_rows:
        for dim in ("os", "age"):
            key = str(r["time"].date()), dim, str(r[dim])
            users[key].add(r["user_id"])
            views[key] += r["action"] == "view"
    got = rows(daily.feed_by_slice(feed, ["os", "age"]), "date", "dimension", "dimension_value", "dau", "views")
    assert got == sorted((*k, len(u), views[k]) for k, u in users.items())


def test_change_between_days(feed, feed_rows):
    on = date(2024, 1, 8)
    users = defaultdict(set)
    for r in feed_rows:
        users[r["time"].date(), r["os"]].add(r["user_id"])
    got = rows(retention.dau_change_by(feed, on, ["os"]), "dimension_value", "users_before", "users_on")
    assert got == [
        (os, len(users[on - timedelta(days=1), os]), len(users[on, os])) for os in ("Android", "iOS")
    ]


def test_user_days_and_posts(feed, feed_rows):
    per_day = Counter((r["user_id"], str(r["time"].date())) for r in feed_rows)
    got = mart.feed_user_day(feed).selectExpr("user_id", "event_date", "views + likes as n")
    assert {(u, d): n for u, d, n in rows(got)} == per_day
    per_post = Counter(r["post_id"] for r in feed_rows)
    stats = posts.post_stats(feed).selectExpr("post_id", "views + likes as n")
    assert dict(rows(stats)) == per_post


def test_hot_receiver(spark):
    random.seed(12)
    data = [
        {**PROFILE, "user_id": random.randrange(500), "receiver_id": pick(range(1, 30)),
         "time": START + timedelta(minutes=random.randrange(1440))}
        for _ in range(2000)
    ]
    messages = spark.createDataFrame([tuple(r[f.name] for f in MESSAGES) for r in data], MESSAGES)
    senders, received = defaultdict(set), Counter()
    for r in data:
        senders[r["receiver_id"]].add(r["user_id"])
        received[r["receiver_id"]] += 1
    got = rows(mart.received_user_day(messages), "user_id", "messages_received", "users_received")
    assert sorted(got) == sorted((u, received[u], len(s)) for u, s in senders.items())
