from datetime import date, datetime

from conftest import rows

from footfall.functions.calendar import AsOf
from footfall.operators import daily
from footfall.sources.logs import activity

D1, D2 = date(2024, 1, 1), date(2024, 1, 2)


def test_ctr_is_null_without_views(make_feed):
    feed = make_feed([(0, "2024-01-01 10:00:00", "like"), (1, "2024-01-02 10:00:00", "view")])
    assert rows(daily.feed_daily(feed)) == [("2024-01-01", 1, 0, 1, None), ("2024-01-02", 1, 1, 0, 0.0)]


def test_feed_report_text(make_feed):
    feed = make_feed(
        [(1, "2024-01-01 10:00:00", "view"), (2, "2024-01-01 10:00:00", "view"),
         (2, "2024-01-01 10:01:00", "like"), (2, "2024-01-01 10:02:00", "view")]
    )
    text = daily.feed_report(daily.feed_daily(feed, D1, D1, 2)).first()["text"]
    assert text == "Feed report for 2024-01-01:\nDAU = 2\nviews = 3\nlikes = 1\nCTR = 0.33"
    no_views = make_feed([(1, "2024-01-01 10:00:00", "like")])
    assert daily.feed_report(daily.feed_daily(no_views)).first()["text"].endswith("CTR = n/a")


def test_a_day_without_messages_stays(make_feed, make_messages):
    both = activity(
        make_feed([(1, "2024-01-01 10:00:00", "view"), (1, "2024-01-02 10:00:00", "view")]),
        make_messages([(2, 1, "2024-01-01 09:00:00")]),
    )
    assert rows(daily.app_dau(both, D1, D2)) == [("2024-01-01", 2, 1, 1), ("2024-01-02", 1, 0, 1)]


def test_overlap_segments_sum_to_app_users(make_feed, make_messages):
    both = activity(
        make_feed([(1, "2024-01-01 10:00:00", "view"), (2, "2024-01-01 10:00:00", "like")]),
        make_messages([(2, 9, "2024-01-01 11:00:00"), (3, 9, "2024-01-01 11:00:00")]),
    )
    segments = dict((s, n) for _, s, n in rows(daily.audience_overlap(both)))
    assert segments == {"both": 1, "feed_only": 1, "messenger_only": 1}
    assert sum(segments.values()) == daily.app_dau(both, D1, D1).first()["dau_app"]


def test_overlap_over_all_time_joins_days(make_feed, make_messages):
    both = activity(
        make_feed([(1, "2024-01-01 10:00:00", "view")]),
        make_messages([(1, 9, "2024-01-02 11:00:00")]),
    )
    assert rows(daily.audience_overlap(both, "all")) == [("both", 1)]


def test_actions_per_user_counts_only_those_who_did_it(make_feed, make_messages):
    both = activity(
        make_feed(
            [(1, "2024-01-01 10:00:00", "view"), (1, "2024-01-01 10:01:00", "view"),
             (2, "2024-01-01 10:00:00", "like")]
        ),
        make_messages([(3, 1, "2024-01-02 11:00:00")]),
    )
    assert rows(daily.actions_per_user(both, D1, D2)) == [
        ("2024-01-01", 1.0, 2.0, None),
        ("2024-01-02", None, None, 1.0),
    ]


def test_slices_sum_to_the_whole(make_feed):
    feed = make_feed(
        [(u, "2024-01-01 10:00:00", "view", {"os": "iOS" if u % 2 else "Android", "age": 20 + u})
         for u in range(5)]
    )
    sliced = daily.feed_by_slice(feed, ["os", "age"])
    assert rows(sliced.where("dimension = 'os'"), "dimension_value", "dau") == [("Android", 3), ("iOS", 2)]
    assert sliced.where("dimension = 'age'").count() == 5


def test_today_stops_at_the_moment(make_feed):
    feed = make_feed([(1, "2024-01-01 10:14:59", "view"), (1, "2024-01-01 10:15:00", "view")])
    as_of = AsOf(datetime(2024, 1, 1, 10, 15))
    assert rows(daily.feed_today(feed, as_of), "ts", "views") == [("2024-01-01T10:00:00", 1)]


def test_posts_viewed_largest_first(make_feed):
    feed = make_feed(
        [(1, "2024-01-01 10:00:00", "view", {"post_id": 1}), (1, "2024-01-02 10:00:00", "view", {"post_id": 1}),
         (1, "2024-01-02 11:00:00", "view", {"post_id": 2}), (1, "2024-01-01 11:00:00", "like", {"post_id": 3})]
    )
    assert [r.posts for r in daily.posts_viewed_daily(feed).collect()] == [2, 1]


def test_estimates_are_close(make_feed, make_messages):
    feed = make_feed([(u, f"2024-01-0{1 + u % 3} 10:00:00", "view") for u in range(120)])
    messages = make_messages([(u, 1, "2024-01-02 11:00:00") for u in range(90, 180)])
    span = (date(2024, 1, 1), date(2024, 1, 3))
    both = activity(feed, messages)
    for exact, estimate in (
        (daily.dau(feed), daily.dau(feed, approx=True)),
        (daily.app_dau(both, *span), daily.app_dau(both, *span, approx=True)),
    ):
        pairs = list(zip(rows(exact), rows(estimate)))
        assert [a[0] for a, _ in pairs] == [b[0] for _, b in pairs]
        assert all(abs(x - y) <= 0.2 * x + 1 for a, b in pairs for x, y in zip(a[1:], b[1:]))


def test_the_report_table_gives_what_the_logs_give(make_feed, make_messages):
    feed = make_feed([(u, f"2024-01-0{1 + u % 3} 1{u % 9}:00:00", ["view", "like"][u % 2]) for u in range(40)])
    messages = make_messages([(u, 1, "2024-01-02 11:00:00") for u in range(30, 60)])
    both, span = activity(feed, messages), (date(2024, 1, 1), date(2024, 1, 3))
    days = daily.user_activity(both)
    assert rows(daily.dau_of_days(days)) == rows(daily.app_dau(both, *span))
    assert rows(daily.totals_of_days(days)) == rows(daily.action_totals(both, *span))
    assert rows(daily.per_user_of_days(days)) == rows(daily.actions_per_user(both, *span))
