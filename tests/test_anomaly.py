from datetime import datetime, timedelta

import pytest
from conftest import rows

from footfall.functions.calendar import AsOf
from footfall.operators import anomaly
from footfall.sources.logs import activity

START = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def make_series(spark):
    def build(values, metric="views"):
        data = [(START + timedelta(minutes=15 * i), metric, v) for i, v in enumerate(values)]
        return spark.createDataFrame(data, "ts timestamp_ntz, metric string, value double")

    return build


def test_bands_of_a_known_series(make_series):
    bands = anomaly.iqr_bands(make_series([1.0, 5.0, 2.0, 8.0, 3.0, 100.0, 1.0]), a=0.0)
    by_time = bands.orderBy("ts").collect()
    assert [r.q25 for r in by_time] == [None] * 5 + [2.0, 3.0]
    assert by_time[5].q75 == 5.0 and by_time[6].q75 == 8.0
    # centred mean of five, with what there is at the edges
    assert [r.low for r in by_time] == [None, None, None, 2.0, 2.5, 2.5, 2.5]


def test_live_bands_do_not_look_ahead(make_series):
    values = [1.0, 5.0, 2.0, 8.0, 3.0, 100.0, 1.0, 4.0, 6.0]
    whole = anomaly.iqr_bands(make_series(values), live=True).orderBy("ts").collect()
    for end in range(6, len(values) + 1):
        newest = anomaly.latest_alerts(anomaly.iqr_bands(make_series(values[:end]))).first()
        assert (newest.low, newest.up) == (whole[end - 1].low, whole[end - 1].up)


def test_undefined_values_leave_the_band_open(make_series):
    bands = anomaly.iqr_bands(make_series([1.0, None, 2.0, 8.0, 3.0, 100.0]))
    assert all(r.q25 is None for r in bands.collect())
    assert not anomaly.latest_alerts(bands).first()["is_alert"]


def test_alert_and_its_text(make_series):
    bands = anomaly.iqr_bands(make_series([4.0, 5.0, 4.0, 5.0, 4.0, 5.0, 4.0, 5.0, 50.0]))
    alerts = anomaly.latest_alerts(bands)
    assert alerts.first()["is_alert"]
    assert anomaly.alert_messages(alerts).first()["text"] == (
        "Metric views:\ncurrent value 50.00\nchange from previous value 900.00%"
    )
    assert rows(anomaly.band_breaks(bands), "value") == [(50.0,)]


def test_change_from_zero_is_not_available(make_series):
    bands = anomaly.iqr_bands(make_series([4.0, 5.0, 4.0, 5.0, 4.0, 5.0, 4.0, 0.0, 50.0]))
    assert anomaly.alert_messages(anomaly.latest_alerts(bands)).first()["text"].endswith("n/a")


def test_metrics_do_not_mix(make_series):
    both = make_series([float(i) for i in range(8)]).unionByName(make_series([9.0] * 8, "likes"))
    likes = anomaly.iqr_bands(both).where("metric = 'likes'")
    assert {(r.q25, r.q75) for r in likes.collect()} == {(None, None), (9.0, 9.0)}


def test_quarter_hours(make_feed, make_messages):
    log = activity(
        make_feed(
            [(1, "2024-01-01 23:59:00", "view"),  # yesterday counts from its midnight
             (1, "2024-01-02 10:00:00", "view"), (1, "2024-01-02 10:14:00", "like"),
             (2, "2024-01-02 10:14:59", "like"), (2, "2024-01-03 09:45:00", "view")]
        ),
        make_messages([(3, 1, "2024-01-02 10:01:00"), (3, 2, "2024-01-02 10:02:00")]),
    )
    as_of = AsOf(datetime(2024, 1, 3, 9, 50))
    assert rows(anomaly.quarter_hour_metrics(log, as_of)) == [
        ("2024-01-02T10:00:00", "2024-01-02", "10:00", 1, 1, 2, 2.0, 1, 2)
    ]
    filled = anomaly.quarter_hour_metrics(log, as_of, fill_gaps=True)
    assert filled.count() == 96 + 39
    assert filled.where("views = 0").count() == 96 + 39 - 1
    assert filled.where("ctr is null").count() == 96 + 39 - 1


def test_day_over_day(make_series):
    series = make_series([10.0] * 96 + [14.0, 10.0])
    result = rows(anomaly.day_over_day(series, 0.3), "ts", "change", "is_alert")
    assert result == [("2024-01-02T00:00:00", pytest.approx(0.4), True), ("2024-01-02T00:15:00", 0.0, False)]
