from datetime import datetime

import pytest

from conftest import at, rows
from faremill.functions.trip import moment, seconds_between
from faremill.operators import windows
from faremill.operators.windows import Window


def test_months_and_labels():
    window = Window.of("2023-11", "2024-02-01T00:00:00")
    assert window.months == ["2023-11", "2023-12", "2024-01"]
    assert window.label == "2023-11..2024-01"
    assert Window.of("2023-12").months == ["2023-12"]
    assert [w.label for w in window.split()] == window.months
    with pytest.raises(ValueError):
        Window.of("2024-02", "2024-02")
    assert Window.of("2023-12-01") == Window.of("2023-12-01T00:00:00") == Window.of("2023-12")
    with pytest.raises(ValueError):
        Window.of("2023-12-15")


def test_backfill_delta_lookback():
    planned = windows.backfill("2023-10", None, datetime(2024, 1, 15))
    assert [w.label for w in planned] == ["2023-10", "2023-11", "2023-12"]
    assert windows.backfill("2023-10", "2023-12", datetime(2024, 1, 15)) == planned[:2]
    assert windows.backfill("2024-02", None, datetime(2024, 1, 15)) == []
    assert windows.delta(planned) == planned[-1:]
    assert windows.lookback(planned) == planned[-2:]
    assert windows.lookback(planned[:1]) == planned[:1]


def test_plan_months_covers_gaps(spark):
    df = spark.createDataFrame([(at("2023-11-30T23:59:59"),), (at("2024-02-01"),)],
                               "ts timestamp_ntz")
    plan = windows.plan_months(df, "ts")
    assert [r[0] for r in rows(plan)] == ["2023-11", "2023-12", "2024-01", "2024-02"]
    assert rows(windows.last_planned(plan, 1)) == [
        ("2024-02", at("2024-02-01"), at("2024-03-01"))]
    assert windows.plan_months(df.filter("false"), "ts").count() == 0


def test_window_is_half_open(trips):
    df = trips({"trip_id": "in", "trip_start_timestamp": "2023-10-01T00:00:00"},
               {"trip_id": "last", "trip_start_timestamp": "2023-10-31T23:59:59"},
               {"trip_id": "out", "trip_start_timestamp": "2023-11-01T00:00:00"},
               {"trip_id": "null", "trip_start_timestamp": None})
    assert rows(windows.in_window(df, Window.of("2023-10")), "trip_id") == [("in",), ("last",)]


def test_bounds_do_not_depend_on_the_session_zone(spark, trips):
    df = trips({"trip_id": "in", "trip_start_timestamp": "2023-10-31T23:30:00"},
               {"trip_id": "out", "trip_start_timestamp": "2023-11-01T00:30:00"})
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        kept = rows(windows.in_window(df, Window.of("2023-10")), "trip_id")
        gap = df.select(seconds_between(moment(at("2023-03-12T00:00:00")),
                                        moment(at("2023-03-13T00:00:01")))).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert kept == [("in",)] and gap == 86401
