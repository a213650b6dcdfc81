from datetime import datetime, timedelta

import pytest

from conftest import at, plan, rows
from faremill.config import Thresholds
from faremill.plans import checks, gold, ledger
from faremill.plans.checks import GateError
from faremill.plans.ledger import Ledger

DEFAULTS = Thresholds()


def outcome(df):
    return {r["check_name"]: r["passed"] for r in df.collect()}


GOOD = {
    "raw": {"rows": 6000},
    "bronze": {"raw_rows": 6000, "rows": 5900, "null_starts": 0},
    "silver": {"bronze_rows": 100, "rows": 95, "distinct_ids": 95, "min_fare": 0.0,
               "min_ts": at("2023-10-01"), "max_ts": at("2023-10-31T23:59:59"),
               "null_pickup": 10, "max_speed": 80.0, "min_tip_pct": 0.0, "max_tip_pct": 1.5,
               "window_start": at("2023-10-01"), "window_end": at("2023-11-01")},
    "gold": {"daily_rows": 31, "min_revenue": 0.0, "gold_revenue": 1000.0,
             "silver_revenue": 1005.0, "gold_trips": 95, "silver_trips": 95,
             **{f"rows_{name}": 3 for name in gold.MARTS}},
}
TYPES = {
    "raw": "window string, rows bigint",
    "bronze": "window string, raw_rows bigint, rows bigint, null_starts bigint",
    "silver": "window string, bronze_rows bigint, rows bigint, distinct_ids bigint, "
              "min_fare double, min_ts timestamp_ntz, max_ts timestamp_ntz, null_pickup bigint, "
              "max_speed double, min_tip_pct double, max_tip_pct double, "
              "window_start timestamp_ntz, window_end timestamp_ntz",
    "gold": "window string, daily_rows bigint, min_revenue double, gold_revenue double, "
            "silver_revenue double, gold_trips bigint, silver_trips bigint, "
            + ", ".join(f"rows_{name} bigint" for name in gold.MARTS),
}
# asset, check, values that make it fail (only this check may fail unless listed)
FAILING = [
    ("raw", "rows_landed_positive", {"rows": 0}, {"volume_in_band"}),
    ("raw", "volume_in_band", {"rows": 4999}, set()),
    ("raw", "volume_in_band", {"rows": 5_000_001}, set()),
    ("bronze", "row_count_positive", {"rows": 0}, {"bronze_matches_raw", "volume_in_band"}),
    ("bronze", "trip_start_not_null", {"null_starts": 1}, set()),
    ("bronze", "bronze_matches_raw", {"rows": 5600}, set()),
    ("bronze", "bronze_matches_raw", {"raw_rows": 0}, set()),
    ("bronze", "volume_in_band", {"raw_rows": 4000, "rows": 4000}, set()),
    ("silver", "row_count_positive", {"rows": 0, "distinct_ids": 0, "null_pickup": 0},
     {"volume_in_band"}),
    ("silver", "trip_id_unique", {"distinct_ids": 94}, set()),
    ("silver", "fare_non_negative", {"min_fare": -0.01}, set()),
    ("silver", "window_completeness", {"min_ts": at("2023-09-30T23:59:59")}, set()),
    ("silver", "window_completeness", {"max_ts": at("2023-11-01")}, set()),
    ("silver", "pickup_area_null_rate", {"null_pickup": 48}, set()),
    ("silver", "speed_in_range", {"max_speed": 150.01}, set()),
    ("silver", "tip_pct_in_range", {"max_tip_pct": 2.01}, set()),
    ("silver", "tip_pct_in_range", {"min_tip_pct": -0.1}, set()),
    ("silver", "volume_in_band", {"bronze_rows": 120}, set()),
    ("gold", "trips_daily_non_empty", {"daily_rows": 0}, set()),
    ("gold", "revenue_non_negative", {"min_revenue": -1.0}, set()),
    ("gold", "revenue_non_negative", {"min_revenue": None}, set()),
    ("gold", "revenue_reconciles_silver", {"gold_revenue": 900.0}, set()),
    ("gold", "revenue_reconciles_silver", {"silver_revenue": -1005.0}, set()),
    *[("gold", f"{name}_non_empty", {f"rows_{name}": 0}, set())
      for name in gold.MARTS if name != "trips_daily"],
    ("gold", "volume_in_band", {"gold_trips": 94}, set()),
]
EVALUATE = {"raw": checks.raw, "bronze": checks.bronze, "silver": checks.silver,
            "gold": checks.gold}


def profile(spark, asset, **changes):
    values = {**GOOD[asset], **changes}
    names = [part.strip().split(" ")[0] for part in TYPES[asset].split(",")]
    return spark.createDataFrame([("w", *[values[n] for n in names[1:]])], TYPES[asset])


@pytest.mark.parametrize("asset", list(GOOD))
def test_good_profile_passes(spark, asset):
    found = outcome(EVALUATE[asset](profile(spark, asset)))
    assert all(found.values()), found
    assert len(found) == {"raw": 2, "bronze": 4, "silver": 8, "gold": 9}[asset]


@pytest.mark.parametrize("asset, name, changes, others", FAILING)
def test_each_check_can_fail(spark, asset, name, changes, others):
    found = outcome(EVALUATE[asset](profile(spark, asset, **changes)))
    assert {check for check, passed in found.items() if not passed} == {name} | others


def test_silver_without_measurements_passes(spark):
    found = outcome(checks.silver(profile(
        spark, "silver", min_fare=None, max_speed=None, min_tip_pct=None, max_tip_pct=None)))
    assert all(found.values())


def test_no_revenue_reconciles(spark):
    found = outcome(checks.gold(profile(spark, "gold", silver_revenue=0.0)))
    assert found["revenue_reconciles_silver"]


def test_months_without_rows_are_still_checked(spark):
    months = spark.createDataFrame([("2023-10",), ("2023-11",)], "trip_month string")
    none = spark.createDataFrame([], "trip_month string, rows bigint")
    empty = spark.createDataFrame([], TYPES["silver"].replace("window string", "trip_month string")
                                  .replace(", bronze_rows bigint", "")
                                  .split(", window_start")[0])
    failed = checks.blocking_failures(checks.silver(checks.silver_profile(months, none, empty)))
    assert rows(failed, "window", "check_name") == [
        ("2023-10", "row_count_positive"), ("2023-11", "row_count_positive")]


def test_thresholds_from_environment():
    limits = Thresholds.from_env({"FAREMILL_VOLUME_MIN": "10", "FAREMILL_SPEED_MPH_MAX": "99.5",
                                  "FAREMILL_TIP_PCT_MAX": " "})
    assert (limits.volume_min, limits.speed_mph_max, limits.tip_pct_max) == (10, 99.5, 2.0)


def test_gate(spark):
    warned = checks.raw(profile(spark, "raw", rows=10))
    checks.assert_gate(warned)
    assert rows(checks.gate_status(warned)) == [("raw/taxi_trips", "w", 0, 1, False)]
    blocked = checks.raw(profile(spark, "raw", rows=0))
    with pytest.raises(GateError, match="rows_landed_positive"):
        checks.assert_gate(blocked)
    assert rows(checks.gate_status(blocked)) == [("raw/taxi_trips", "w", 1, 1, True)]


def test_steps_are_recorded(lake):
    book = Ledger(lake, "run1")
    assert book.table("step_runs").count() == 0
    with book.step("load", "2023-10") as counters:
        counters["rows"] = 7
    with pytest.raises(ValueError):
        with book.step("check"):
            raise ValueError("boom")
    found = rows(book.table("step_runs"), "run_id", "step", "window", "status", "error")
    assert found == [("run1", "check", "all", "FAILED", "boom"),
                     ("run1", "load", "2023-10", "DONE", None)]
    assert book.table("step_runs").filter("step = 'load'").first()["counters"] == {"rows": "7"}


def test_materializations_latest_and_freshness(lake, spark):
    book = Ledger(lake, "run1")
    book.materialized("gold", "2023-10", 5, files=2)
    row = book.table("materializations").first()
    assert (row["data_version"], row["metadata"]) == ("2023-10:5", {"rows": "5", "files": "2"})
    now = datetime(2024, 1, 31)
    history = spark.createDataFrame(
        [(str(i), "hot" if i else "old", now - timedelta(hours=100 - i), f"v{i}")
         for i in range(71)],
        "run_id string, asset string, finished_at timestamp_ntz, data_version string")
    assert rows(ledger.latest(history), "asset", "data_version") == [("hot", "v70"), ("old", "v0")]
    fresh = ledger.freshness(history, now, 30)
    assert rows(fresh, "asset", "passed", "observed") == [
        ("hot", True, 30 * 3600.0), ("old", False, 100 * 3600.0)]


def test_checks_are_stored_and_alarms_list_what_failed(lake, spark):
    book = Ledger(lake, "run1")
    stored = book.record(checks.raw(profile(spark, "raw", rows=0)))
    assert rows(stored, "check_name", "passed") == [
        ("rows_landed_positive", False), ("volume_in_band", False)]
    with pytest.raises(RuntimeError):
        with book.step("silver.load", "2023-10"):
            raise RuntimeError("lost")
    report = ledger.alarms(book.table("check_results"), book.table("step_runs"))
    assert rows(report) == [
        ("run1", "2023-10", "step", "silver.load", "lost"),
        ("run1", "w", "check", "raw/taxi_trips:rows_landed_positive", '{"rows":"0"}')]


def test_a_gate_reads_only_its_own_check_rows(lake, spark):
    book = Ledger(lake)
    first = book.record(checks.raw(profile(spark, "raw", rows=0)))
    second = book.record(checks.raw(profile(spark, "raw", rows=5)))
    assert not set(first.inputFiles()) & set(second.inputFiles())
    assert first.columns == second.columns == book.table("check_results").columns
    assert book.table("check_results").count() == first.count() + second.count()


def test_latest_aggregates_records_of_the_newest_time_only(spark):
    """Null assets and times take part; ties go to the larger tie-break."""
    found = spark.createDataFrame(
        [("a", at("2024-01-01T00:00:00"), "r1"), ("a", at("2024-01-02T00:00:00"), "r1"),
         ("a", at("2024-01-02T00:00:00"), "r2"), ("b", None, "r3"), ("b", None, "r4"),
         (None, at("2024-01-01T00:00:00"), "r5"), (None, None, "r6")],
        "asset string, finished_at timestamp_ntz, run_id string")
    newest = ledger.latest(found)
    assert {(r.asset, r.run_id) for r in newest.collect()} == {("a", "r2"), ("b", "r4"), (None, "r5")}
    assert "Join" in plan(newest)
