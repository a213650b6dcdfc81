"""Data-quality checks. Each asset's checks come from one profile row per window, so a whole
asset is checked in one aggregate pass; ERROR failures block a run, WARN failures do not."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from faremill.config import Thresholds
from faremill.functions.trip import relative_gap
from faremill.plans import gold as marts
from faremill.schema import MONTH

CHECK_DDL = ("asset string, window string, check_name string, severity string, passed boolean, "
             "observed double, metadata map<string,string>")
# Asset names here, and names and severities of the checks below.
RAW, BRONZE, SILVER, GOLD = ("raw/taxi_trips", "bronze/taxi_trips", "silver/taxi_trips",
                             "gold/taxi_marts")


class GateError(RuntimeError):
    """Blocking checks failed; ``windows`` are the months concerned."""

    def __init__(self, message: str, windows=()):
        super().__init__(message)
        self.windows = set(windows)


@dataclass(frozen=True)
class Check:
    name: str
    severity: str
    passed: Column
    observed: Column                      # the number the rule looks at
    metadata: dict[str, object] = field(default_factory=dict)


def _evaluate(profile: DataFrame, asset: str, checks: list[Check]) -> DataFrame:
    rows = F.array(*[
        F.struct(
            F.lit(check.name).alias("check_name"),
            F.lit(check.severity).alias("severity"),
            F.coalesce(check.passed, F.lit(False)).alias("passed"),
            check.observed.cast("double").alias("observed"),
            F.create_map(*[part for key, value in check.metadata.items() for part in (
                F.lit(key), (value if isinstance(value, Column) else F.lit(value)).cast("string"))
            ]).cast("map<string,string>").alias("metadata"))
        for check in checks])
    return profile.select(F.lit(asset).alias("asset"), "window", F.inline(rows))


def _volume(rows: Column, limits: Thresholds) -> Check:
    return Check("volume_in_band", "WARN", rows.between(limits.volume_min, limits.volume_max),
                 rows, {"rows": rows, "expected_min": limits.volume_min,
                        "expected_max": limits.volume_max})


def raw(profile: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:
    """Profile: window, rows."""
    rows = F.col("rows")
    return _evaluate(profile, RAW, [
        Check("rows_landed_positive", "ERROR", rows > 0, rows, {"rows": rows}),
        _volume(rows, limits),
    ])


def bronze(profile: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:
    """Profile: window, raw_rows, rows, null_starts (stored rows without a start time)."""
    rows, raw_rows, nulls = F.col("rows"), F.col("raw_rows"), F.col("null_starts")
    drift = relative_gap(raw_rows, rows)
    return _evaluate(profile, BRONZE, [
        Check("row_count_positive", "ERROR", rows > 0, rows, {"rows": rows}),
        Check("trip_start_not_null", "ERROR", nulls == 0, nulls,
              {"rows_written": rows, "rows_dropped": F.greatest(raw_rows - rows, F.lit(0))}),
        Check("bronze_matches_raw", "WARN", drift <= limits.raw_drift_max, drift,
              {"raw_rows": raw_rows, "bronze_rows": rows, "drift_pct": F.round(drift * 100, 2)}),
        _volume(rows, limits),
    ])


def silver(profile: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:
    """Profile: window, window_start, window_end, bronze_rows and ``silver.profile`` columns."""
    rows, ids, bronze_rows = F.col("rows"), F.col("distinct_ids"), F.col("bronze_rows")
    fare, speed = F.col("min_fare"), F.col("max_speed")
    tip_lo, tip_hi = F.col("min_tip_pct"), F.col("max_tip_pct")
    first, last = F.col("min_ts"), F.col("max_ts")
    null_rate = F.when(rows > 0, F.col("null_pickup") / rows).otherwise(F.lit(0.0))
    drift = relative_gap(bronze_rows, rows)
    return _evaluate(profile, SILVER, [
        Check("row_count_positive", "ERROR", rows > 0, rows, {"rows": rows}),
        Check("trip_id_unique", "ERROR", ids == rows, ids,
              {"distinct_trip_ids": ids, "rows": rows}),
        Check("fare_non_negative", "ERROR", F.coalesce(fare >= 0, F.lit(True)), fare,
              {"min_fare": fare}),
        Check("window_completeness", "ERROR",
              (rows == 0) | ((first >= F.col("window_start")) & (last < F.col("window_end"))),
              rows, {"min_ts": first, "max_ts": last, "window_start": F.col("window_start"),
                     "window_end": F.col("window_end")}),
        Check("pickup_area_null_rate", "WARN", null_rate <= limits.null_pickup_area_max,
              null_rate, {"null_rate": F.round(null_rate, 4),
                          "threshold": limits.null_pickup_area_max}),
        Check("speed_in_range", "WARN", F.coalesce(speed <= limits.speed_mph_max, F.lit(True)),
              speed, {"max_speed_mph": speed, "threshold": limits.speed_mph_max}),
        Check("tip_pct_in_range", "WARN",
              F.coalesce((tip_hi <= limits.tip_pct_max) & (tip_lo >= 0), F.lit(True)), tip_hi,
              {"max_tip_pct": tip_hi, "min_tip_pct": tip_lo, "threshold": limits.tip_pct_max}),
        Check("volume_in_band", "WARN", drift <= limits.volume_drift_max, drift,
              {"silver_rows": rows, "bronze_rows": bronze_rows,
               "drift_pct": F.round(drift * 100, 2),
               "threshold_pct": limits.volume_drift_max * 100}),
    ])


def gold(profile: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:
    """Profile: window, ``gold.rollup`` columns and rows_<mart> counts."""
    daily, least = F.col("daily_rows"), F.col("min_revenue")
    mart_money, silver_money = F.col("gold_revenue"), F.col("silver_revenue")
    gap = F.abs(mart_money - silver_money)
    relative = F.when(silver_money != 0, gap / F.abs(silver_money)).otherwise(F.lit(0.0))
    mart_trips, silver_trips = F.col("gold_trips"), F.col("silver_trips")
    return _evaluate(profile, GOLD, [
        Check("trips_daily_non_empty", "ERROR", daily > 0, daily, {"rows": daily}),
        Check("revenue_non_negative", "ERROR", least >= 0, least, {"min_revenue": least}),
        Check("revenue_reconciles_silver", "ERROR", relative <= limits.revenue_tolerance,
              relative, {"gold_revenue": mart_money, "silver_revenue": silver_money,
                         "abs_diff": F.round(gap, 2), "tolerance": limits.revenue_tolerance}),
        *[Check(f"{name}_non_empty", "WARN", F.col(f"rows_{name}") > 0, F.col(f"rows_{name}"),
                {"rows": F.col(f"rows_{name}")})
          for name in marts.MARTS if name != "trips_daily"],
        Check("volume_in_band", "WARN", mart_trips == silver_trips, mart_trips,
              {"gold_trips": mart_trips, "silver_trips": silver_trips}),
    ])


# profiles ------------------------------------------------------------------------------------

def month_bounds(profile: DataFrame) -> DataFrame:
    """Adds window, window_start and window_end from the month label."""
    day = F.concat(F.col(MONTH), F.lit("-01")).cast("date")
    return profile.withColumns({
        "window": F.col(MONTH), "window_start": day.cast("timestamp_ntz"),
        "window_end": F.add_months(day, 1).cast("timestamp_ntz")})


def silver_profile(months: DataFrame, bronze_counts: DataFrame, silver: DataFrame) -> DataFrame:
    """One row per month of ``months`` (column trip_month), also for months without rows."""
    counted = bronze_counts.withColumnRenamed("rows", "bronze_rows")
    joined = (months.join(counted, MONTH, "left").join(silver, MONTH, "left")
              .fillna(0, ["bronze_rows", "rows", "distinct_ids", "null_pickup"]))
    return month_bounds(joined)


def gold_profile(tables: dict[str, DataFrame], silver: DataFrame) -> DataFrame:
    """One row over all marts and silver; every mart count is a one-row scalar."""
    row = marts.rollup(tables["trips_daily"], silver)
    for name, df in tables.items():
        row = row.withColumn(f"rows_{name}", df.agg(F.count("*")).scalar())
    return row.withColumn("window", F.lit("all"))


# gating --------------------------------------------------------------------------------------

def blocking_failures(checks: DataFrame) -> DataFrame:
    return checks.filter((F.col("severity") == "ERROR") & ~F.col("passed"))


def assert_gate(checks: DataFrame) -> None:
    """Raises with every blocking failure; a run has a few checks per month."""
    failed = blocking_failures(checks).orderBy("asset", "window", "check_name").collect()
    if failed:
        raise GateError("; ".join(
            f"{row['asset']} {row['window']}: {row['check_name']} {row['metadata']}"
            for row in failed), [row["window"] for row in failed])


def gate_status(checks: DataFrame) -> DataFrame:
    """Per asset and window: failed ERROR and WARN checks, and whether downstream must stop."""
    failed = ~F.col("passed")
    return (checks.groupBy("asset", "window")
            .agg(F.count_if(failed & (F.col("severity") == "ERROR")).alias("errors"),
                 F.count_if(failed & (F.col("severity") == "WARN")).alias("warnings"))
            .withColumn("blocked", F.col("errors") > 0))
