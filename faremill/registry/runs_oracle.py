"""DuckDB SQL for the queries of ``runs``, written from the semantics, over the same tables."""

from __future__ import annotations

from faremill.registry.oracle import (GOLD_PROFILE, MART_SIZES, MONTHS, checked, money, on_bronze,
                                      on_silver)
from faremill.registry.queries import NOW
from faremill.registry.runs import (FLAWED_BRONZE_ROWS, FLAWED_BRONZE_START, FLAWED_GOLD,
                                    FLAWED_RAW_ROWS, FLAWED_SILVER, FLAWED_SILVER_ROWS, FLAWS_LOADED,
                                    LIMITS, MONTH_NUMBER, ORDER)
from faremill.schema import TRIP_COLUMNS

_VOLUME = ("volume_in_band", "WARN", f"n between {LIMITS.volume_min} and {LIMITS.volume_max}", "n")
_PLANNED = f"{MONTHS},\nplanned as (select month as label, month as trip_month from months)"
_DRIFT = "abs(expected - n) / expected"
_GAP = f"case when expected <> 0 then {_DRIFT} when n = 0 then 0.0 else 1.0 end"

# raw text that does not parse
_NO_START = f"({ORDER} % 59 = 0 or {ORDER} % 73 = 0 or {ORDER} % 79 = 0)"
_NO_FARE = f"({ORDER} % 53 = 0 or {ORDER} % 47 = 0)"
_NO_MILES = f"({ORDER} % 67 = 0 or {ORDER} % 43 = 0)"
_REPLACED = {
    "fare": f"case when {_NO_FARE} then null else fare end",
    "trip_miles": f"case when {_NO_MILES} then null else trip_miles end",
    "trip_seconds": f"case when {ORDER} % 71 = 0 then null else trip_seconds end",
    "company": f"case when {ORDER} % 83 = 0 then 'A \"B\", C' else company end",
}
_TYPED = ", ".join(f"{_REPLACED.get(c, c)} as {c}" for c in TRIP_COLUMNS)

RAW = f"""raw_profile as (
  select label, count(b.trip_month) as n
  from planned p left join (select * from bronze where {FLAWED_RAW_ROWS}) b using (trip_month)
  group by 1)"""
RAW_CHECKS = checked("raw_profile", "raw/taxi_trips", [
    ("rows_landed_positive", "ERROR", "n > 0", "n"), _VOLUME])

BRONZE = f"""bronze_profile as (
  select label, (select count(*) from bronze b where b.trip_month = label) as expected,
    count(s.trip_month) as n, count(*) filter (where s.trip_month is not null and start is null)
      as nulls
  from planned left join (
    select trip_month, {FLAWED_BRONZE_START} as start from bronze where {FLAWED_BRONZE_ROWS}) s
  using (trip_month) group by 1)"""
BRONZE_CHECKS = checked("bronze_profile", "bronze/taxi_trips", [
    ("row_count_positive", "ERROR", "n > 0", "n"),
    ("trip_start_not_null", "ERROR", "nulls = 0", "nulls"),
    ("bronze_matches_raw", "WARN", f"{_GAP} <= 0.05", _GAP), _VOLUME])

SILVER = f"""flawed as (
  select * replace ({", ".join(f"{value} as {name}" for name, value in FLAWED_SILVER.items())})
  from silver where {FLAWED_SILVER_ROWS}),
silver_profile as (
  select label, count(s.trip_id) as n, count(distinct s.trip_id) as ids, min(fare) as fare_lo,
    min(trip_start_timestamp) as first_at, max(trip_start_timestamp) as last_at,
    max(speed_mph) as speed_hi, min(tip_pct) as tip_lo, max(tip_pct) as tip_hi,
    case when count(s.trip_id) = 0 then 0.0 else count(*) filter (
      where s.trip_id is not null and pickup_community_area is null) / count(s.trip_id) end
      as null_rate,
    (select count(*) from bronze b where b.trip_month = label) as expected
  from planned left join flawed s using (trip_month) group by 1)"""
SILVER_CHECKS = checked("silver_profile", "silver/taxi_trips", [
    ("row_count_positive", "ERROR", "n > 0", "n"),
    ("trip_id_unique", "ERROR", "ids = n", "ids"),
    ("fare_non_negative", "ERROR", "coalesce(fare_lo >= 0, true)", "fare_lo"),
    ("window_completeness", "ERROR", "n = 0 or (strftime(first_at, '%Y-%m') = label "
     "and strftime(last_at, '%Y-%m') = label)", "n"),
    ("pickup_area_null_rate", "WARN", "null_rate <= 0.5", "null_rate"),
    ("speed_in_range", "WARN", "coalesce(speed_hi <= 150, true)", "speed_hi"),
    ("tip_pct_in_range", "WARN", "coalesce(tip_hi <= 2 and tip_lo >= 0, true)", "tip_hi"),
    ("volume_in_band", "WARN", f"{_GAP} <= 0.1", _GAP)])


def _gold_column(name: str, value: str) -> str:
    cases = " ".join(f"when v = '{variant}' then {flaws[name]}"
                     for variant, flaws in FLAWED_GOLD.items() if name in flaws)
    return f"case {cases} else {value} end as {name}" if cases else f"{value} as {name}"


_GOLD_VALUES = {name: name for name in ("daily_rows", "min_revenue", "gold_revenue", "gold_trips",
                                        "silver_trips", "silver_revenue")} | {
    f"rows_{mart}": size for mart, size in MART_SIZES.items() if mart != "trips_daily"}
GOLD = GOLD_PROFILE + f""",
flawed_gold as (
  select v as label, {", ".join(_gold_column(*item) for item in _GOLD_VALUES.items())}
  from gold_profile, (values {", ".join(f"('{name}')" for name in FLAWED_GOLD)}) t(v))"""
GOLD_CHECKS = checked("flawed_gold", "gold/taxi_marts", [
    ("trips_daily_non_empty", "ERROR", "daily_rows > 0", "daily_rows"),
    ("revenue_non_negative", "ERROR", "coalesce(min_revenue >= 0, false)", "min_revenue"),
    ("revenue_reconciles_silver", "ERROR",
     "abs(gold_revenue - silver_revenue) / abs(silver_revenue) <= 0.01",
     "abs(gold_revenue - silver_revenue) / abs(silver_revenue)"),
    *[(f"{mart}_non_empty", "WARN", f"rows_{mart} > 0", f"rows_{mart}")
      for mart in MART_SIZES if mart != "trips_daily"],
    ("volume_in_band", "WARN", "gold_trips = silver_trips", "gold_trips")])

_FOLDER = (f"coalesce(case when {ORDER} % 59 = 0 or {ORDER} % 73 = 0 then null "
           f"else strftime(trip_start_timestamp, '%Y-%m') end, '{FLAWS_LOADED.months[0]}')")
_MONTHS_LOADED = ", ".join(f"'{m}'" for m in FLAWS_LOADED.months)
LOAD = f"""placed as (
  select *, case when own = '1997-02' and {ORDER} % 29 = 0 then '1997-03' else own end as folder,
    case when {_NO_START} then null else trip_start_timestamp end as typed
  from (select *, {_FOLDER} as own from feed)
  where folder in ({_MONTHS_LOADED})),
totals as (
  select count(*) filter (where typed is null) as missing_start,
    count(*) filter (where typed is not null and strftime(typed, '%Y-%m') <> folder) as other_month,
    count(*) filter (where {ORDER} % 59 <> 0 and ({ORDER} % 73 = 0
      or ({ORDER} % 79 = 0 and trip_start_timestamp is not null))) as bad_trip_start_timestamp,
    count(*) filter (where {ORDER} % 53 = 0) as bad_fare,
    count(*) filter (where {_NO_MILES}) as bad_trip_miles,
    count(*) filter (where {ORDER} % 71 = 0) as bad_trip_seconds
  from placed)
select folder as trip_month, count(*) as raw_rows,
  count(*) filter (where strftime(typed, '%Y-%m') = folder) as kept,
  any_value(missing_start) as missing_start, any_value(other_month) as other_month,
  any_value(bad_trip_start_timestamp) as bad_trip_start_timestamp, any_value(bad_fare) as bad_fare,
  any_value(bad_trip_miles) as bad_trip_miles, any_value(bad_trip_seconds) as bad_trip_seconds,
  count(*) filter (where strftime(typed, '%Y-%m') = folder) as "rows"
from placed, totals group by 1"""

ATTEMPTS = """attempts as (
  select cast(event_id as varchar) as run_id, event_type as asset,
    '2024-01-' || lpad(cast(day(ts) as varchar), 2, '0') as "window", ts as "at",
    case when value < 50 then 'value_in_range' when value < 70 then 'step ' || event_type end
      as failure
  from events)"""

GAPS = f"""numbered as (
  select trip_month, {MONTH_NUMBER} as n from (select distinct trip_month from bronze)),
timed as (
  select *, n % 8 not in (1, 2, 3) and n % 29 not in (3, 4) as alone,
    exists (select 1 from numbered b where b.n = a.n - 1 and a.n % 29 = 4) as second
  from numbered a),
records as (
  select *, case when alone or n % 29 = 3 then n when second then n - 1 end as done,
    n + case when n % 5 = 0 then 1 else -1 end as fed,
    greatest(case when n % 11 = 0 then n + 2 end, case when n % 13 = 0 then n - 2 end) as failed
  from timed),
statuses as (
  select trip_month, n, case when failed is not null and (done is null or failed >= done)
      then 'failed' when done is null then 'missing' when fed > done then 'stale'
      else 'loaded' end as status from records)
select status, min(trip_month) as first_month, max(trip_month) as last_month, count(*) as months
from (select *, n - row_number() over (partition by status order by n) as island from statuses)
where status <> 'loaded' group by status, island"""

_NTH = "(select distinct trip_month from silver order by 1 limit 1 offset {})"


def sql() -> dict[str, str]:
    return {
        "bronze_flawed": on_bronze(
            f"select {_TYPED}, trip_month from bronze where not {_NO_START}"),
        "load_flawed": "with " + on_bronze("", LOAD).strip()[5:],
        "dq_raw_flawed": on_bronze(RAW_CHECKS, _PLANNED, RAW),
        "dq_bronze_flawed": on_bronze(BRONZE_CHECKS, _PLANNED, BRONZE),
        "dq_silver_flawed": on_silver(SILVER_CHECKS, _PLANNED, SILVER),
        "dq_gold_flawed": on_silver(GOLD_CHECKS, GOLD),
        "gate_flawed": on_silver("""
          select asset, "window",
            count(*) filter (where not passed and severity = 'ERROR') as errors,
            count(*) filter (where not passed and severity = 'WARN') as warnings,
            count(*) filter (where not passed and severity = 'ERROR') > 0 as blocked
          from results group by 1, 2""", _PLANNED, RAW, BRONZE, SILVER, GOLD, "results as ("
            + "\nunion all\n".join([RAW_CHECKS, BRONZE_CHECKS, SILVER_CHECKS, GOLD_CHECKS]) + ")"),
        "dq_freshness_assets": f"""select event_type || '-' || day(ts) as asset, 'all' as "window",
            'freshness' as check_name, 'WARN' as severity,
            max(ts) >= timestamp '{NOW}' - interval 30 hour as passed,
            floor(epoch(timestamp '{NOW}' - max(ts))) as observed
          from events group by 1""",
        "ledger_fold": """select event_type as asset, max(ts) as finished_at,
            (select count(*) from events) as records,
            (select count(*) from events) as before_fold, 0 as entries
          from events group by 1""",
        "failure_streaks": f"""with {ATTEMPTS},
          seen as (
            select *, max("at") filter (where failure is null) over so_far as last_success,
              count(*) filter (where failure is null) over so_far as successes
            from attempts
            window so_far as (partition by asset, "window"
              order by "at", failure is not null, run_id rows unbounded preceding))
          select asset, "window", run_id, "at", failure, last_success,
            cast(row_number() over (partition by asset, "window", successes order by "at", run_id)
              as int) as streak
          from seen where failure is not null""",
        "failure_standing": f"""with {ATTEMPTS}
          select asset, "window", count(*) as tries, count(failure) as failures,
            any_value(last_success) as last_success,
            count(*) filter (where failure is not null
              and (last_success is null or "at" >= last_success)) as failing
          from (select *, max("at") filter (where failure is null)
                  over (partition by asset, "window") as last_success from attempts)
          group by 1, 2""",
        "ledger_gaps": on_bronze("", GAPS),
        "backfill_missing": on_silver(
            f"select trip_month, count(*) as trips, {money('trip_total')} as revenue, "
            f"trip_month in ({_NTH.format(1)}, {_NTH.format(2)}, {_NTH.format(3)}) as second_run, "
            "false as third_run from silver where trip_month in (select distinct trip_month "
            "from silver order by 1 limit 5) group by 1"),
        "lookback_changes": on_silver(
            "select trip_month, count(*) as trips, "
            f"{money('tolls')} as tolls, any_value(late) as reloaded, 0 as again from ("
            "select trip_month, late, case when late and trip_hour = 13 then 7.25::double "
            "else tolls end as tolls "
            f"from (select *, trip_month = {_NTH.format(2)} as late from silver)) "
            "where trip_month in (select distinct trip_month from silver order by 1 limit 3) "
            "group by 1"),
    }
