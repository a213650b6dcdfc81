"""DuckDB SQL for every registered query, written from the semantics, over the same tables."""

from __future__ import annotations

from faremill.registry.queries import COMBINED, DATES, NOW, RELOADED, WINDOW
from faremill.schema import SILVER_COLUMNS, TRIP_COLUMNS, TRIP_TYPES

FEED = """
base as (
  select l.*, p_brand,
    l_shipdate + to_hours(cast(l_partkey % 24 as int))
      + to_minutes(cast(l_suppkey % 4 as int) * 15) as start_at,
    cast(case when l_partkey % 97 = 0 then -1 when l_partkey % 89 = 0 then null
         else l_quantity * 37 * (l_linenumber - 1) end as int) as seconds,
    cast(case when (l_partkey + l_suppkey) % 11 = 0 then null
         else (l_partkey * 7 + l_suppkey * 13 + l_linenumber) % 77 + 1 end as int) as pickup,
    cast(case when l_partkey % 13 = 0 then null
         else (l_partkey * 5 + l_orderkey) % 77 + 1 end as int) as dropoff,
    case when l_partkey % 103 = 0 then cast(0 as double)
         else floor(l_extendedprice / 100) / 10 end as base_fare,
    case when l_partkey % 107 = 0 then null
         else floor(l_extendedprice * l_discount / 100) / 10 end as tip,
    case when l_linenumber = 7 then cast(2.5 as double) else cast(0 as double) end as toll,
    round(l_tax * 100) / 2 as extra
  from lineitem l join part on l_partkey = p_partkey),
feed as (
  select
    case when l_partkey % 991 = 0 then null
         else concat(cast(l_orderkey as varchar), '-', cast(l_linenumber as varchar)) end
      as trip_id,
    concat('taxi-', cast(l_suppkey as varchar)) as taxi_id,
    case when l_partkey % 997 = 0 then null else start_at end as trip_start_timestamp,
    case when l_partkey % 997 = 0 or seconds < 0 then null
         else start_at + to_seconds(seconds) end as trip_end_timestamp,
    seconds as trip_seconds,
    case when l_partkey % 101 = 0 then cast(-1 as double)
         else cast(l_quantity as double) / 4 end as trip_miles,
    pickup as pickup_community_area, dropoff as dropoff_community_area,
    base_fare as fare, tip as tips, toll as tolls, extra as extras,
    base_fare + coalesce(tip, cast(0 as double)) + toll + extra as trip_total,
    case l_returnflag when 'A' then 'Cash' when 'R' then 'Credit Card' end as payment_type,
    case when p_brand = 'Brand#1' then null else p_brand end as company,
    cast(416000 + pickup * 50 as double) / 10000 as pickup_centroid_latitude,
    cast(-876000 - pickup * 50 as double) / 10000 as pickup_centroid_longitude,
    cast(416000 + dropoff * 50 as double) / 10000 as dropoff_centroid_latitude,
    cast(-876000 - dropoff * 50 as double) / 10000 as dropoff_centroid_longitude
  from base),
areas as (
  select cast(76 - 2 * n_nationkey as int) as area_no, n_name as area_name,
         76 - 2 * n_nationkey in (56, 76) as area_airport
  from nation),
bronze as (
  select *, strftime(trip_start_timestamp, '%Y-%m') as trip_month
  from feed where trip_start_timestamp is not null)"""


def rounded(value: str, digits: int) -> str:
    """Half-up on the decimal text of a double, which is how Spark rounds doubles."""
    return (f"cast(round(cast(cast({value} as varchar) as decimal(38, 18)), {digits}) as double)")


def units(column: str) -> str:
    """The sum in units of 1e-12, so that an average is one division of exact numbers."""
    return f"cast(sum(cast(round({column} * 1000000000000.0) as hugeint)) as double)"


def money(column: str) -> str:
    return rounded(f"({units(column)} / 1000000000000.0)", 2)


def average(column: str, digits: int) -> str:
    return rounded(f"({units(column)} / nullif(count({column}) * 1000000000000.0, 0))", digits)


KEYED = """
keyed as (
  select * from bronze where trip_id is not null)"""
_ORDER = ", ".join(f"{name} nulls last" for name in [
    "trip_start_timestamp", *[n for n in TRIP_COLUMNS
                              if n not in ("trip_id", "trip_start_timestamp")]])
DEDUPED = f"""
deduped as (
  select * from keyed
  qualify row_number() over (partition by trip_month, trip_id order by {_ORDER}) = 1)"""
GUARDED = """
guarded as (
  select * replace (
    case when trip_seconds < 0 then null else trip_seconds end as trip_seconds,
    case when trip_miles < 0 then null else trip_miles end as trip_miles)
  from {source})"""
DERIVED = {
    "trip_date": "cast(trip_start_timestamp as date)",
    "trip_hour": "cast(hour(trip_start_timestamp) as int)",
    "dow_num": "cast(dayofweek(trip_start_timestamp) + 1 as int)",
    "day_name": "strftime(trip_start_timestamp, '%a')",
    "duration_min": rounded("(trip_seconds / 60.0::double)", 2),
    "speed_mph": "case when trip_seconds > 0 then "
                 + rounded("(trip_miles / (trip_seconds / 3600.0::double))", 2) + " end",
    "tip_pct": "case when fare > 0 then " + rounded("(tips / fare)", 4) + " end",
    "is_airport": "pickup_community_area in (76, 56) or dropoff_community_area in (76, 56)",
}


def derived(*names: str) -> str:
    return ", ".join(f"{DERIVED[name]} as {name}" for name in names)


_SILVER_SELECT = ", ".join(
    f"{DERIVED[name]} as {name}" if name in DERIVED else name for name in SILVER_COLUMNS)
SILVER = f"""
silver as (
  select {_SILVER_SELECT}, trip_month from guarded)"""


def on_bronze(query: str, *extra: str) -> str:
    return "with " + ",\n".join([FEED, *extra]) + f"\n{query}"


def on_silver(query: str, *extra: str) -> str:
    return on_bronze(query, KEYED, DEDUPED, GUARDED.format(source="deduped"), SILVER, *extra)


def clause(filters, *extra: str) -> str:
    found = list(extra)
    if filters.start:
        found.append(f"trip_date >= date '{filters.start}'")
    if filters.end:
        found.append(f"trip_date <= date '{filters.end}'")
    if filters.company:
        found.append(f"company = '{filters.company}'")
    if filters.payment_type:
        found.append(f"payment_type = '{filters.payment_type}'")
    if filters.pickup_area is not None:
        found.append(f"pickup_community_area = {filters.pickup_area}")
    if filters.day_type:
        found.append(f"dow_num {'in' if filters.day_type == 'weekend' else 'not in'} (1, 7)")
    return "where " + " and ".join(found) if found else ""


def daily(where: str = "") -> str:
    return f"""select trip_date as day, count(*) as trips, {money('trip_total')} as revenue,
        {average('fare', 2)} as avg_fare, {average('tip_pct', 4)} as avg_tip_pct,
        {average('trip_miles', 2)} as avg_miles, {average('duration_min', 2)} as avg_duration_min
      from silver {where} group by trip_date"""


def by_hour(where: str = "", hour: str = "trip_hour") -> str:
    return f"""select dow_num, day_name, trip_hour as {hour}, count(*) as trips,
        {average('fare', 2)} as avg_fare
      from silver {where} group by dow_num, day_name, trip_hour"""


def by_company(where: str = "", limit: str = "") -> str:
    return f"""select coalesce(company, 'Unknown') as company, count(*) as trips,
        {money('trip_total')} as revenue, {average('fare', 2)} as avg_fare
      from silver {where} group by 1 order by trips desc, 1 {limit}"""


def payments(where: str = "") -> str:
    return f"""select payment_type, trips, revenue,
        {rounded('(trips / cast(sum(trips) over () as double))', 4)} as pct_of_trips
      from (select coalesce(payment_type, 'Unknown') as payment_type, count(*) as trips,
                   {money('trip_total')} as revenue
            from silver {where} group by 1)"""


def routes(where: str, limit: int) -> str:
    return f"""select pickup_community_area, dropoff_community_area, count(*) as trips,
        {average('fare', 2)} as avg_fare, {average('trip_miles', 2)} as avg_miles
      from silver {where} group by 1, 2 order by trips desc, 1, 2 limit {limit}"""


def pickups(where: str) -> str:
    return f"""select pickup_community_area, count(*) as trips, {money('trip_total')} as revenue,
        {average('fare', 2)} as avg_fare
      from silver {where} group by 1"""


def summary(where: str = "") -> str:
    return f"""select count(*) as total_trips, coalesce({money('trip_total')}, 0) as total_revenue,
        count(distinct trip_date) as days, coalesce({average('fare', 2)}, 0) as avg_fare,
        coalesce({average('tip_pct', 4)}, 0) as avg_tip_pct,
        coalesce({average('trip_miles', 2)}, 0) as avg_miles
      from silver {where}"""


def text_columns() -> str:
    return ", ".join(
        f"strftime({name}, '%Y-%m-%dT%H:%M:%S') || '.000' as {name}"
        if TRIP_TYPES[name] == "timestamp_ntz" else f"cast({name} as varchar) as {name}"
        for name in TRIP_COLUMNS)


KNOWN_ROUTE = ("pickup_community_area is not null", "dropoff_community_area is not null")
KNOWN_PICKUP = "pickup_community_area is not null"
NO_FILTER = type(DATES)()
MONTHS = """months as (
  select strftime(d, '%Y-%m') as month, cast(d as timestamp) as window_start,
         cast(d + interval 1 month as timestamp) as window_end
  from (select unnest(generate_series(
          date_trunc('month', min(trip_start_timestamp)),
          date_trunc('month', max(trip_start_timestamp)), interval 1 month)) as d from bronze))"""


def checked(profile: str, asset: str, rules: list[tuple[str, str, str, str]]) -> str:
    """Check rows from a profile; a rule is (name, severity, passed, observed)."""
    return "\nunion all\n".join(
        f"""select '{asset}' as asset, label as "window", '{name}' as check_name,
            '{severity}' as severity, {passed} as passed, cast({observed} as double) as observed
          from {profile}""" for name, severity, passed, observed in rules)


SILVER_PROFILE = """profile as (
  select trip_month as label, count(*) as n, count(distinct trip_id) as ids, min(fare) as fare_lo,
    min(trip_start_timestamp) as first_at, max(trip_start_timestamp) as last_at,
    max(speed_mph) as speed_hi, min(tip_pct) as tip_lo, max(tip_pct) as tip_hi,
    count(*) filter (where pickup_community_area is null) / count(*) as null_rate,
    (select count(*) from bronze b where b.trip_month = s.trip_month) as bronze_n
  from silver s group by trip_month)"""
SILVER_CHECKS = checked("profile", "silver/taxi_trips", [
    ("row_count_positive", "ERROR", "n > 0", "n"),
    ("trip_id_unique", "ERROR", "ids = n", "ids"),
    ("fare_non_negative", "ERROR", "coalesce(fare_lo >= 0, true)", "fare_lo"),
    ("window_completeness", "ERROR",
     "strftime(first_at, '%Y-%m') = label and strftime(last_at, '%Y-%m') = label", "n"),
    ("pickup_area_null_rate", "WARN", "null_rate <= 0.5", "null_rate"),
    ("speed_in_range", "WARN", "coalesce(speed_hi <= 150, true)", "speed_hi"),
    ("tip_pct_in_range", "WARN", "coalesce(tip_hi <= 2 and tip_lo >= 0, true)", "tip_hi"),
    ("volume_in_band", "WARN", "abs(bronze_n - n) / bronze_n <= 0.1",
     "abs(bronze_n - n) / bronze_n"),
])
MART_SIZES = {
    "trips_daily": "(select count(distinct trip_date) from silver)",
    "trips_by_hour": "(select count(*) from (select distinct dow_num, trip_hour from silver))",
    "trips_by_company":
        "(select count(distinct coalesce(company, 'Unknown')) from silver)",
    "payment_mix": "(select count(distinct coalesce(payment_type, 'Unknown')) from silver)",
    "top_routes": "(select least(50, count(*)) from (select distinct pickup_community_area,"
                  " dropoff_community_area from silver where pickup_community_area is not null"
                  " and dropoff_community_area is not null))",
    "trips_by_pickup_area": "(select count(distinct pickup_community_area) from silver)",
}
GOLD_PROFILE = f"""daily as ({daily()}),
totals as (
  select count(*) as daily_rows, min(revenue) as min_revenue,
         {money('revenue')} as gold_revenue, cast(sum(trips) as bigint) as gold_trips
  from daily),
gold_profile as (
  select 'all' as label, *, (select count(*) from silver) as silver_trips,
         (select {money('trip_total')} from silver) as silver_revenue
  from totals)"""
GOLD_CHECKS = checked("gold_profile", "gold/taxi_marts", [
    ("trips_daily_non_empty", "ERROR", "daily_rows > 0", "daily_rows"),
    ("revenue_non_negative", "ERROR", "min_revenue >= 0", "min_revenue"),
    ("revenue_reconciles_silver", "ERROR",
     "abs(gold_revenue - silver_revenue) / abs(silver_revenue) <= 0.01",
     "abs(gold_revenue - silver_revenue) / abs(silver_revenue)"),
    *[(f"{mart}_non_empty", "WARN", f"{size} > 0", size)
      for mart, size in MART_SIZES.items() if mart != "trips_daily"],
    ("volume_in_band", "WARN", "gold_trips = silver_trips", "gold_trips"),
])
VOLUME = ("volume_in_band", "WARN", "n between 5000 and 5000000", "n")
_BY_MONTH = "select trip_month as label, count(*) as n from bronze group by 1"
_COLUMNS = ", ".join(TRIP_COLUMNS)


def sql() -> dict[str, str]:
    found = queries()
    cubes = {f"cube_{name.removeprefix('bi_')}": text for name, text in found.items()
             if name.startswith("bi_") and name != "bi_param_sql"}
    from faremill.registry import runs_oracle  # it builds on this module
    return found | cubes | runs_oracle.sql()


def queries() -> dict[str, str]:
    return {
        "src_paged_extract": on_bronze(f"select {text_columns()} from bronze"),
        "src_folder_extract": on_bronze(f"select {text_columns()} from bronze"),
        "land_month_csv": on_bronze(f"select {text_columns()}, trip_month as month from bronze"),
        "scan_raw_csv": on_bronze(f"select {text_columns()} from bronze"),
        "raw_row_counts": on_bronze(
            'select trip_month as month, count(*) as "rows", true as within_page_limit '
            "from bronze group by 1"),
        "dim_areas": on_bronze(
            "select area_no, area_name, area_airport, (select count(*) from bronze "
            "where pickup_community_area = area_no) as pickups from areas"),
        "create_tables": on_silver(
            "select 'bronze' as layer, 20 as columns, 'trip_month' as partition_columns, "
            'count(*) as "rows" from bronze union all '
            "select 'silver', 28, 'trip_month', count(*) from silver"),
        "silver_layout": on_silver(
            'select trip_month, count(*) as "rows", cast(0 as bigint) as misplaced '
            "from silver group by 1"),
        "month_overwrite": on_bronze(
            f'select trip_month, count(*) as "rows", {money("fare")} as fares from bronze '
            f"where payment_type is not null or not (trip_start_timestamp >= timestamp "
            f"'{RELOADED.start}' and trip_start_timestamp < timestamp '{RELOADED.end}') "
            "group by 1"),
        "mart_publish": on_silver(by_company()),
        "month_row_counts": on_bronze(
            'select trip_month, count(*) as "rows" from bronze group by 1'),
        "empty_month": on_bronze(
            'select trip_month, count(*) as "rows" from bronze '
            "where trip_month < (select max(trip_month) from bronze) group by 1"),

        "bronze_typed": on_bronze(f"select {_COLUMNS}, trip_month from bronze"),
        "window_filter": on_bronze(
            "select trip_id, trip_start_timestamp, trip_month from bronze "
            f"where trip_start_timestamp >= timestamp '{WINDOW.start}' "
            f"and trip_start_timestamp < timestamp '{WINDOW.end}'"),
        "silver_clean": on_bronze(
            "select trip_id, taxi_id, trip_start_timestamp, trip_seconds, trip_miles "
            "from guarded", KEYED, GUARDED.format(source="keyed")),
        "silver_dedupe": on_bronze(
            f"select {_COLUMNS}, trip_month from deduped", KEYED, DEDUPED),
        "silver_time": on_bronze(
            "select trip_id, trip_start_timestamp, "
            f"{derived('trip_date', 'trip_hour', 'dow_num', 'day_name')} from bronze"),
        "silver_metrics": on_bronze(
            "select trip_id, trip_seconds, trip_miles, fare, tips, "
            f"{derived('duration_min', 'speed_mph', 'tip_pct')} from guarded",
            GUARDED.format(source="bronze")),
        "silver_airport": on_bronze(
            "select trip_id, pickup_community_area, dropoff_community_area, "
            f"{derived('is_airport')} from bronze"),
        "silver_trips": on_silver("select * from silver"),
        "silver_profile": on_silver(
            'select trip_month, count(*) as "rows", count(distinct trip_id) as distinct_ids, '
            "min(fare) as min_fare, min(trip_start_timestamp) as min_ts, "
            "max(trip_start_timestamp) as max_ts, "
            "count(*) filter (where pickup_community_area is null) as null_pickup, "
            "max(speed_mph) as max_speed, min(tip_pct) as min_tip_pct, "
            "max(tip_pct) as max_tip_pct from silver group by 1"),
        "silver_cross_month": on_silver(
            "select trip_id, count(distinct trip_month) as months from silver group by 1 "
            "having count(distinct trip_month) > 1"),

        "gold_trips_daily": on_silver(daily()),
        "gold_trips_by_hour": on_silver(by_hour()),
        "gold_company": on_silver(by_company()),
        "gold_payment_mix": on_silver(payments()),
        "gold_top_routes": on_silver(
            "select t.pickup_community_area, p.area_name as pickup_area, "
            "t.dropoff_community_area, d.area_name as dropoff_area, trips, avg_fare, avg_miles "
            f"from ({routes(clause(NO_FILTER, *KNOWN_ROUTE), 50)}) t "
            "left join areas p on p.area_no = t.pickup_community_area "
            "left join areas d on d.area_no = t.dropoff_community_area"),
        "gold_pickup_area": on_silver(
            "select pickup_community_area, area_name, area_airport as is_airport, trips, revenue, "
            f"avg_fare from ({pickups(clause(NO_FILTER, KNOWN_PICKUP))}) t "
            "left join areas on area_no = pickup_community_area"),
        "gold_rollup": on_silver("select * exclude (label) from gold_profile", GOLD_PROFILE),
        "mart_counts": on_silver(" union all ".join(
            f"select '{mart}' as mart, {size} as \"rows\"" for mart, size in MART_SIZES.items())),

        "bi_options_dates": on_silver(
            "select min(trip_date) as date_min, max(trip_date) as date_max from silver"),
        "bi_options_companies": on_silver(
            "select distinct company from silver where company is not null"),
        "bi_options_payments": on_silver(
            "select distinct payment_type from silver where payment_type is not null"),
        "bi_options_areas": on_silver(
            "select pickup_community_area as code, area_name as name from silver "
            "join areas on pickup_community_area = area_no group by 1, 2"),
        "bi_summary": on_silver(summary()),
        "bi_filter_dates": on_silver(daily(clause(DATES))),
        "bi_filter_company": on_silver(summary("where company = 'Brand#7'")),
        "bi_filter_payment": on_silver(by_company("where payment_type = 'Cash'", "limit 15")),
        "bi_filter_area": on_silver(by_hour("where pickup_community_area = 76", "hour")),
        "bi_filter_weekend": on_silver(payments("where dow_num in (1, 7)")),
        "bi_filter_weekday": on_silver(payments("where dow_num not in (1, 7)")),
        "bi_trips_daily": on_silver(daily(clause(COMBINED))),
        "bi_trips_by_hour": on_silver(by_hour(clause(COMBINED), "hour")),
        "bi_company": on_silver(by_company(clause(COMBINED), "limit 15")),
        "bi_payment_mix": on_silver(payments(clause(DATES))),
        "bi_top_routes": on_silver(
            "select coalesce(nullif(p.area_name, ''), concat('Area ', t.pickup_community_area)) "
            "as pickup_area, coalesce(nullif(d.area_name, ''), "
            "concat('Area ', t.dropoff_community_area)) as dropoff_area, trips, avg_fare, "
            f"avg_miles from ({routes(clause(COMBINED, *KNOWN_ROUTE), 20)}) t "
            "left join areas p on p.area_no = t.pickup_community_area "
            "left join areas d on d.area_no = t.dropoff_community_area"),
        "bi_pickup_areas": on_silver(
            "select pickup_community_area, coalesce(nullif(area_name, ''), "
            "concat('Area ', pickup_community_area)) as area_name, "
            "coalesce(area_airport, false) as is_airport, trips, revenue, avg_fare "
            f"from ({pickups(clause(COMBINED, KNOWN_PICKUP))}) t "
            "left join areas on area_no = pickup_community_area "
            "order by trips desc, pickup_community_area limit 20"),
        "bi_heatmap": on_silver(
            "select d.dow_num, d.day_name, h.hour, coalesce(g.trips, 0) as trips, "
            "coalesce(g.trips, 0) / greatest((select max(trips) from hourly), 1) as intensity "
            "from (select distinct dow_num, day_name from hourly) d "
            "cross join (select cast(unnest(range(0, 24)) as int) as hour) h "
            "left join hourly g on g.dow_num = d.dow_num and g.hour = h.hour",
            "hourly as ("
            + by_hour("where company = 'Brand#7' and pickup_community_area = 30", "hour") + ")"),

        "adhoc_payment_counts": on_silver(
            "select payment_type, count(*) as trips from silver group by 1"),
        "adhoc_top_areas": on_silver(
            "select area_name, count(*) as trips from silver "
            "join areas on pickup_community_area = area_no group by 1 "
            "order by trips desc, area_name limit 10"),
        "adhoc_last_days": on_silver(daily() + " order by day desc limit 5"),
        "adhoc_totals": on_silver(
            f"select count(*) as trips, {money('trip_total')} as revenue from silver"),
        "bi_param_sql": on_silver(
            "select payment_type, count(*) as trips, max(fare) as max_fare from silver "
            "where trip_date between date '1996-01-01' and date '1999-12-31' "
            "and pickup_community_area = 30 group by 1"),

        "dq_raw": on_bronze(checked(f"({_BY_MONTH})", "raw/taxi_trips", [
            ("rows_landed_positive", "ERROR", "n > 0", "n"), VOLUME])),
        "dq_bronze": on_bronze(checked(f"({_BY_MONTH})", "bronze/taxi_trips", [
            ("row_count_positive", "ERROR", "n > 0", "n"),
            ("trip_start_not_null", "ERROR", "true", "0"),
            ("bronze_matches_raw", "WARN", "true", "0"), VOLUME])),
        "dq_silver": on_silver(SILVER_CHECKS, SILVER_PROFILE),
        "dq_gold": on_silver(GOLD_CHECKS, GOLD_PROFILE),
        "gate_status": on_silver("""
          select asset, "window",
            count(*) filter (where not passed and severity = 'ERROR') as errors,
            count(*) filter (where not passed and severity = 'WARN') as warnings,
            count(*) filter (where not passed and severity = 'ERROR') > 0 as blocked
          from results group by 1, 2""", SILVER_PROFILE, GOLD_PROFILE,
            f"results as ({SILVER_CHECKS}\nunion all\n{GOLD_CHECKS})"),
        "dq_freshness": f"""select event_type as asset, 'all' as "window",
            'freshness' as check_name, 'WARN' as severity,
            max(ts) >= timestamp '{NOW}' - interval 30 hour as passed,
            floor(epoch(timestamp '{NOW}' - max(ts))) as observed
          from events group by 1""",
        "ledger_latest": """select event_type as asset, event_id as run_id, ts as finished_at,
            concat(event_type, ':', event_id) as data_version from events
          qualify row_number() over (partition by event_type order by ts desc, event_id desc)
            = 1""",
        "alarm_report": """select event_id as run_id, strftime(ts, '%Y-%m') as "window",
            'check' as kind, event_type || ':value_in_range' as name,
            '{"value":"' || event_id || '"}' as detail
          from events where event_id % 3 <> 0 and value >= 100
          union all
          select event_id, strftime(ts, '%Y-%m'), 'step', event_type, 'step failed'
          from events where value < 1""",
        "exact_sums": """select l_returnflag, l_linenumber,
            cast(round(sum(cast(l_discount * l_tax / 1000 as decimal(38, 12))), 7) as double)
              as charges,
            cast(round(sum(cast(l_discount * l_tax / 1000 as decimal(38, 12)))::double
              / count(*), 10) as double) as avg_charge
          from lineitem group by all""",
        "retention_plan": f"""select table_name, version_id, committed_at from (
            select event_type as table_name, event_id as version_id, ts as committed_at,
              row_number() over (partition by event_type order by ts desc, event_id desc) as rn
            from events)
          where rn > 5 and committed_at < timestamp '{NOW}' - interval 7 day""",

        "plan_backfill": on_bronze("select * from months", MONTHS),
        "plan_delta": on_bronze("select * from months order by month desc limit 1", MONTHS),
        "plan_lookback": on_bronze("select * from months order by month desc limit 2", MONTHS),
        "backfill_months": on_silver(
            f"select trip_month, count(*) as trips, {money('trip_total')} as revenue "
            "from silver where trip_month <> (select distinct trip_month from silver "
            "order by 1 limit 1 offset 2) group by 1"),
        "compact_table": on_silver("select * exclude (trip_month) from silver"),
        "maintenance_summary": on_silver(
            "select t.table_name, t.status, t.compacted, case t.table_name "
            "when 'bronze.taxi_trips' then 0 "
            "when 'silver.taxi_trips' then (select count(*) from silver) "
            f"when 'gold.trips_by_company' then {MART_SIZES['trips_by_company']} end as \"rows\" "
            "from (values ('bronze.taxi_trips', 'maintained', false), "
            "('silver.taxi_trips', 'maintained', true), ('gold.mart_state', 'skipped', false), "
            "('gold.trips_daily', 'skipped', false), ('gold.trips_by_hour', 'skipped', false), "
            "('gold.trips_by_company', 'maintained', false), "
            "('gold.payment_mix', 'skipped', false), ('gold.top_routes', 'skipped', false), "
            "('gold.trips_by_pickup_area', 'skipped', false)) t(table_name, status, compacted)"),
    }
