"""One registered query per operator. Each takes (spark, folder of Parquet tables)."""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import datetime
from math import ceil
from urllib.parse import unquote, urlsplit

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from faremill import storage
from faremill.config import Thresholds
from faremill.functions.fixed_point import amount, mean, sum_units
from faremill.operators import windows
from faremill.operators.filters import Filters
from faremill.operators.windows import Window
from faremill.plans import adhoc, bi, bronze, checks, gold, ledger, maintain, pipeline, silver
from faremill.registry import runs, served
from faremill.registry.workspace import Workspace, new_lake, workspace
from faremill.schema import MONTH, SILVER_COLUMNS, TRIP_COLUMNS
from faremill.session import SHUFFLED_PER_STORED
from faremill.sources import areas as area_source
from faremill.sources import extract, feed, pages, raw_csv

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

NOW = runs.NOW                                   # "now" of the ledger queries
WINDOW = Window.of("1996-06", "1998-06")         # the window of window_filter
RELOADED = Window.of("1998-01", "1999-01")       # the months month_overwrite loads again
DATES = Filters(start="1997-02-10", end="1999-08-20")
FRAGMENT_BYTES = 128 << 20                       # shuffled bytes of a task that fragments a table
LAYOUT_ROWS = 100_000                            # rows of a file that silver_layout checks together
COMBINED = Filters(start="1996-01-01", end="2000-12-31", payment_type="Cash", day_type="weekday")


def register(query: Query) -> Query:
    REGISTRY[query.__name__] = query
    return query


def on_workspace(query: Callable[[Workspace], DataFrame]) -> Query:
    """Registers a query that reads the stored tables."""
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return query(workspace(spark, folder))

    REGISTRY[query.__name__] = run
    return run


def on_trips(query: Callable[[Workspace, bi.Trips], DataFrame]) -> Query:
    """Registers a BI query twice: bi_* on stored trips, and cube_* on the cube."""
    REGISTRY[query.__name__] = lambda spark, folder: query(
        workspace(spark, folder), workspace(spark, folder).silver)
    REGISTRY[f"cube_{query.__name__.removeprefix('bi_')}"] = lambda spark, folder: query(
        workspace(spark, folder), workspace(spark, folder).cube())
    return query


# sources and sinks ---------------------------------------------------------------------------

@on_workspace
def src_paged_extract(ws):
    """Landed rows read as a paged dataset, to which a row is added while it is read."""
    root = ws.landed().bronze_lake.raw_root
    parts = raw_csv.part_ranges(raw_csv.scan(ws.spark, root, ws.span)).collect()
    storage.write_text(ws.spark, f"{root}/{served.INDEX}", json.dumps(  # a row for each part
        [[unquote(urlsplit(p.part).path), p.first, p.last, p.rows] for p in parts if p.rows]))
    return extract.extract(ws.spark, root, ws.span, page_rows=2_000,
                           pages_per_task=5, source=pages.served_by(served.LandedPages))


@on_workspace
def src_folder_extract(ws):
    return extract.extract(ws.spark, ws.landed().bronze_lake.raw_root, ws.span)


@register
def land_month_csv(spark, folder):
    root, ws = storage.working_folder(spark, "raw"), workspace(spark, folder)
    raw_csv.land(ws.text(), root, ws.span, gathered=True)
    return raw_csv.scan(spark, root)


@on_workspace
def scan_raw_csv(ws):
    return raw_csv.scan(ws.spark, ws.landed().bronze_lake.raw_root, ws.span).select(*TRIP_COLUMNS)


@on_workspace
def raw_row_counts(ws):
    parts = raw_csv.part_counts(raw_csv.scan(ws.spark, ws.landed().bronze_lake.raw_root))
    return parts.groupBy("month").agg(
        F.sum("rows").alias("rows"),
        (F.max("rows") <= raw_csv.PAGE_ROWS).alias("within_page_limit"))


@on_workspace
def dim_areas(ws):
    path = storage.working_folder(ws.spark, "areas")
    (ws.areas.selectExpr("area_no as community_area", "area_name",
                         "cast(area_airport as int) as is_airport")
     .write.option("header", True).csv(path))
    starts = ws.bronze.groupBy("pickup_community_area").agg(F.count("*").alias("pickups"))
    areas = area_source.load(ws.spark, path)
    return (areas.join(starts, F.col("area_no") == F.col("pickup_community_area"), "left")
            .select("area_no", "area_name", "area_airport",
                    F.coalesce("pickups", F.lit(0).cast("bigint")).alias("pickups")))


@register
def create_tables(spark, folder):
    lake, ws = new_lake(spark), workspace(spark, folder)
    lake.overwrite_months(ws.bronze, "bronze")
    silver.load(lake, ws.span)
    described = [
        lake.table(layer).agg(F.count("*").alias("rows")).select(
            F.lit(layer).alias("layer"),
            F.lit(len(lake.table(layer).columns)).alias("columns"),
            F.lit(",".join(c.name for c in spark.catalog.listColumns(lake.name(layer))
                           if c.isPartition)).alias("partition_columns"), "rows")
        for layer in ("bronze", "silver")]
    return described[0].unionByName(described[1])


@on_workspace
def silver_layout(ws):
    """Stored rows that are out of the write order within their file."""
    stored = ws.silver.select(
        MONTH, F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("position"),
        F.struct("trip_start_timestamp",
                 F.coalesce("pickup_community_area", F.lit(-1))).alias("order_key"))
    # a file is checked in blocks; the last row of a block is also the one before the next block's
    block = F.floor(F.col("position") / LAYOUT_ROWS)
    ends = F.col("position") % LAYOUT_ROWS == LAYOUT_ROWS - 1
    blocks = stored.withColumn("block", F.explode(
        F.when(ends, F.array(block, block + 1)).otherwise(F.array(block))))
    in_block = W.partitionBy("file", "block").orderBy("position")
    checked = blocks.withColumn(
        "misplaced", F.col("order_key") < F.lag("order_key").over(in_block)).filter(
        F.col("block") == block)
    return checked.groupBy(MONTH).agg(F.count("*").alias("rows"),
                                      F.count_if("misplaced").alias("misplaced"))


@register
def exact_sums(spark, folder):
    """Sums and averages of amounts far below a cent."""
    small = spark.read.parquet(f"{folder}/lineitem.parquet").withColumn(
        "charge", F.col("l_discount") * F.col("l_tax") / 1000)
    return small.groupBy("l_returnflag", "l_linenumber").agg(
        amount(sum_units("charge"), 7).alias("charges"),
        mean(sum_units("charge"), F.count("charge"), 10).alias("avg_charge"))


@register
def month_overwrite(spark, folder):
    lake = new_lake(spark)
    trips = workspace(spark, folder).bronze
    lake.overwrite_months(trips, "bronze")
    corrected = windows.in_window(trips, RELOADED).filter(F.col("payment_type").isNotNull())
    for _ in range(2):  # a repeated load changes nothing
        lake.overwrite_months(corrected, "bronze")
    return lake.table("bronze").groupBy(MONTH).agg(
        F.count("*").alias("rows"), amount(sum_units("fare")).alias("fares"))


@on_workspace
def mart_publish(ws):
    lake = new_lake(ws.spark)
    lake.publish(gold.trips_by_company(ws.bronze), "trips_by_company")
    lake.publish(gold.trips_by_company(ws.silver), "trips_by_company")
    return lake.table("gold", "trips_by_company")


@on_workspace
def month_row_counts(ws):
    return ws.bronze_lake.month_counts("bronze")


@register
def empty_month(spark, folder):
    """Without raw files a month is kept by default, and removed on request."""
    lake, ws = new_lake(spark), workspace(spark, folder)
    lake.overwrite_months(ws.bronze, "bronze")
    months = ws.span.split()
    bronze.load(lake, months[0])
    bronze.load(lake, months[-1], drop_empty=True)
    return lake.month_counts("bronze")


# bronze and silver -----------------------------------------------------------------------------

def _typed_from_raw(ws: Workspace) -> DataFrame:
    return bronze.build(raw_csv.scan(ws.spark, ws.landed().bronze_lake.raw_root))


@on_workspace
def bronze_typed(ws):
    return _typed_from_raw(ws)


@on_workspace
def window_filter(ws):
    return ws.bronze_lake.read("bronze", WINDOW).select("trip_id", "trip_start_timestamp", MONTH)


@on_workspace
def silver_clean(ws):
    return silver.guard(silver.with_key(ws.bronze)).select(
        "trip_id", "taxi_id", "trip_start_timestamp", "trip_seconds", "trip_miles")


@on_workspace
def silver_dedupe(ws):
    return silver.dedupe(silver.with_key(ws.bronze))


@on_workspace
def silver_time(ws):
    return silver.time_fields(ws.bronze).select(
        "trip_id", "trip_start_timestamp", "trip_date", "trip_hour", "dow_num", "day_name")


@on_workspace
def silver_metrics(ws):
    return silver.metrics(silver.guard(ws.bronze)).select(
        "trip_id", "trip_seconds", "trip_miles", "fare", "tips",
        "duration_min", "speed_mph", "tip_pct")


@on_workspace
def silver_airport(ws):
    return silver.airport(ws.bronze).select(
        "trip_id", "pickup_community_area", "dropoff_community_area", "is_airport")


@on_workspace
def silver_trips(ws):
    return silver.build(_typed_from_raw(ws))


@on_workspace
def silver_profile(ws):
    return silver.profile(ws.silver)


@on_workspace
def silver_cross_month(ws):
    return silver.cross_month_repeats(ws.silver)


# gold ------------------------------------------------------------------------------------------

@on_workspace
def gold_trips_daily(ws):
    return gold.trips_daily(ws.silver)


@on_workspace
def gold_trips_by_hour(ws):
    return gold.trips_by_hour(ws.silver)


@on_workspace
def gold_company(ws):
    return gold.trips_by_company(ws.silver)


@on_workspace
def gold_payment_mix(ws):
    return gold.payment_mix(ws.silver)


@on_workspace
def gold_top_routes(ws):
    return gold.top_routes(ws.silver, ws.areas)


@on_workspace
def gold_pickup_area(ws):
    return gold.trips_by_pickup_area(ws.silver, ws.areas)


@on_workspace
def gold_rollup(ws):
    return gold.rollup(ws.published().lake.table("gold", "trips_daily"), ws.silver)


@on_workspace
def mart_counts(ws):
    return gold.counts(ws.marts())


# BI --------------------------------------------------------------------------------------------

@on_trips
def bi_options_dates(ws, trips):
    return bi.date_range(trips)


@on_trips
def bi_options_companies(ws, trips):
    return bi.options(trips, "company")


@on_trips
def bi_options_payments(ws, trips):
    return bi.options(trips, "payment_type")


@on_trips
def bi_options_areas(ws, trips):
    return bi.area_options(trips, ws.areas)


@on_trips
def bi_summary(ws, trips):
    return bi.summary(trips)


@on_trips
def bi_filter_dates(ws, trips):
    return bi.trips_daily(trips, DATES)


@on_trips
def bi_filter_company(ws, trips):
    return bi.summary(trips, Filters(company="Brand#7"))


@on_trips
def bi_filter_payment(ws, trips):
    return bi.trips_by_company(trips, Filters(payment_type="Cash"))


@on_trips
def bi_filter_area(ws, trips):
    return bi.trips_by_hour(trips, Filters(pickup_area=76))


@on_trips
def bi_filter_weekend(ws, trips):
    return bi.payment_mix(trips, Filters(day_type="weekend"))


@on_trips
def bi_filter_weekday(ws, trips):
    return bi.payment_mix(trips, Filters(day_type="weekday"))


@on_trips
def bi_trips_daily(ws, trips):
    return bi.trips_daily(trips, COMBINED)


@on_trips
def bi_trips_by_hour(ws, trips):
    return bi.trips_by_hour(trips, COMBINED)


@on_trips
def bi_company(ws, trips):
    return bi.trips_by_company(trips, COMBINED)


@on_trips
def bi_payment_mix(ws, trips):
    return bi.payment_mix(trips, DATES)


@on_trips
def bi_top_routes(ws, trips):
    return bi.top_routes(trips, ws.areas, COMBINED)


@on_trips
def bi_pickup_areas(ws, trips):
    return bi.pickup_areas(trips, ws.areas, COMBINED)


@on_trips
def bi_heatmap(ws, trips):
    return bi.heatmap(trips, Filters(company="Brand#7", pickup_area=30))


# ad-hoc SQL --------------------------------------------------------------------------------------

def _script(ws: Workspace, text: str, args: dict | None = None) -> DataFrame:
    return adhoc.run_script(ws.spark, text, args)[-1]


@on_workspace
def adhoc_payment_counts(ws):
    return _script(ws, "SELECT payment_type, count(*) AS trips "
                       f"FROM {ws.lake.name('silver')} GROUP BY 1 ORDER BY 2 DESC;")


@on_workspace
def adhoc_top_areas(ws):
    ws.lake.register_areas(ws.areas)
    return _script(ws, f"""
        SELECT a.area_name, count(*) AS trips FROM {ws.lake.name('silver')} s
        JOIN areas a ON s.pickup_community_area = a.area_no
        GROUP BY 1 ORDER BY trips DESC, area_name LIMIT 10;""")


@on_workspace
def adhoc_last_days(ws):
    daily = ws.published().lake.name("gold", "trips_daily")
    return _script(ws, f"SELECT * FROM {daily} ORDER BY day DESC LIMIT 5;")


@on_workspace
def adhoc_totals(ws):
    return _script(ws, f"""
        SELECT count(*) AS trips,
               round(cast(sum(cast(trip_total AS decimal(18,4))) AS double), 2) AS revenue
        FROM {ws.lake.name('silver')}""")


@on_workspace
def bi_param_sql(ws):
    return _script(ws, f"""
        SELECT payment_type, count(*) AS trips, max(fare) AS max_fare
        FROM {ws.lake.name('silver')}
        WHERE trip_date >= :start AND trip_date <= :end AND pickup_community_area = :area
        GROUP BY payment_type""", {
            "start": datetime(1996, 1, 1).date(), "end": datetime(1999, 12, 31).date(),
            "area": 30})


# checks and ledgers ------------------------------------------------------------------------------

CHECK_COLUMNS = ["asset", "window", "check_name", "severity", "passed", "observed"]


def _raw_profile(ws: Workspace) -> DataFrame:
    raw = raw_csv.scan(ws.spark, ws.landed().bronze_lake.raw_root)
    return raw.groupBy(F.col("month").alias("window")).agg(F.count("*").alias("rows"))


def _silver_checks(ws: Workspace) -> DataFrame:
    months = windows.plan_months(ws.silver, "trip_start_timestamp").select(
        F.col("month").alias(MONTH))
    return checks.silver(checks.silver_profile(
        months, ws.bronze_lake.month_counts("bronze"), silver.profile(ws.silver)))


def _gold_checks(ws: Workspace) -> DataFrame:
    return checks.gold(checks.gold_profile(ws.marts(), ws.silver))


@on_workspace
def dq_raw(ws):
    return checks.raw(_raw_profile(ws)).select(*CHECK_COLUMNS)


@on_workspace
def dq_bronze(ws):
    stored = ws.bronze.groupBy(F.col(MONTH).alias("window")).agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("trip_start_timestamp").isNull()).alias("null_starts"))
    raw = _raw_profile(ws).withColumnRenamed("rows", "raw_rows")
    profile = raw.join(stored, "window", "left").fillna(0, ["rows", "null_starts"])
    return checks.bronze(profile).select(*CHECK_COLUMNS)


@on_workspace
def dq_silver(ws):
    return _silver_checks(ws).select(*CHECK_COLUMNS)


@on_workspace
def dq_gold(ws):
    return _gold_checks(ws).select(*CHECK_COLUMNS)


@on_workspace
def gate_status(ws):
    return checks.gate_status(_silver_checks(ws).unionByName(_gold_checks(ws)))


def _events(spark, folder):
    return spark.read.parquet(f"{folder}/events.parquet")


@register
def dq_freshness(spark, folder):
    rebuilds = _events(spark, folder).selectExpr("event_type as asset", "ts as finished_at")
    return ledger.freshness(rebuilds, NOW, Thresholds.stale_after_hours).select(*CHECK_COLUMNS)


@register
def ledger_latest(spark, folder):
    records = _events(spark, folder).selectExpr(
        "event_id as run_id", "event_type as asset", "ts as finished_at",
        "concat(event_type, ':', event_id) as data_version")
    return ledger.latest(records)


@register
def alarm_report(spark, folder):
    events = _events(spark, folder)
    results = events.selectExpr(
        "event_id as run_id", "event_type as asset", "substring(cast(ts as string), 1, 7) as window",
        "'value_in_range' as check_name",
        "case when event_id % 3 = 0 then 'WARN' else 'ERROR' end as severity",
        "value < 100 as passed", "map('value', cast(event_id as string)) as metadata")
    steps = events.selectExpr(
        "event_id as run_id", "event_type as step", "substring(cast(ts as string), 1, 7) as window",
        "case when value < 1 then 'FAILED' else 'DONE' end as status",
        "cast(null as string) as error")
    return ledger.alarms(results, steps)


@register
def retention_plan(spark, folder):
    versions = _events(spark, folder).selectExpr(
        "event_type as table_name", "event_id as version_id", "ts as committed_at")
    return maintain.retention_plan(versions, NOW)


# planning and maintenance --------------------------------------------------------------------------

def _planned(ws: Workspace) -> list[Window]:
    """What the jobs plan from the first month with trips until the month after the last."""
    first, last = ws.bronze.agg(F.min(MONTH), F.max(MONTH)).first()
    return windows.backfill(first, None, Window.of(last).end)


@on_workspace
def plan_backfill(ws):
    return windows.as_rows(ws.spark, _planned(ws))


@on_workspace
def plan_delta(ws):
    return windows.as_rows(ws.spark, windows.delta(_planned(ws)))


@on_workspace
def plan_lookback(ws):
    return windows.as_rows(ws.spark, windows.lookback(_planned(ws)))


@register
def backfill_months(spark, folder):
    """Raw text through all layers for every month but the third and one that has no rows, which
    fails alone; then the last two months once more."""
    lake, ws = new_lake(spark), workspace(spark, folder)
    source, planned = ws.text(), ws.span.split()
    how = {"gathered": True, "compression": "gzip"}
    empty = Window.of("2030-01")
    try:
        pipeline.backfill(lake, [*planned[:2], *planned[3:], empty], source, **how)
    except checks.GateError as problem:
        if problem.windows != {empty.label}:
            raise
    pipeline.backfill(lake, windows.lookback(planned), source, **how)
    return lake.table("silver").groupBy(MONTH).agg(
        F.count("*").alias("trips"), amount(sum_units("trip_total")).alias("revenue"))


def _fragmented(spark, folder):
    """A lake whose silver months consist of many files."""
    lake, ws = new_lake(spark), workspace(spark, folder)
    shuffled = SHUFFLED_PER_STORED * storage.size(spark, ws.lake.location("silver"))
    trips = ws.silver.repartition(max(5, ceil(shuffled / FRAGMENT_BYTES)))
    lake.overwrite_months(trips, "silver", cluster=())
    return lake


@register
def compact_table(spark, folder):
    lake = _fragmented(spark, folder)
    maintain.compact_months(lake, "silver", min_small_files=2)
    return lake.table("silver").select(*SILVER_COLUMNS)


@register
def maintenance_summary(spark, folder):
    lake = _fragmented(spark, folder)
    lake.publish(gold.trips_by_company(lake.table("silver")), "trips_by_company")
    summary = maintain.run(lake, NOW, min_small_files=2)
    kept = [lake.table(*name).agg(F.count("*").alias("rows")).select(
        F.lit(".".join(name)).alias("table_name"), "rows")
        for name in (("bronze", "taxi_trips"), ("silver", "taxi_trips"),
                     ("gold", "trips_by_company"))]
    counted = kept[0].unionByName(kept[1]).unionByName(kept[2])
    return summary.join(counted, "table_name", "left").select(
        "table_name", "status", (F.col("rewritten") > F.col("added")).alias("compacted"), "rows")


REGISTRY |= runs.QUERIES
