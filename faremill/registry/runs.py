"""Queries on run records, planning and late corrections, and on trips with flaws.

The flaws are written once as SQL that both engines run; what becomes of them is computed apart."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from faremill import storage
from faremill.config import Thresholds
from faremill.functions.fixed_point import amount, sum_units
from faremill.operators import windows
from faremill.operators.windows import Window
from faremill.plans import bronze, checks, gold, ledger, pipeline, silver
from faremill.records import Records
from faremill.registry.workspace import Workspace, new_lake, workspace
from faremill.schema import MONTH, TRIP_COLUMNS
from faremill.sources import feed, raw_csv

NOW = datetime(2024, 1, 31)

# flaws -----------------------------------------------------------------------------------------

ORDER = "coalesce(cast(split_part(trip_id, '-', 1) as bigint), 1)"
START_TEXT = "trip_start_timestamp"
# Raw text: column -> its flawed text, by order number.
FLAWED_TEXT = {
    "trip_start_timestamp": f"""case when {ORDER} % 59 = 0 then null
        when {ORDER} % 73 = 0 then '2023-13-45T00:00:00.000'
        when {ORDER} % 79 = 0 then substr({START_TEXT}, 1, 10) || ' ' || substr({START_TEXT}, 12)
        when {ORDER} % 61 = 0 then substr({START_TEXT}, 1, 19) else {START_TEXT} end""",
    "fare": f"""case when {ORDER} % 53 = 0 then 'n/a' when {ORDER} % 47 = 0 then ''
        else fare end""",
    "trip_miles": f"case when {ORDER} % 67 = 0 then 'NaN' when {ORDER} % 43 = 0 then 'inf' "
                  "else trip_miles end",
    "trip_seconds": f"case when {ORDER} % 71 = 0 then '12 minutes' else trip_seconds end",
    "company": f"case when {ORDER} % 83 = 0 then 'A \"B\", C' else company end",
}
MONTH_NUMBER = (f"(cast(substr({MONTH}, 1, 4) as int) * 12"
                f" + cast(substr({MONTH}, 6, 2) as int))")
# Silver rows: which stay, and column -> its flawed value, by month number and hour.
FLAWED_SILVER_ROWS = (f"{MONTH_NUMBER} % 7 <> 0 and "
                      f"not ({MONTH_NUMBER} % 6 = 0 and trip_hour < 12)")
FLAWED_SILVER = {
    "trip_id": f"case when {MONTH_NUMBER} % 2 = 0 and trip_hour in (0, 1, 13, 14) then 'again' "
               "else trip_id end",
    "fare": f"case when {MONTH_NUMBER} % 3 = 0 and trip_hour = 13 then cast(-1 as double) "
            "else fare end",
    "trip_start_timestamp": f"case when {MONTH_NUMBER} % 5 = 0 and trip_hour = 15 "
                            "then trip_start_timestamp + interval 40 days "
                            "else trip_start_timestamp end",
    "pickup_community_area": f"case when {MONTH_NUMBER} % 4 = 0 and trip_hour <> 16 then null "
                             "else pickup_community_area end",
    "speed_mph": f"case when {MONTH_NUMBER} % 11 = 0 and trip_hour = 17 then cast(151 as double) "
                 "else speed_mph end",
    "tip_pct": f"case when {MONTH_NUMBER} % 13 = 0 and trip_hour = 18 then cast(3 as double) "
               "else tip_pct end",
}
FLAWED_BRONZE_ROWS = (f"{MONTH_NUMBER} % 7 <> 0 and "
                      f"not ({MONTH_NUMBER} % 6 = 0 and {ORDER} % 3 = 1)")
FLAWED_BRONZE_START = (f"case when {MONTH_NUMBER} % 5 = 0 and {ORDER} % 3 = 0 then null "
                       "else trip_start_timestamp end")
FLAWED_RAW_ROWS = f"{MONTH_NUMBER} % 7 <> 0 and ({MONTH_NUMBER} % 4 <> 0 or {ORDER} % 40 = 0)"
LIMITS = Thresholds(volume_min=30, volume_max=100_000)
# What is wrong with the marts -> profile column and its value.
FLAWED_GOLD = {
    "no days": {"daily_rows": "0", "min_revenue": "null"},
    "negative day": {"min_revenue": "-0.01"},
    "lost revenue": {"gold_revenue": "gold_revenue * 0.98"},
    "lost trips": {"gold_trips": "gold_trips - 1"},
    "no groups": {f"rows_{mart}": "0" for mart in gold.MARTS if mart != "trips_daily"},
    "nothing wrong": {},
}
FLAWS_LOADED = Window.of("1997-01", "1997-07")
STRAY = "trip_month = '1997-02' and " + ORDER + " % 29 = 0"  # rows put into the folder of March
CHECK_COLUMNS = ["asset", "window", "check_name", "severity", "passed", "observed"]


def with_flaws(df: DataFrame, flaws: dict[str, str]) -> DataFrame:
    return df.select(*[F.expr(flaws[c]).cast(df.schema[c].dataType).alias(c) if c in flaws
                       else F.col(c) for c in df.columns])


def _flawed_text(spark, folder) -> DataFrame:
    return with_flaws(feed.as_text(feed.trips(spark, folder)), FLAWED_TEXT)


def bronze_flawed(spark, folder):
    return bronze.build(_flawed_text(spark, folder))


def load_flawed(spark, folder):
    """Raw months with malformed cells, starts that are missing or of another layout, and rows in
    the folder of another month: per month what was read, kept and stored, and the counters of the
    whole load."""
    lake = new_lake(spark)
    text = _flawed_text(spark, folder)
    month = F.substring("trip_start_timestamp", 1, 7)
    own = F.coalesce(F.when(month == "2023-13", F.lit(None)).otherwise(month),
                     F.lit(FLAWS_LOADED.months[0]))
    placed = text.withColumn(MONTH, own)
    (placed.withColumn("month", F.expr(f"case when {STRAY} then '1997-03' else {MONTH} end"))
     .filter(F.col("month").isin(FLAWS_LOADED.months)).drop(MONTH)
     .write.partitionBy("month").options(header=True, escape='"').csv(lake.raw_root))
    loaded = bronze.load(lake, FLAWS_LOADED)
    rows = [(m, loaded.raw_rows[m], loaded.kept[m], loaded.missing_start, loaded.other_month,
             *[loaded.bad_cells.get(c, 0) for c in FLAWED_TEXT if c != "company"])
            for m in FLAWS_LOADED.months]
    counted = spark.createDataFrame(
        rows, f"{MONTH} string, raw_rows bigint, kept bigint, missing_start bigint, "
        "other_month bigint, " + ", ".join(f"bad_{c} bigint" for c in FLAWED_TEXT
                                           if c != "company"))
    return counted.join(lake.month_counts("bronze"), MONTH, "left")


def _months(ws: Workspace) -> DataFrame:
    planned = windows.backfill(ws.span.months[0], None, ws.span.end)
    return windows.as_rows(ws.spark, planned).select(F.col("month").alias(MONTH))


def _raw_flawed(ws: Workspace) -> DataFrame:
    raw = raw_csv.scan(ws.spark, ws.landed().bronze_lake.raw_root).withColumn(MONTH, F.col("month"))
    counted = raw.filter(FLAWED_RAW_ROWS).groupBy(MONTH).agg(F.count("*").alias("rows"))
    profile = _months(ws).join(counted, MONTH, "left").fillna(0, ["rows"])
    return checks.raw(profile.withColumnRenamed(MONTH, "window"), LIMITS)


def _bronze_flawed(ws: Workspace) -> DataFrame:
    stored = (ws.bronze.filter(FLAWED_BRONZE_ROWS)
              .withColumn("trip_start_timestamp", F.expr(FLAWED_BRONZE_START))
              .groupBy(MONTH).agg(F.count("*").alias("rows"), F.count_if(
                  F.col("trip_start_timestamp").isNull()).alias("null_starts")))
    raw = ws.bronze_lake.month_counts("bronze").withColumnRenamed("rows", "raw_rows")
    profile = (_months(ws).join(raw, MONTH, "left").join(stored, MONTH, "left")
               .fillna(0, ["raw_rows", "rows", "null_starts"]))
    return checks.bronze(profile.withColumnRenamed(MONTH, "window"), LIMITS)


def _silver_flawed(ws: Workspace) -> DataFrame:
    flawed = with_flaws(ws.silver.filter(FLAWED_SILVER_ROWS), FLAWED_SILVER)
    return checks.silver(checks.silver_profile(
        _months(ws), ws.bronze_lake.month_counts("bronze"), silver.profile(flawed)))


def _gold_flawed(ws: Workspace) -> DataFrame:
    whole = checks.gold_profile(ws.marts(), ws.silver).drop("window")
    named = whole.withColumn("window", F.explode(F.array(*map(F.lit, FLAWED_GOLD))))
    for name, flaws in FLAWED_GOLD.items():
        named = named.withColumns({
            c: F.when(F.col("window") == name, F.expr(value)).otherwise(F.col(c))
            for c, value in flaws.items()})
    return checks.gold(named)


def dq_raw_flawed(spark, folder):
    return _raw_flawed(workspace(spark, folder)).select(*CHECK_COLUMNS)


def dq_bronze_flawed(spark, folder):
    return _bronze_flawed(workspace(spark, folder)).select(*CHECK_COLUMNS)


def dq_silver_flawed(spark, folder):
    return _silver_flawed(workspace(spark, folder)).select(*CHECK_COLUMNS)


def dq_gold_flawed(spark, folder):
    return _gold_flawed(workspace(spark, folder)).select(*CHECK_COLUMNS)


def gate_flawed(spark, folder):
    ws = workspace(spark, folder)
    results = _raw_flawed(ws)
    for more in (_bronze_flawed(ws), _silver_flawed(ws), _gold_flawed(ws)):
        results = results.unionByName(more)
    return checks.gate_status(results)


def dq_freshness_assets(spark, folder):
    """An asset per event type and day, so that most are stale."""
    rebuilds = _events(spark, folder).selectExpr(
        "concat(event_type, '-', day(ts)) as asset", "ts as finished_at")
    return ledger.freshness(rebuilds, NOW, Thresholds.stale_after_hours).select(*CHECK_COLUMNS)


# ledgers ---------------------------------------------------------------------------------------

def _events(spark, folder) -> DataFrame:
    return spark.read.parquet(f"{folder}/events.parquet")


def ledger_fold(spark, folder):
    """Records written in 24 entries, of which 16 are folded before the others come."""
    records = _events(spark, folder).selectExpr(
        "cast(event_id as string) as run_id", "event_type as asset", "'all' as window",
        "concat(event_type, ':', event_id) as data_version", "ts as finished_at",
        "map('id', cast(event_id as string)) as metadata", "event_id % 24 as entry")
    book = Records(spark, storage.working_folder(spark, "ledger"), ledger.MATERIALIZATION_DDL)
    for entry in range(24):
        book.append(records.filter(F.col("entry") == entry).drop("entry"))
        if entry == 15:
            book.fold(at_least=16)
    before = book.read().count()
    book.fold(at_least=8)
    return (ledger.latest(book.read()).select("asset", "finished_at")
            .withColumn("records", F.lit(book.read().count()))
            .withColumn("before_fold", F.lit(before))
            .withColumn("entries", F.lit(book.entries())))


def _attempts(spark, folder) -> DataFrame:
    """Events as attempts: values below 70 make a run fail its check or break its step."""
    events = _events(spark, folder).selectExpr(
        "cast(event_id as string) as run_id", "event_type as asset",
        "concat('2024-01-', lpad(cast(day(ts) as string), 2, '0')) as window", "ts", "value")
    results = events.filter("value < 50").selectExpr(
        "run_id", "asset", "window", "'value_in_range' as check_name", "'ERROR' as severity",
        "false as passed", "ts as recorded_at")
    steps = events.filter("value >= 50 and value < 70").selectExpr(
        "run_id", "asset as step", "window", "'FAILED' as status", "ts as finished_at")
    loads = events.filter("value < 50 or value >= 70").selectExpr(
        "run_id", "asset", "window", "ts as finished_at")
    return ledger.attempts(results, steps, loads)


def failure_streaks(spark, folder):
    return ledger.failure_streaks(_attempts(spark, folder))


def failure_standing(spark, folder):
    return ledger.standing(_attempts(spark, folder))


def ledger_gaps(spark, folder):
    """Planned months against records of the months' loads, with holes, failures and late sources."""
    ws = workspace(spark, folder)
    months = (ws.bronze_lake.month_counts("bronze").withColumn("n", F.expr(MONTH_NUMBER))
              .withColumn("at", F.expr("timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(n)")))
    one = months.filter("n % 8 not in (1, 2, 3) and n % 29 not in (3, 4)")
    loads = one.selectExpr(f"'{checks.SILVER}' as asset", f"{MONTH} as window", "at as finished_at")
    spans = months.filter("n % 29 = 3").selectExpr(  # one record for two months
        f"'{checks.SILVER}' as asset",
        f"concat({MONTH}, '..', substr(cast(add_months(cast(concat({MONTH}, '-01') as date), 1) "
        "as string), 1, 7)) as window", "at as finished_at")
    fed = months.selectExpr(
        f"'{checks.BRONZE}' as asset", f"{MONTH} as window",
        "at + make_dt_interval(if(n % 5 = 0, 1, -1)) as finished_at")
    steps = months.filter("n % 11 = 0").selectExpr(
        f"{MONTH} as window", "'FAILED' as status", "at + make_dt_interval(2) as finished_at")
    results = months.filter("n % 13 = 0").selectExpr(  # before the load: mended since
        f"{MONTH} as window", "'ERROR' as severity", "false as passed",
        "at - make_dt_interval(2) as recorded_at")
    return ledger.month_ranges(ledger.month_status(
        _months(ws), loads.unionByName(spans).unionByName(fed), results, steps, checks.BRONZE,
        checks.SILVER))


def backfill_missing(spark, folder):
    """Three of five months are loaded, one of them fails its checks; a second run loads what the
    ledger does not show as loaded, and a third finds nothing to do."""
    lake, ws = new_lake(spark), workspace(spark, folder)
    source = ws.text()
    planned = ws.span.split()[:5]
    broken = source.filter(F.substring("trip_start_timestamp", 1, 7) != planned[2].label)
    try:
        pipeline.backfill(lake, [planned[0], planned[2], planned[4]], broken)
    except checks.GateError:
        pass
    done = [{m.label for m in pipeline.backfill_missing(lake, planned, source)} for _ in range(2)]
    return lake.table("silver").groupBy(MONTH).agg(
        F.count("*").alias("trips"), amount(sum_units("trip_total")).alias("revenue")).select(
        "*", F.col(MONTH).isin(list(done[0])).alias("second_run"),
        (F.lit(len(done[1])) > 0).alias("third_run"))


def lookback_changes(spark, folder):
    """Two loaded months come again, one of them with corrected tolls: only that one is loaded."""
    lake, ws = new_lake(spark), workspace(spark, folder)
    source = ws.text()
    planned = ws.span.split()[:3]
    pipeline.backfill(lake, planned, source)
    late = (F.substring("trip_start_timestamp", 1, 7) == planned[2].label) & (
        F.substring("trip_start_timestamp", 12, 2) == "13")
    corrected = source.withColumn("tolls", F.when(late, "7.25").otherwise(F.col("tolls")))
    changed = {m.label for m in pipeline.reload_changed(
        lake, windows.lookback(planned), corrected)}
    again = pipeline.reload_changed(lake, windows.lookback(planned), corrected)
    return lake.table("silver").groupBy(MONTH).agg(
        F.count("*").alias("trips"), amount(sum_units("tolls")).alias("tolls")).select(
        "*", F.col(MONTH).isin(list(changed)).alias("reloaded"), F.lit(len(again)).alias("again"))


QUERIES = {query.__name__: query for query in (
    bronze_flawed, load_flawed, dq_raw_flawed, dq_bronze_flawed, dq_silver_flawed, dq_gold_flawed,
    gate_flawed, dq_freshness_assets, ledger_fold, failure_streaks, failure_standing, ledger_gaps,
    backfill_missing, lookback_changes)}
