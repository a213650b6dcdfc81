"""Whole runs: ingest of a window, backfill, and the post-processing that follows."""

from __future__ import annotations

import uuid
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, Row, functions as F

from faremill import storage
from faremill.config import Thresholds
from faremill.lake import Lake
from faremill.operators import digests, windows as windows_of
from faremill.operators.windows import Window
from faremill.plans import bronze, checks, cube, gold, ledger as run_ledgers, maintain, silver
from faremill.plans.ledger import Ledger
from faremill.schema import MONTH
from faremill.session import sized_shuffles
from faremill.sources import raw_csv


def _gate(ledger: Ledger, results: DataFrame) -> None:
    checks.assert_gate(ledger.record(results))


def _evaluated(profile: DataFrame) -> tuple[DataFrame, list[Row]]:
    """A profile computed once: as rows for the run record, and as a frame for the checks. It has
    one row per month of the run."""
    found = profile.collect()
    return profile.sparkSession.createDataFrame(found, profile.schema), found


def land(lake: Lake, source: DataFrame, window: Window, ledger: Ledger,
         limits: Thresholds = Thresholds(), **how) -> dict[str, int]:
    with ledger.step("raw.land", window.label) as info:
        landed = raw_csv.land(source, lake.raw_root, window, **how)
        info["rows"] = sum(landed.values())
    ledger.materialized(checks.RAW, window.label, sum(landed.values()), location=lake.raw_root)
    profile = lake.spark.createDataFrame(list(landed.items()), "window string, rows bigint")
    _gate(ledger, checks.raw(profile, limits))
    return landed


def load_bronze(lake: Lake, window: Window, ledger: Ledger, limits: Thresholds = Thresholds(),
                strict: bool = False, drop_empty: bool = False) -> bronze.BronzeLoad:
    """Typed load of the raw window. The checks see the rows of this load, so a month whose raw
    files are gone fails whatever the table still holds of it."""
    with ledger.step("bronze.load", window.label) as info:
        loaded = bronze.load(lake, window, strict=strict, drop_empty=drop_empty)
        info.update(raw_rows=sum(loaded.raw_rows.values()), kept_rows=loaded.kept_rows)
    # a kept row's month is that of its start, so none of them lacks one
    profile = lake.spark.createDataFrame(
        [(month, raw, loaded.kept[month], 0) for month, raw in loaded.raw_rows.items()],
        "window string, raw_rows bigint, rows bigint, null_starts bigint")
    ledger.materialized(checks.BRONZE, window.label, loaded.kept_rows,
                        raw_rows=sum(loaded.raw_rows.values()), missing_start=loaded.missing_start,
                        other_month=loaded.other_month, bad_cells=loaded.bad_cells,
                        **{f"{run_ledgers.DIGEST}{month}": digest
                           for month, digest in loaded.digests.items()})
    _gate(ledger, checks.bronze(profile, limits))
    return loaded


def load_silver(lake: Lake, window: Window, ledger: Ledger, limits: Thresholds = Thresholds(),
                drop_empty: bool = False) -> None:
    with ledger.step("silver.load", window.label):
        silver.load(lake, window, drop_empty=drop_empty)
    months = lake.spark.createDataFrame([(m,) for m in window.months], f"{MONTH} string")
    stored = sum(storage.size(lake.spark, f"{lake.location('silver')}/{MONTH}={month}")
                 for month in window.months)
    with sized_shuffles(lake.spark, stored):  # all ids of the window are shuffled
        profile, found = _evaluated(checks.silver_profile(
            months, lake.month_counts("bronze", window),
            silver.profile(lake.read_partitions("silver", window))))
    rows = sum(row["rows"] for row in found)
    ledger.materialized(
        checks.SILVER, window.label, rows,
        bronze_rows=sum(row["bronze_rows"] for row in found),
        distinct_trip_ids=sum(row["distinct_ids"] for row in found),
        null_pickup_area_rate=round(sum(row["null_pickup"] for row in found) / max(rows, 1), 4),
        max_speed_mph=max((row["max_speed"] or 0.0 for row in found), default=0.0),
        max_tip_pct=max((row["max_tip_pct"] or 0.0 for row in found), default=0.0))
    _gate(ledger, checks.silver(profile, limits))


def ingest(lake: Lake, window: Window, source: DataFrame | None = None,
           limits: Thresholds = Thresholds(), drop_empty: bool = False) -> Ledger:
    """raw -> bronze -> silver for one window; a failed blocking check stops before the next
    layer. Without ``source`` the raw months are expected to be landed already."""
    ledger = Ledger(lake)
    if source is not None:
        land(lake, source, window, ledger, limits)
    load_bronze(lake, window, ledger, limits, drop_empty=drop_empty)
    load_silver(lake, window, ledger, limits, drop_empty=drop_empty)
    return ledger


def _tried(stage, window: Window, problems: list[Exception]) -> set[str]:
    """Runs a stage; returns the months that failed it. When a job of several months breaks, each
    of them is tried on its own."""
    try:
        stage(window)
        return set()
    except checks.GateError as problem:
        problems.append(problem)
        return problem.windows
    except Exception as problem:
        if len(window.months) == 1:
            problems.append(problem)
            return set(window.months)
        return set().union(*[_tried(stage, month, problems) for month in window.split()])


def backfill(lake: Lake, windows: list[Window], source: DataFrame | None = None,
             limits: Thresholds = Thresholds(), by_month: bool = False,
             **how) -> list[Ledger]:
    """Load exactly the given months. Each is gated on its own: one that fails a blocking check
    stops there, the others go on, and the run ends with an error that names all that failed.

    Adjacent months share their jobs, unless ``by_month``. ``how`` the source is landed are
    options of ``raw_csv.land``, as ``gathered`` or ``compression``."""
    ledger, problems = Ledger(lake), []
    months = sorted({month.start: month for w in windows for month in w.split()}.items())
    good = [month for _, month in months]
    stages = [lambda w: load_bronze(lake, w, ledger, limits),
              lambda w: load_silver(lake, w, ledger, limits)]
    if source is not None:
        stages.insert(0, lambda w: land(lake, source, w, ledger, limits, **how))
    for stage in stages:
        failed: set[str] = set()
        for window in good if by_month else windows_of.spans(good):
            failed |= _tried(stage, window, problems)
        good = [month for month in good if month.label not in failed]
    if problems:
        done = {month.label for month in good}
        raise checks.GateError(
            "; ".join(str(problem) for problem in problems),
            [month.label for _, month in months if month.label not in done])
    return [ledger] if months else []


def changed_months(lake: Lake, months: list[Window], landed: str) -> list[Window]:
    """Those of the months whose raw rows below ``landed`` are not what bronze was loaded from. A
    month without a recorded digest counts as changed, as does one that has lost all its rows."""
    ledger = Ledger(lake)
    wanted = windows_of.as_rows(lake.spark, months).select(F.col("month").alias(MONTH))
    spans = windows_of.spans(months)
    raw = [raw_csv.scan(lake.spark, landed, span) for span in spans]
    found = digests.by_month(bronze.build(reduce(DataFrame.unionByName, raw)))
    known = run_ledgers.month_digests(ledger.table("materializations"), checks.BRONZE)
    differ = digests.differing(wanted.join(found, MONTH, "left"), known).collect()
    labels = {row[MONTH] for row in differ}
    return [month for month in months if month.label in labels]


def reload_changed(lake: Lake, months: list[Window], source: DataFrame,
                   limits: Thresholds = Thresholds(), by_month: bool = False) -> list[Window]:
    """Lookback: reads the months' source once into a staging folder and loads those months whose
    rows differ from the loaded ones, in whatever order they come. Returns the months loaded.

    A count of rows could not see a corrected amount; an equal month costs no write at all."""
    ledger, staged = Ledger(lake), f"{lake.root}/staging/raw-{uuid.uuid4().hex}"
    try:
        with ledger.step("lookback.compare", windows_of.spans(months)[0].label if months else "none"
                         ) as info:
            for span in windows_of.spans(months):
                raw_csv.land(source, staged, span)
            changed = changed_months(lake, months, staged)
            info.update(months=len(months), changed=len(changed))
        if changed:
            backfill(lake, changed, raw_csv.scan(lake.spark, staged), limits, by_month)
        return changed
    finally:
        storage.delete(lake.spark, staged)


def unloaded(lake: Lake, planned: list[Window]) -> DataFrame:
    """(status, first_month, last_month, months) of planned months that silver misses, whose load
    failed, or whose bronze is newer."""
    ledger = Ledger(lake)
    months = windows_of.as_rows(lake.spark, planned).select(F.col("month").alias(MONTH))
    return run_ledgers.month_ranges(run_ledgers.month_status(
        months, ledger.table("materializations"), ledger.table("check_results"),
        ledger.table("step_runs"), checks.BRONZE, checks.SILVER))


def backfill_missing(lake: Lake, planned: list[Window], source: DataFrame | None = None,
                     limits: Thresholds = Thresholds(), by_month: bool = False) -> list[Window]:
    """Backfill of the planned months that the ledger does not show as loaded."""
    ranges = unloaded(lake, planned).collect()  # at most one row per planned month
    labels = {month for row in ranges for month in Window(
        Window.of(row["first_month"]).start, Window.of(row["last_month"]).end).months}
    months = [month for window in planned for month in window.split() if month.label in labels]
    backfill(lake, months, source, limits, by_month)
    return months


def rebuild_gold(lake: Lake, areas: DataFrame, ledger: Ledger, limits: Thresholds = Thresholds(),
                 window: Window | None = None, check_first: bool = False, cubed: bool = False
                 ) -> None:
    """New versions of all marts. Published, then checked; ``check_first`` audits the staged
    versions and publishes them only when no blocking check fails. With ``cubed`` silver is scanned
    for the BI cube only, and the marts' state is rolled up from that."""
    with ledger.step("gold.rebuild"):
        if cubed:
            cube.refresh(lake, window)
        staged = gold.rebuild(lake, areas, window, cube.state if cubed else None)
    tables = {name: lake.staged(location) for name, location in staged.items()}
    profile, found = _evaluated(checks.gold_profile(tables, lake.table("silver")))
    results = ledger.record(checks.gold(profile, limits))
    if check_first:
        try:
            checks.assert_gate(results)
        except checks.GateError:
            for location in staged.values():
                storage.delete(lake.spark, location)
            raise
    with ledger.step("gold.publish"):
        lake.promote(staged)
    figures = found[0].asDict()
    ledger.materialized(checks.GOLD, figures.pop("window"), figures["gold_trips"], **figures)
    checks.assert_gate(results)


def post(lake: Lake, areas: DataFrame, limits: Thresholds = Thresholds(),
         window: Window | None = None, check_first: bool = False,
         now: datetime | None = None, cubed: bool = False) -> DataFrame:
    """Gold rebuild, then maintenance; returns the maintenance summary."""
    ledger = Ledger(lake)
    rebuild_gold(lake, areas, ledger, limits, window, check_first, cubed)
    return maintenance(lake, ledger, now)


def maintenance(lake: Lake, ledger: Ledger, now: datetime | None = None) -> DataFrame:
    """Maintains every table and records what was done; failed tables are in the record."""
    with ledger.step("maintenance") as info:
        summary = maintain.run(lake, now)
        folded = ledger.fold()
        found = summary.collect()  # one row per table
        failed = {row["table_name"]: row["error"] for row in found if row["status"] == "failed"}
        info.update(tables=len(found), failed=len(failed), folded=sum(folded.values()))
    ledger.materialized("maintenance", "all", len(found), failed=len(failed), **{
        name: sum(row[name] for row in found) for name in ("rewritten", "added", "expired")},
        **{f"error {table}": error for table, error in failed.items()})
    return summary


def freshness(lake: Lake, ledger: Ledger, now: datetime, limits: Thresholds = Thresholds()
              ) -> DataFrame:
    """Checks every asset's age and records the result."""
    records = ledger.table("materializations")
    return ledger.record(run_ledgers.freshness(records, now, limits.stale_after_hours))


def failures(ledger: Ledger) -> DataFrame:
    """Every failed attempt so far, with the last success before it and the failures in a row."""
    return run_ledgers.failure_streaks(run_ledgers.attempts(
        ledger.table("check_results"), ledger.table("step_runs"), ledger.table("materializations")))


def alarms(ledger: Ledger) -> DataFrame:
    """What made runs fail so far."""
    return run_ledgers.alarms(ledger.table("check_results"), ledger.table("step_runs"))
