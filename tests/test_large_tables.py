"""What registered queries do so that no task or driver holds more as the tables grow."""

import json
import os
import re

from pyspark.sql import functions as F

from conftest import SF, plan
from faremill import lake as lake_module
from faremill.lake import Lake
from faremill.operators.windows import Window
from faremill.plans import bronze, silver
from faremill.registry import queries, served
from faremill.registry.workspace import TASK_BYTES, typed_trips, workspace
from faremill.session import small_scans
from faremill.sources import extract, feed, pages, raw_csv


def test_landed_pages_hold_a_range_only(tmp_path):
    """Counting reads parts that a border cuts, times only; a task holds its own range."""
    parts = []
    for k in range(4):
        path = tmp_path / "month=2023-10" / f"part-{k}.csv"
        path.parent.mkdir(exist_ok=True)
        times = [f"2023-10-{5 * k + i + 1:02d}T00:00:00.000" for i in range(6)]
        path.write_text("trip_id,trip_start_timestamp,fare\n" + "".join(
            f"{'' if i == 3 else f't{k}{i}'},{at},{i}\n" for i, at in enumerate(times)))
        parts.append([str(path), times[0], times[-1], 6])
    (tmp_path / served.INDEX).write_text(json.dumps(parts))
    os.remove(parts[3][0])  # whole inside or outside of the ranges below, so never opened
    source = served.LandedPages(str(tmp_path), ["trip_id", "trip_start_timestamp", "fare"])
    assert source.count(pages.Listing("2023-10-01T00:00:00", "2023-11-01T00:00:00")) == 24
    assert source.count(pages.Listing("2023-10-03T00:00:00", "2023-10-07T00:00:00")) == 5
    listing = pages.Listing("2023-10-03T00:00:00", "2023-10-07T00:00:00", limit=10)
    assert source.page(listing).read().decode().count("\n") == 1 + 4
    assert source._rows(listing.low, listing.high).num_rows == 5


def test_raw_text_comes_from_stored_trips(spark):
    """It holds the feed's rows with a start time, and landing them shuffles no row."""
    ws = workspace(spark, SF)
    fed = feed.as_text(feed.trips(spark, SF)).filter("trip_start_timestamp is not null")
    assert sorted(map(repr, ws.text().collect())) == sorted(map(repr, fed.collect()))
    assert "Exchange" not in plan(ws.text())
    assert sorted(map(repr, ws.bronze.collect())) == sorted(map(repr, typed_trips(spark, SF).select(
        *ws.bronze.columns).collect()))


def test_blocks_of_a_file_are_checked_across_their_borders(spark, monkeypatch):
    wanted = sorted(map(tuple, queries.REGISTRY["silver_layout"](spark, SF).collect()))
    monkeypatch.setattr(queries, "LAYOUT_ROWS", 2)
    assert sorted(map(tuple, queries.REGISTRY["silver_layout"](spark, SF).collect())) == wanted


def test_a_fragment_has_a_bounded_size(spark, monkeypatch):
    monkeypatch.setattr(queries, "FRAGMENT_BYTES", 64 << 10)
    tasks = []
    monkeypatch.setattr(Lake, "overwrite_months", lambda lake, df, *_, **__: tasks.append(
        df._jdf.queryExecution().optimizedPlan().toString()))
    queries._fragmented(spark, SF)
    assert int(re.search(r"Repartition (\d+)", tasks[0])[1]) > 5


def test_loading_tasks_sort_what_fits_and_compaction_makes_whole_files(spark, lake, monkeypatch):
    asked = []
    monkeypatch.setattr(lake_module, "task_bytes", lambda df, most: asked.append(most) or most)
    trips = typed_trips(spark, SF).limit(50)
    lake.overwrite_months(trips, "bronze")
    lake.overwrite_months(trips, "bronze", whole_files=True)
    lake.overwrite_months(trips, "bronze", shuffled=1 << 20)
    assert asked == [64 << 20, lake_module.FILE_BYTES * 4, 1 << 20]
    with small_scans(spark):
        assert int(spark.conf.get("spark.sql.files.maxPartitionBytes").removesuffix("b")) <= 8 << 20


def test_silver_of_middling_size_shuffles_hashes_only():
    assert silver.APART_BYTES <= 64 << 20 and TASK_BYTES <= 16 << 20


def test_landing_and_backfill_take_stored_trips_without_a_shuffle(spark, monkeypatch):
    land, seen = raw_csv.land, []

    def watched(source, *args, **how):
        seen.append(("Exchange" in plan(source), how))
        return land(source, *args, **how)

    monkeypatch.setattr(raw_csv, "land", watched)
    landed = queries.REGISTRY["land_month_csv"](spark, SF).drop("month")
    assert seen == [(False, {"gathered": True})]
    fed = feed.as_text(feed.trips(spark, SF)).filter("trip_start_timestamp is not null")
    assert sorted(map(repr, landed.collect())) == sorted(map(repr, fed.collect()))
    queries.REGISTRY["backfill_months"](spark, SF)
    assert all(how == {"gathered": True, "compression": "gzip"} for _, how in seen[1:])


def test_months_scanned_apart_share_no_task_and_load_the_same(spark, lake, raw_text, monkeypatch):
    window = Window.of("2023-09", "2023-12")
    raw = raw_text(*[{"trip_id": f"t{i}", "fare": "5.0", "company": 'A "B",\nC',
                      "trip_start_timestamp": f"2023-{9 + i % 3:02d}-{1 + i % 20:02d}T10:00:00.000"}
                     for i in range(60)])
    raw_csv.land(raw, lake.raw_root, window, page_rows=4, compression="gzip")
    apart = raw_csv.scan(spark, lake.raw_root, window, apart=True)
    assert sorted(map(repr, apart.collect())) == sorted(map(repr, raw_csv.scan(
        spark, lake.raw_root, window).collect()))
    tasks = apart.groupBy(F.spark_partition_id()).agg(F.count_distinct("month").alias("months"))
    assert {row.months for row in tasks.collect()} == {1}
    assert sorted(map(repr, extract.extract(spark, lake.raw_root, window).collect())) == sorted(
        map(repr, raw.collect()))
    loads, hints = [], []
    hint = type(apart).hint
    monkeypatch.setattr(type(apart), "hint", lambda df, *a: hints.append(a) or hint(df, *a))
    for least in (1 << 40, 0):
        monkeypatch.setattr(raw_csv, "APART_BYTES", least)
        loads.append((vars(bronze.load(lake, window)), sorted(map(repr, lake.table("bronze").collect())),
                      len(hints)))
    assert loads[0] == loads[1] and loads[0][2] == 1 and loads[0][0]["kept_rows"] == 60
