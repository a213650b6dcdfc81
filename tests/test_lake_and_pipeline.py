import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import SF, counts, rows
from faremill import lake as lake_module
from faremill import storage
from faremill.lake import Lake
from faremill.operators.windows import Window
from faremill.plans import adhoc, gold, ledger, maintain, pipeline, silver
from faremill.plans.checks import GateError
from faremill.plans.ledger import Ledger
from faremill.registry.workspace import typed_trips
from faremill.sources import feed

NOW = datetime(2024, 1, 31)


def trip(i, start, **more):
    return {"trip_id": f"t{i}", "trip_start_timestamp": start, "trip_total": 2.5,
            "pickup_community_area": 1, "dropoff_community_area": 2, **more}


def test_overwrite_replaces_only_the_months_it_holds(lake, trips):
    lake.overwrite_months(trips(trip(1, "2023-10-01T00:00:00"), trip(2, "2023-11-01T00:00:00")),
                          "bronze")
    for _ in range(2):
        lake.overwrite_months(trips(trip(3, "2023-11-02T00:00:00"), trip(4, "2023-11-03T00:00:00")),
                              "bronze")
        assert counts(lake.table("bronze")) == {"2023-10": 1, "2023-11": 2}
    lake.spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:  # the table option decides, not the session
        lake.overwrite_months(trips(trip(5, "2023-12-02T00:00:00")), "bronze")
    finally:
        lake.spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    assert counts(lake.table("bronze")) == {"2023-10": 1, "2023-11": 2, "2023-12": 1}


def test_tables_are_found_again_by_another_catalog(lake, trips):
    lake.overwrite_months(trips(trip(1, "2023-10-01T00:00:00")), "bronze")
    silver.load(lake, Window.of("2023-10"))
    lake.publish(gold.trips_daily(lake.table("silver")), "trips_daily")
    again = Lake(lake.spark, lake.root, lake.prefix + "again_").create()
    for layer, table in (("bronze", "taxi_trips"), ("silver", "taxi_trips"),
                         ("gold", "trips_daily")):
        assert again.table(layer, table).collect() == lake.table(layer, table).collect()


def test_publish_swaps_versions_and_schema(lake, spark):
    lake.publish(spark.sql("select 1 as a"), "m")
    before = lake.table("gold", "m")
    assert rows(before) == [(1,)]
    lake.publish(spark.sql("select 2 as a"), "m")
    assert rows(lake.table("gold", "m")) == [(2,)]
    lake.publish(spark.sql("select 3 as a, 'x' as b"), "m")
    assert rows(lake.table("gold", "m")) == [(3, "x")]
    assert lake.versions().count() == 3
    assert lake.current_location("m").startswith(f"{lake.root}/gold/m/version=")


def test_compaction_keeps_rows_and_other_months(lake, spark, trips):
    many = [trip(i, f"2023-10-{i % 28 + 1:02d}T00:00:00") for i in range(200)]
    lake.overwrite_months(silver.build(trips(*many)).repartition(12), "silver", cluster=())
    lake.overwrite_months(silver.build(trips(trip(900, "2023-11-01T00:00:00"))), "silver")
    before = rows(lake.table("silver"), "trip_id", "trip_start_timestamp", "trip_total")

    def files(month):
        stats = maintain.file_stats(lake, lake.location("silver"))
        return stats.filter(stats.trip_month == month).first()["files"]

    november = [r.f for r in lake.table("silver").filter("trip_month = '2023-11'").selectExpr(
        "_metadata.file_path as f").collect()]
    assert files("2023-10") == 12
    assert maintain.compact_months(lake, "silver") == (12, files("2023-10"))
    assert files("2023-10") <= 2
    assert rows(lake.table("silver"), "trip_id", "trip_start_timestamp", "trip_total") == before
    assert [r.f for r in lake.table("silver").filter("trip_month = '2023-11'").selectExpr(
        "_metadata.file_path as f").collect()] == november
    assert maintain.compact_months(lake, "silver") == (0, 0)


def test_large_months_are_compacted_by_day(lake, trips, monkeypatch):
    monkeypatch.setattr(lake_module, "FILE_BYTES", 1)
    many = [trip(i, f"2023-10-{i % 28 + 1:02d}T00:00:00") for i in range(200)]
    lake.overwrite_months(silver.build(trips(*many)).repartition(12), "silver", cluster=())
    maintain.compact_months(lake, "silver")
    by_file = lake.table("silver").selectExpr("_metadata.file_path as f", "trip_date").distinct()
    spread = by_file.groupBy("f").count().agg({"count": "max"}).first()[0]
    assert spread <= 28 / 4 + 7 and lake.table("silver").count() == 200


def test_a_few_small_files_beside_good_ones_are_left_alone(spark):
    stats = spark.createDataFrame([("a", 100, 99 * 128 << 20, 5), ("b", 6, 6 << 20, 6)],
                                  "trip_month string, files bigint, bytes bigint, small_files int")
    assert rows(maintain.needs_compaction(stats), "trip_month") == [("b",)]


def test_retention_against_brute_force(spark):
    rng = random.Random(3)
    versions = [("hot" if i % 3 == 0 else f"t{i % 7}", i, NOW - timedelta(days=rng.randrange(30)))
                for i in range(400)] + [("few", i, NOW - timedelta(days=90)) for i in range(4)]
    df = spark.createDataFrame(versions,
                               "table_name string, version_id bigint, committed_at timestamp_ntz")
    want = []
    for table in {v[0] for v in versions}:
        newest = sorted((v for v in versions if v[0] == table), key=lambda v: (v[2], v[1]))[::-1]
        want += [v for v in newest[5:] if v[2] < NOW - timedelta(days=7)]
    assert rows(maintain.retention_plan(df, NOW)) == sorted(want)


def test_maintenance_expires_versions_and_isolates_errors(lake, spark, trips, monkeypatch):
    for i in range(7):
        lake.publish(spark.sql(f"select {i} as a"), "trips_daily")
    lake.overwrite_months(trips(trip(1, "2023-10-01T00:00:00")), "bronze")

    def broken(lake, layer, *args):
        raise RuntimeError(f"no {layer}")

    monkeypatch.setattr(maintain, "compact_months", broken)
    later = datetime(2100, 1, 1)
    summary = {r["table_name"]: r for r in maintain.run(lake, later).collect()}
    assert summary["bronze.taxi_trips"]["status"] == "failed"
    assert summary["bronze.taxi_trips"]["error"] == "no bronze"
    assert summary["gold.trips_by_hour"]["status"] == "skipped"
    assert (summary["gold.trips_daily"]["status"], summary["gold.trips_daily"]["expired"]) == (
        "maintained", 2)
    assert rows(lake.table("gold", "trips_daily")) == [(6,)]
    kept = [r["location"] for r in lake.versions().collect()
            if storage.exists(spark, r["location"])]
    assert len(kept) == 5
    assert maintain.expire_versions(lake, "trips_daily", later) == 0


def test_pipeline_end_to_end_is_idempotent(lake, spark):
    source = feed.as_text(feed.trips(spark, SF)).filter(
        "trip_start_timestamp between '1996-01' and '1996-05'")
    windows = Window.of("1996-01", "1996-05").split()
    pipeline.backfill(lake, windows, source)
    want = rows(silver.build(typed_trips(spark, SF).filter(
        "trip_month between '1996-01' and '1996-04'")), "trip_id", "trip_start_timestamp", "fare")
    assert rows(lake.table("silver"), "trip_id", "trip_start_timestamp", "fare") == want
    pipeline.backfill(lake, windows[-2:], source, by_month=True)
    assert rows(lake.table("silver"), "trip_id", "trip_start_timestamp", "fare") == want
    areas = feed.areas(spark, SF)
    summary = pipeline.post(lake, areas)
    assert {r["status"] for r in summary.collect()} == {"maintained"}
    for name in gold.MARTS:
        assert lake.table("gold", name).collect() == gold.mart(
            lake.table("silver"), name, areas).collect()
    records = {r["asset"]: r["metadata"] for r in ledger.latest(
        Ledger(lake).table("materializations")).collect()}
    assert records["gold/taxi_marts"]["silver_trips"] == str(len(want))
    assert records["gold/taxi_marts"]["rows_trips_daily"] == str(
        lake.table("gold", "trips_daily").count())
    assert records["silver/taxi_trips"]["max_speed_mph"] != "0.0"
    assert Ledger(lake).table("step_runs").filter("status <> 'DONE'").count() == 0
    pipeline.post(lake, areas, window=windows[-1], check_first=True)
    assert lake.table("gold", "trips_daily").agg({"trips": "sum"}).first()[0] == len(want)


def test_gate_stops_before_the_next_layer(lake, raw_text):
    window = Window.of("2023-10")
    with pytest.raises(GateError, match="raw/taxi_trips"):
        pipeline.ingest(lake, window, raw_text())
    assert lake.table("bronze").count() == 0
    negative = raw_text({"trip_id": "a", "trip_start_timestamp": "2023-10-01T00:00:00",
                         "fare": "-1", "trip_total": "-1"})
    with pytest.raises(GateError, match="fare_non_negative"):
        pipeline.ingest(lake, window, negative)


def test_every_month_of_a_wide_run_is_gated(lake, raw_text):
    source = raw_text({"trip_id": "a", "trip_start_timestamp": "2023-10-01T00:00:00"})
    with pytest.raises(GateError, match="raw/taxi_trips 2023-11: rows_landed_positive"):
        pipeline.backfill(lake, Window.of("2023-10", "2023-12").split(), source)


def test_backfill_touches_the_given_months_only_and_gates_each(lake, raw_text):
    def rows_of(*months):
        return raw_text(*[{"trip_id": f"t{m}", "trip_start_timestamp": f"2023-{m:02d}-05T00:00:00",
                           "fare": "-1" if m == 8 else "1", "trip_total": "1"} for m in months])

    year = Window.of("2023-01", "2024-01").split()
    pipeline.backfill(lake, year[:5], rows_of(*range(1, 13)))
    pipeline.backfill(lake, [year[0], year[4]], rows_of(1, 5))  # months between stay
    assert len(rows(lake.table("silver"), "trip_id")) == 5
    with pytest.raises(GateError, match="fare_non_negative") as failed:
        pipeline.backfill(lake, year[5:9], rows_of(6, 8, 9))
    assert failed.value.windows == {"2023-07", "2023-08"}
    assert "raw/taxi_trips 2023-07: rows_landed_positive" in str(failed.value)
    assert lake.stored_months("silver") >= {"2023-06", "2023-09"}


def test_a_month_without_raw_files_is_blocked(lake, spark, raw_text):
    window = Window.of("2023-10")
    source = raw_text({"trip_id": "a", "trip_start_timestamp": "2023-10-01T00:00:00"})
    pipeline.ingest(lake, window, source)
    storage.delete(spark, f"{lake.raw_root}/month=2023-10")
    with pytest.raises(GateError, match="bronze/taxi_trips 2023-10: row_count_positive"):
        pipeline.load_bronze(lake, window, Ledger(lake))


def test_every_failure_is_named(spark):
    from faremill.plans import checks
    profile = spark.createDataFrame([(f"{m:04d}", 0) for m in range(60)], "window string, rows bigint")
    with pytest.raises(GateError) as failed:
        checks.assert_gate(checks.raw(profile))
    assert len(failed.value.windows) == 60 and str(failed.value).count("rows_landed_positive") == 60


def test_state_of_lost_months_is_dropped_and_stray_versions_expire(lake, spark, trips):
    areas = feed.areas(spark, SF)
    lake.overwrite_months(trips(trip(1, "2023-10-01T00:00:00"), trip(2, "2023-11-01T00:00:00")),
                          "bronze")
    silver.load(lake, Window.of("2023-10", "2023-12"))
    pipeline.post(lake, areas)
    lake.drop_month("silver", "2023-10")
    pipeline.rebuild_gold(lake, areas, Ledger(lake), window=Window.of("2023-11"))
    assert lake.table("gold", "trips_daily").agg({"trips": "sum"}).first()[0] == 1
    stray = lake.stage(lake.table("gold", "trips_daily"), "trips_daily")
    assert maintain.expire_versions(lake, "trips_daily") == 0 and storage.exists(spark, stray)
    assert maintain.expire_versions(lake, "trips_daily", datetime(2100, 1, 1)) == 1
    assert not storage.exists(spark, stray) and lake.table("gold", "trips_daily").count() == 1
    assert ledger.latest(Ledger(lake).table("materializations")).filter(
        "asset = 'maintenance'").first()["metadata"]["failed"] == "0"


def test_payment_shares_scan_the_trips_once(lake, trips):
    from faremill.plans import bi
    lake.overwrite_months(trips(trip(1, "2023-10-01T00:00:00"), trip(2, "2023-10-02T00:00:00")), "bronze")
    silver.load(lake, Window.of("2023-10"))
    for shares in (bi.payment_mix(lake.table("silver")), gold.payment_mix(lake.table("silver"))):
        text = shares._jdf.queryExecution().optimizedPlan().toString()
        assert text.count("Relation ") == 1 and shares.first()["pct_of_trips"] == 1.0


def test_semicolons_in_quotes_and_comments():
    assert adhoc.statements("select ';' as x; -- a; b\nselect \"a;b\" /* ; */ from t;; -- end") == [
        "select ';' as x", "-- a; b\nselect \"a;b\" /* ; */ from t"]


def test_check_first_keeps_bad_marts_unpublished(lake, spark, trips):
    areas = feed.areas(spark, SF)
    lake.overwrite_months(trips(trip(1, "2023-10-01T00:00:00")), "bronze")
    silver.load(lake, Window.of("2023-10"))
    pipeline.post(lake, areas, check_first=True)
    lake.overwrite_months(trips(trip(1, "2023-10-01T00:00:00", trip_total=-5.0)), "bronze")
    silver.load(lake, Window.of("2023-10"))
    with pytest.raises(GateError, match="revenue_non_negative"):
        pipeline.post(lake, areas, check_first=True)
    assert lake.table("gold", "trips_daily").first()["revenue"] == 2.5
    with pytest.raises(GateError):
        pipeline.post(lake, areas)
    assert lake.table("gold", "trips_daily").first()["revenue"] == -5.0


def test_adhoc_scripts(lake, spark, trips):
    lake.overwrite_months(trips(trip(1, "2023-10-01T00:00:00")), "bronze")
    results = adhoc.run_script(spark, f"""
        SELECT count(*) AS n FROM {lake.name('bronze')};
        SELECT trip_id FROM {lake.name('bronze')} WHERE trip_total > :least; ;""", {"least": 1})
    assert [rows(r) for r in results] == [[(1,)], [("t1",)]]
    adhoc.show_script(spark, "SELECT 1 AS one")


def test_working_folder_follows_the_session(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    folder = storage.working_folder(spark, "x")
    assert folder != storage.working_folder(spark, "x")
    if shared:
        assert folder.startswith(shared)




def test_jobs_from_the_command_line(spark, raw_text, tmp_path, capsys):
    from faremill.__main__ import main
    from faremill.sources import raw_csv

    pages, root = str(tmp_path / "pages"), str(tmp_path / "lake")
    raw_csv.land(raw_text(*[
        {"trip_id": f"t{m}{i}", "trip_start_timestamp": f"2023-{m}-0{i}T00:00:00", "fare": "2",
         "trip_total": "3", "pickup_community_area": "1", "dropoff_community_area": "2"}
        for m in (10, 11) for i in range(1, 9)]), pages, Window.of("2023-10", "2023-12"))
    areas = tmp_path / "areas.csv"
    areas.write_text("community_area,area_name,is_airport\n1,Centre,0\n")
    try:
        for job in ("extract --source " + pages, "bronze", "silver"):
            main([*job.split(), "--root", root, "--start", "2023-10"])
        assert spark.table("silver.taxi_trips").count() == 8
        main(["backfill", "--root", root, "--start", "2023-10", "--end", "2023-12",
              "--source", pages])
        main(["lookback", "--root", root, "--start", "2023-10", "--end", "2023-12"])
        main(["post", "--root", root, "--areas", str(areas)])
        for job in ("freshness", "alarms", "maintenance"):
            main([job, "--root", root])
        main(["bi", "summary", "--root", root, "--start", "2023-10-02", "--day-type", "weekday"])
        main(["bi", "top-routes", "--root", root, "--areas", str(areas)])
        main(["gold", "--root", root, "--areas", str(areas), "--changed", "2023-11"])
        script = tmp_path / "q.sql"
        script.write_text("select sum(trips) as n from gold.trips_daily; "
                          "select area_name, is_airport from areas")
        main(["sql", "--root", root, "--areas", str(areas), "--file", str(script)])
        shown = capsys.readouterr().out
        assert "|16 |" in shown and "|Centre   |false     |" in shown and "maintained" in shown
    finally:
        for layer in ("bronze", "silver", "gold"):
            spark.sql(f"DROP DATABASE IF EXISTS {layer} CASCADE")


def test_hot_month_is_split_over_tasks(lake, trips, monkeypatch):
    """A third and more of the rows in one month: AQE cuts that month into many writes."""
    many = [trip(i, f"2023-10-{i % 28 + 1:02d}T00:00:00", company=f"company {i * 7919 % 10007}")
            for i in range(20000)]
    few = [trip(20000 + i, f"2023-{i % 9 + 1:02d}-01T00:00:00") for i in range(9)]
    monkeypatch.setattr(lake_module, "FILE_BYTES", 16 << 10)
    lake.overwrite_months(trips(*many, *few).repartition(16), "bronze",
                          order=("trip_start_timestamp",))
    files = {r["trip_month"]: r["files"] for r in maintain.file_stats(
        lake, lake.location("bronze")).collect()}
    assert files["2023-10"] >= 3 and all(files[f"2023-0{m}"] == 1 for m in range(1, 10))
    assert lake.table("bronze").count() == 20009


def test_shuffle_partitions_follow_the_stored_bytes(spark):
    from faremill.session import shuffle_partitions, sized_shuffles

    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    assert shuffle_partitions(0) == 8 and shuffle_partitions(1 << 40) == 4096
    with sized_shuffles(spark, 0):
        assert spark.conf.get(key) == (before if int(before) >= 8 else "8")
    with pytest.raises(ValueError):
        with sized_shuffles(spark, 1 << 40):
            assert spark.conf.get(key) == "16384"
            raise ValueError
    assert spark.conf.get(key) == before


def test_small_writes_use_the_cores_and_large_ones_the_file_size(spark, lake, trips):
    from faremill import session

    most = lake_module.FILE_BYTES * session.SHUFFLED_PER_STORED
    sized = spark.read.parquet(f"{SF}/lineitem.parquet")
    known = session.estimated_bytes(sized)
    assert 0 < known < 1 << 24 and session.task_bytes(sized, most) == 4 << 20
    both = sized.alias("a").join(sized.alias("b"), "l_orderkey")
    assert session.estimated_bytes(both) == 2 * known  # not their product
    assert session.task_bytes(sized, most, least=1) == known // spark.sparkContext.defaultParallelism
    assert session.task_bytes(sized, 1000) == 1000
    unknown = spark.range(1).withColumn("x", F.lit(1)).crossJoin(spark.range(1 << 60))
    assert session.task_bytes(unknown, most) == most
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    lake.overwrite_months(trips(trip(1, "2023-10-01T00:00:00")), "bronze")
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == before
