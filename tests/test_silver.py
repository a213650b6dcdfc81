import random

import pytest
from pyspark.sql import functions as F

from conftest import at, plan, rows
from faremill import storage
from faremill.operators.windows import Window
from faremill.plans import silver
from faremill.schema import MONTH, SILVER_COLUMNS
from faremill.sources import feed
from faremill.registry.workspace import typed_trips
from conftest import SF


def test_dedupe_keeps_first_per_month(trips):
    df = trips(
        {"trip_id": "a", "trip_start_timestamp": "2023-10-03T00:00:00", "fare": 3.0},
        {"trip_id": "a", "trip_start_timestamp": "2023-10-01T00:00:00", "fare": None},
        {"trip_id": "a", "trip_start_timestamp": "2023-10-01T00:00:00", "fare": 2.0},
        {"trip_id": "a", "trip_start_timestamp": "2023-11-01T00:00:00", "fare": 9.0},
        {"trip_id": None, "trip_start_timestamp": "2023-10-01T00:00:00"},
        {"trip_id": "b", "trip_start_timestamp": None})
    built = silver.build(df)
    assert rows(built, "trip_id", "trip_start_timestamp", "fare") == [
        ("a", at("2023-10-01"), 2.0), ("a", at("2023-11-01"), 9.0)]
    assert rows(silver.cross_month_repeats(built)) == [("a", 2)]


def test_hot_key_collapses_before_the_shuffle(spark, trips):
    """A third of all rows share one id: the plan limits each task to one row per id first."""
    rng = random.Random(1)
    records = [{"trip_id": "hot" if i % 3 == 0 else f"t{rng.randrange(4000)}",
                "trip_start_timestamp": f"2023-10-{rng.randrange(1, 29):02d}T00:00:00",
                "fare": float(rng.randrange(100))} for i in range(6000)]
    df = trips(*records)
    found = rows(silver.dedupe(df), "trip_id", "trip_start_timestamp", "fare")
    best = {}
    for r in records:
        key = (at(r["trip_start_timestamp"]), r["fare"])
        best[r["trip_id"]] = min(best.get(r["trip_id"], key), key)
    assert found == sorted((k, *v) for k, v in best.items())
    text = plan(silver.dedupe(df))
    assert "Partial" in text and text.count("WindowGroupLimit") == 2
    assert text.count("Exchange") == 1


@pytest.mark.parametrize("partitions", ["1", "9"])
def test_result_does_not_depend_on_partitioning(spark, partitions):
    trips = typed_trips(spark, SF)
    want = rows(silver.build(trips).select(F.xxhash64(*SILVER_COLUMNS)))
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = rows(silver.build(trips.repartition(int(partitions))).select(
            F.xxhash64(*SILVER_COLUMNS)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got == want


def test_session_zone_does_not_matter(spark):
    trips = feed.trips(spark, SF).filter("trip_start_timestamp is not null")
    columns = ["trip_id", "trip_date", "trip_hour", "dow_num", "day_name"]
    want = silver.time_fields(trips).select(F.xxhash64(*columns)).agg(F.sum(
        F.col("xxhash64(" + ", ".join(columns) + ")").cast("decimal(38,0)"))).first()[0]
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        got = silver.time_fields(trips).select(F.xxhash64(*columns)).agg(F.sum(
            F.col("xxhash64(" + ", ".join(columns) + ")").cast("decimal(38,0)"))).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == want


def test_derived_fields(trips):
    df = silver.build(trips({
        "trip_id": "a", "trip_start_timestamp": "2023-10-01T13:45:00", "trip_seconds": 1800,
        "trip_miles": 10.0, "fare": 20.0, "tips": 5.0, "pickup_community_area": 76},
        {"trip_id": "b", "trip_start_timestamp": "2023-10-07T00:00:00", "trip_seconds": -1,
         "trip_miles": -1.0, "fare": 0.0, "tips": 5.0, "pickup_community_area": 1,
         "dropoff_community_area": 2}))
    assert df.columns == [*SILVER_COLUMNS, MONTH]
    first, second = df.orderBy("trip_id").collect()
    assert (first["trip_date"].isoformat(), first["trip_hour"], first["dow_num"],
            first["day_name"]) == ("2023-10-01", 13, 1, "Sun")
    assert (first["duration_min"], first["speed_mph"], first["tip_pct"],
            first["is_airport"]) == (30.0, 20.0, 0.25, True)
    assert (second["dow_num"], second["day_name"]) == (7, "Sat")
    assert [second[c] for c in ("trip_seconds", "trip_miles", "duration_min", "speed_mph",
                                "tip_pct")] == [None] * 5
    assert second["is_airport"] is False


def test_load_reads_only_its_months_and_sorts_files(lake, trips):
    lake.overwrite_months(trips(*[
        {"trip_id": f"t{i}", "trip_start_timestamp": f"2023-{10 + i % 2}-{i % 28 + 1:02d}T00:00:00"}
        for i in range(60)]), "bronze")
    window = Window.of("2023-10")
    source = lake.read("bronze", window)
    text = plan(source)
    assert "PartitionFilters: [isnotnull(trip_month" in text and "2023-10" in text
    silver.load(lake, window)
    assert [r[MONTH] for r in lake.month_counts("silver").collect()] == ["2023-10"]
    stored = lake.table("silver").select(
        F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("i"),
        "trip_start_timestamp").orderBy("f", "i").collect()
    for before, after in zip(stored, stored[1:]):
        assert before["f"] != after["f"] or before[2] <= after[2]


def test_month_counts_read_no_column(lake, trips):
    lake.overwrite_months(trips({"trip_id": "a", "trip_start_timestamp": "2023-10-01T00:00:00"}),
                          "bronze")
    assert "ReadSchema: struct<>" in plan(lake.month_counts("bronze"))


def test_only_repeated_keys_are_shuffled_whole(lake, trips):
    """Months deduplicated apart hold what ``build`` gives, whatever the hashes are joined by."""
    draw = random.Random(5)
    lake.overwrite_months(trips(*[
        {"trip_id": draw.choice([None, "hot", f"t{draw.randint(0, 40)}", f"u{i}"]),
         "trip_start_timestamp": f"2023-{10 + i % 2}-{i % 28 + 1:02d}T00:00:00",
         "trip_seconds": draw.choice([None, -1, 60]), "fare": draw.choice([None, 1.0, 2.0])}
        for i in range(400)]), "bronze")
    def keyed(table):
        return sorted(map(repr, table.select(*SILVER_COLUMNS, MONTH).collect()))

    window = Window.of("2023-10", "2023-12")
    wanted = keyed(silver.build(lake.table("bronze")))
    for most in (silver.MOST_BROADCAST, -1):
        silver.MOST_BROADCAST, before = most, silver.MOST_BROADCAST
        try:
            silver.load(lake, window, apart=-1)
        finally:
            silver.MOST_BROADCAST = before
        assert keyed(lake.table("silver")) == wanted
    assert not storage.children(lake.spark, f"{lake.root}/scratch")
