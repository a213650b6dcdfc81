"""A trip feed with the bronze columns, derived from the TPC-H-like test tables.

It carries what real trips carry: null and repeated ids, null and negative measurements, zero
fares, unnamed areas, and 83 months of start times."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from faremill.schema import TRIP_COLUMNS, TRIP_TYPES


STARTS = "l_partkey % 997 != 0 and start_at is not null"  # lines whose trip has a start time
_USED = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
         "l_discount", "l_tax", "l_returnflag", "p_brand", "start_at"]


def lines(spark: SparkSession, folder: str) -> DataFrame:
    """The columns that trips are made of."""
    items = spark.read.parquet(f"{folder}/lineitem.parquet")
    parts = spark.read.parquet(f"{folder}/part.parquet").select("p_partkey", "p_brand")
    return items.join(parts, F.col("l_partkey") == F.col("p_partkey")).selectExpr(
        "*",
        "l_shipdate + make_dt_interval(0, cast(l_partkey % 24 as int),"
        " cast(l_suppkey % 4 as int) * 15, 0) as start_at").select(*_USED)


def trips(spark: SparkSession, folder: str) -> DataFrame:
    return from_lines(lines(spark, folder))


def from_lines(lines: DataFrame) -> DataFrame:
    base = lines.selectExpr(
        "*",
        "cast(case when l_partkey % 97 = 0 then -1 when l_partkey % 89 = 0 then null"
        " else l_quantity * 37 * (l_linenumber - 1) end as int) as seconds",
        "cast(case when (l_partkey + l_suppkey) % 11 = 0 then null"
        " else (l_partkey * 7 + l_suppkey * 13 + l_linenumber) % 77 + 1 end as int) as pickup",
        "cast(case when l_partkey % 13 = 0 then null"
        " else (l_partkey * 5 + l_orderkey) % 77 + 1 end as int) as dropoff",
        "case when l_partkey % 103 = 0 then cast(0 as double)"
        " else floor(l_extendedprice / 100) / cast(10 as double) end as base_fare",
        "case when l_partkey % 107 = 0 then null"
        " else floor(l_extendedprice * l_discount / 100) / cast(10 as double) end as tip",
        "case when l_linenumber = 7 then cast(2.5 as double) else cast(0 as double) end as toll",
        "round(l_tax * 100) / cast(2 as double) as extra")
    return base.selectExpr(
        "case when l_partkey % 991 = 0 then null else concat(cast(l_orderkey as string), '-',"
        " cast(l_linenumber as string)) end as trip_id",
        "concat('taxi-', cast(l_suppkey as string)) as taxi_id",
        "case when l_partkey % 997 = 0 then null else start_at end as trip_start_timestamp",
        "case when l_partkey % 997 = 0 or seconds < 0 then null"
        " else timestampadd(SECOND, seconds, start_at) end as trip_end_timestamp",
        "seconds as trip_seconds",
        "case when l_partkey % 101 = 0 then cast(-1 as double)"
        " else cast(l_quantity as double) / cast(4 as double) end as trip_miles",
        "pickup as pickup_community_area",
        "dropoff as dropoff_community_area",
        "base_fare as fare",
        "tip as tips",
        "toll as tolls",
        "extra as extras",
        "base_fare + coalesce(tip, cast(0 as double)) + toll + extra as trip_total",
        "case l_returnflag when 'A' then 'Cash' when 'R' then 'Credit Card' end as payment_type",
        "case when p_brand = 'Brand#1' then null else p_brand end as company",
        "cast(416000 + pickup * 50 as double) / cast(10000 as double) as pickup_centroid_latitude",
        "cast(-876000 - pickup * 50 as double) / cast(10000 as double)"
        " as pickup_centroid_longitude",
        "cast(416000 + dropoff * 50 as double) / cast(10000 as double)"
        " as dropoff_centroid_latitude",
        "cast(-876000 - dropoff * 50 as double) / cast(10000 as double)"
        " as dropoff_centroid_longitude")


def as_text(typed: DataFrame) -> DataFrame:
    """The same rows as raw CSV text: timestamps as yyyy-MM-ddTHH:mm:ss.SSS."""
    return typed.select(*[
        (F.concat(F.replace(F.col(name).cast("string"), F.lit(" "), F.lit("T")), F.lit(".000"))
         if TRIP_TYPES[name] == "timestamp_ntz" else F.col(name).cast("string")).alias(name)
        for name in TRIP_COLUMNS])


def areas(spark: SparkSession, folder: str) -> DataFrame:
    """25 of the 77 area codes get a name; both airports are among them."""
    return spark.read.parquet(f"{folder}/nation.parquet").selectExpr(
        "cast(76 - 2 * n_nationkey as int) as area_no", "n_name as area_name",
        "76 - 2 * n_nationkey in (56, 76) as area_airport")
