"""Table schemas of every layer."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names, order and types of the trip tables.
TRIP_FIELDS = [
    ("trip_id", "string"),
    ("taxi_id", "string"),
    ("trip_start_timestamp", "timestamp_ntz"),
    ("trip_end_timestamp", "timestamp_ntz"),
    ("trip_seconds", "int"),
    ("trip_miles", "double"),
    ("pickup_community_area", "int"),
    ("dropoff_community_area", "int"),
    ("fare", "double"),
    ("tips", "double"),
    ("tolls", "double"),
    ("extras", "double"),
    ("trip_total", "double"),
    ("payment_type", "string"),
    ("company", "string"),
    ("pickup_centroid_latitude", "double"),
    ("pickup_centroid_longitude", "double"),
    ("dropoff_centroid_latitude", "double"),
    ("dropoff_centroid_longitude", "double"),
]
MONTH = "trip_month"  # partition column of both trip tables, "yyyy-MM"


def _ddl(fields) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in fields)


TRIP_COLUMNS = [name for name, _ in TRIP_FIELDS]
TRIP_TYPES = dict(TRIP_FIELDS)
# Columns of silver, in order.
SILVER_FIELDS = [
    ("trip_id", "string"),
    ("taxi_id", "string"),
    ("trip_start_timestamp", "timestamp_ntz"),
    ("trip_end_timestamp", "timestamp_ntz"),
    ("trip_date", "date"),
    ("trip_hour", "int"),
    ("dow_num", "int"),
    ("day_name", "string"),
    ("trip_seconds", "int"),
    ("duration_min", "double"),
    ("trip_miles", "double"),
    ("speed_mph", "double"),
    ("pickup_community_area", "int"),
    ("dropoff_community_area", "int"),
    ("fare", "double"),
    ("tips", "double"),
    ("tolls", "double"),
    ("extras", "double"),
    ("trip_total", "double"),
    ("tip_pct", "double"),
    ("payment_type", "string"),
    ("company", "string"),
    ("pickup_centroid_latitude", "double"),
    ("pickup_centroid_longitude", "double"),
    ("dropoff_centroid_latitude", "double"),
    ("dropoff_centroid_longitude", "double"),
    ("is_airport", "boolean"),
]
SILVER_COLUMNS = [name for name, _ in SILVER_FIELDS]

RAW = T.StructType([T.StructField(name, T.StringType()) for name in TRIP_COLUMNS])
BRONZE_DDL = _ddl([*TRIP_FIELDS, (MONTH, "string")])
SILVER_DDL = _ddl([*SILVER_FIELDS, (MONTH, "string")])
