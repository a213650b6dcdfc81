"""Scalar rules of the trip model."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, functions as F

AIRPORT_AREAS = (76, 56)  # fixed values: area codes of the two airports
WEEKEND = (1, 7)          # fixed values: Sunday and Saturday as dayofweek() numbers


def moment(at: datetime) -> Column:
    """A TIMESTAMP_NTZ literal. ``lit(datetime)`` would pass through the session time zone."""
    return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")


def seconds_between(first: Column, last: Column) -> Column:
    """Whole seconds from one TIMESTAMP_NTZ to another, without a time zone."""
    gap = last - first
    parts = [F.extract(F.lit(unit), gap) * size
             for unit, size in (("DAY", 86400), ("HOUR", 3600), ("MINUTE", 60), ("SECOND", 1))]
    return F.floor(parts[0] + parts[1] + parts[2] + parts[3])


def month_label(ts: Column) -> Column:
    """"yyyy-MM" of a date or timestamp, without a time-zone dependent formatter."""
    return F.substring(ts.cast("date").cast("string"), 1, 7)


def non_negative(value: Column) -> Column:
    return F.when(value < 0, None).otherwise(value)


def duration_min(seconds: Column) -> Column:
    return F.round(seconds / F.lit(60.0), 2)


def speed_mph(miles: Column, seconds: Column) -> Column:
    return F.when(seconds > 0, F.round(miles / (seconds / F.lit(3600.0)), 2))


def tip_fraction(tips: Column, fare: Column) -> Column:
    return F.when(fare > 0, F.round(tips / fare, 4))


def touches_airport(pickup: Column, dropoff: Column) -> Column:
    """Three-valued: NULL when no known end is an airport and one end is unknown."""
    return pickup.isin(*AIRPORT_AREAS) | dropoff.isin(*AIRPORT_AREAS)


def or_unknown(value: Column) -> Column:
    return F.coalesce(value, F.lit("Unknown"))


def area_label(name: Column, code: Column) -> Column:
    """Area name, or "Area N" for an unnamed one."""
    return F.coalesce(F.nullif(name, F.lit("")), F.concat(F.lit("Area "), code.cast("string")))


def relative_gap(expected: Column, actual: Column) -> Column:
    """|expected - actual| / |expected|; nothing expected: 0 if nothing came, else 1."""
    return (F.when(expected != 0, F.abs(expected - actual) / F.abs(expected))
            .when(actual == 0, F.lit(0.0)).otherwise(F.lit(1.0)))
