"""BI queries, each under an optional filter set.

``trips`` is the silver table, a cube, or the gold state for unfiltered queries. Cube and state hold
the same aggregates in exact partial sums, so a dashboard page needs no scan of the trips."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from faremill.functions.trip import area_label
from faremill.operators import summaries as S
from faremill.operators.filters import Filters
from faremill.plans import gold
from faremill.plans.cube import Cube

NO_FILTER = Filters()
Trips = DataFrame | Cube
# Rows of the ranked reports.
TOP_COMPANIES = 15
TOP_ROUTES = 20
TOP_AREAS = 20


def _is_state(trips: DataFrame) -> bool:
    return "mart" in trips.columns


def _trips_of(trips: Trips, mart: str) -> DataFrame:
    """Rows that hold the mart's key columns and stand for ``trips`` trips each."""
    if isinstance(trips, Cube):
        return trips.rows(["trip_date" if k == "day" else k for k in gold.MARTS[mart].keys])
    if _is_state(trips):
        return gold.state_of(trips, mart).withColumnRenamed("day", "trip_date")
    return trips.withColumn("trips", F.lit(1))


def _grouped(trips: Trips, mart: str, filters: Filters) -> DataFrame:
    if isinstance(trips, Cube):
        return trips.grouped(mart, filters)
    if not _is_state(trips):
        return gold.grouped(filters.apply(trips), mart)
    if filters.conditions():
        raise ValueError("the mart state answers unfiltered queries only")
    return gold.grouped_from_state(trips, mart)


def date_range(trips: Trips) -> DataFrame:
    return _trips_of(trips, "trips_daily").agg(F.min("trip_date").alias("date_min"),
                                               F.max("trip_date").alias("date_max"))


OPTION_MARTS = {"company": "trips_by_company", "payment_type": "payment_mix"}


def options(trips: Trips, column: str) -> DataFrame:
    """Sorted distinct non-null values of a filter column."""
    return (_trips_of(trips, OPTION_MARTS[column]).filter(F.col(column).isNotNull())
            .select(column).distinct().orderBy(column))


def area_options(trips: Trips, areas: DataFrame) -> DataFrame:
    """Named pickup areas, busiest first; unnamed ones are left out."""
    groups = (_trips_of(trips, "trips_by_pickup_area")
              .filter(F.col("pickup_community_area").isNotNull())
              .groupBy(F.col("pickup_community_area").alias("code"))
              .agg(F.sum("trips").alias("trips")))
    named = groups.join(areas, F.col("code") == F.col("area_no"), "inner")
    return S.busiest(named, ["code"]).select("code", F.col("area_name").alias("name"))


def summary(trips: Trips, filters: Filters = NO_FILTER) -> DataFrame:
    outputs = ["revenue", "avg_fare", "avg_tip_pct", "avg_miles"]
    measures = tuple(S.needed(outputs))
    days = F.countDistinct("trip_date").alias("days")
    if isinstance(trips, Cube):
        row = trips.rows(["trip_date"], filters).agg(*S.merged(measures), days)
    elif _is_state(trips) and not filters.conditions():
        row = _trips_of(trips, "trips_daily").agg(*S.merged(measures), days)
    else:
        row = filters.apply(trips).agg(*S.partial(measures), days)
    revenue, fare, tip, miles = [
        F.coalesce(S.final(name), F.lit(0.0)) for name in outputs]
    return row.select(F.coalesce("trips", F.lit(0).cast("bigint")).alias("total_trips"),
                      revenue.alias("total_revenue"), "days", fare.alias("avg_fare"),
                      tip.alias("avg_tip_pct"), miles.alias("avg_miles"))


def trips_daily(trips: Trips, filters: Filters = NO_FILTER) -> DataFrame:
    return _grouped(trips, "trips_daily", filters).orderBy("day")


def trips_by_hour(trips: Trips, filters: Filters = NO_FILTER) -> DataFrame:
    return (_grouped(trips, "trips_by_hour", filters).orderBy("dow_num", "trip_hour")
            .withColumnRenamed("trip_hour", "hour"))


def heatmap(trips: Trips, filters: Filters = NO_FILTER) -> DataFrame:
    return S.heatmap(trips_by_hour(trips, filters))


def trips_by_company(trips: Trips, filters: Filters = NO_FILTER) -> DataFrame:
    return S.busiest(_grouped(trips, "trips_by_company", filters), ["company"], TOP_COMPANIES)


def payment_mix(trips: Trips, filters: Filters = NO_FILTER) -> DataFrame:
    """Shares are of the filtered total."""
    groups = _grouped(trips, "payment_mix", filters)
    return S.busiest(S.with_share(groups), ["payment_type"])


def top_routes(trips: Trips, areas: DataFrame, filters: Filters = NO_FILTER) -> DataFrame:
    pickup, dropoff = gold.MARTS["top_routes"].keys
    top = S.busiest(_grouped(trips, "top_routes", filters), [pickup, dropoff], TOP_ROUTES)
    named = S.name_areas(S.name_areas(top, areas, pickup, "_pickup"), areas, dropoff, "_dropoff")
    return S.busiest(named, [pickup, dropoff]).select(
        area_label(F.col("_pickup"), F.col(pickup)).alias("pickup_area"),
        area_label(F.col("_dropoff"), F.col(dropoff)).alias("dropoff_area"),
        "trips", "avg_fare", "avg_miles")


def pickup_areas(trips: Trips, areas: DataFrame, filters: Filters = NO_FILTER) -> DataFrame:
    code = "pickup_community_area"
    top = S.busiest(_grouped(trips, "trips_by_pickup_area", filters), [code], TOP_AREAS)
    named = S.name_areas(top, areas, code, "_name", "_airport")
    return S.busiest(named, [code]).select(
        code, area_label(F.col("_name"), F.col(code)).alias("area_name"),
        F.coalesce("_airport", F.lit(False)).alias("is_airport"), "trips", "revenue", "avg_fare")
