"""Gold: six marts over all silver trips.

A rebuild scans silver once. ``state`` computes mergeable aggregates for every mart and month in
one grouping-sets pass (map-side combined, so hot keys collapse before the shuffle); the marts
are then rolled up from that small table. Since the state is kept per month, a rebuild can also
be limited to the months that changed."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from faremill.functions.fixed_point import UNITS_TYPE, amount, sum_units
from faremill.functions.trip import or_unknown
from faremill.lake import STATE, Lake
from faremill.operators import summaries as S
from faremill.operators.windows import Window
from faremill.schema import MONTH

TOP_ROUTES = 50  # fixed value: rows of the route mart


@dataclass(frozen=True)
class Mart:
    keys: tuple[str, ...]     # grouping columns, as named in the mart
    outputs: tuple[str, ...]  # measures
    known_only: bool = False  # drop groups with a NULL key


# Marts with their grouping columns and measures.
MARTS = {
    "trips_daily": Mart(("day",), ("trips", "revenue", "avg_fare", "avg_tip_pct", "avg_miles",
                                   "avg_duration_min")),
    "trips_by_hour": Mart(("dow_num", "day_name", "trip_hour"), ("trips", "avg_fare")),
    "trips_by_company": Mart(("company",), ("trips", "revenue", "avg_fare")),
    "payment_mix": Mart(("payment_type",), ("trips", "revenue")),
    "top_routes": Mart(("pickup_community_area", "dropoff_community_area"),
                       ("trips", "avg_fare", "avg_miles"), known_only=True),
    "trips_by_pickup_area": Mart(("pickup_community_area",), ("trips", "revenue", "avg_fare"),
                                 known_only=True),
}
KEY_TYPES = {
    "day": "date", "dow_num": "int", "day_name": "string", "trip_hour": "int",
    "company": "string", "payment_type": "string",
    "pickup_community_area": "int", "dropoff_community_area": "int",
}
STATE_DDL = ", ".join([
    "mart string", *[f"{name} {kind}" for name, kind in KEY_TYPES.items()], "trips bigint",
    *[f"{m}_units {UNITS_TYPE}" + ("" if m == "total" else f", {m}_count bigint") for m in S.MEASURES],
    f"{MONTH} string"])


def key_column(name: str) -> Column:
    if name == "day":
        return F.col("trip_date")
    return or_unknown(F.col(name)) if name in ("company", "payment_type") else F.col(name)


def grouped(silver: DataFrame, mart: str) -> DataFrame:
    """Keys and measures of one mart straight from silver rows."""
    spec = MARTS[mart]
    if spec.known_only:
        silver = silver.dropna(subset=list(spec.keys))
    return S.summarize(silver, {name: key_column(name) for name in spec.keys}, list(spec.outputs))


# the marts, each from its grouped rows -----------------------------------------------------

def ordered(rows: DataFrame, mart: str) -> DataFrame:
    """Rows of a mart in the order it is published in."""
    if mart == "trips_daily":
        return rows.orderBy("day")
    if mart == "trips_by_hour":
        return rows.orderBy("dow_num", "trip_hour")
    return S.busiest(rows, list(MARTS[mart].keys))


def _finish(mart: str, groups: DataFrame, areas: DataFrame | None) -> DataFrame:
    if mart == "payment_mix":  # every trip is in a group, so the groups hold the total
        return ordered(S.with_share(groups), mart)
    if mart == "top_routes":
        keys = list(MARTS[mart].keys)
        top = S.busiest(groups, keys, TOP_ROUTES)  # before the joins: they see 50 rows
        named = S.name_areas(S.name_areas(top, areas, keys[0], "pickup_area"),
                             areas, keys[1], "dropoff_area")
        return S.busiest(named.select(keys[0], "pickup_area", keys[1], "dropoff_area", "trips",
                                      "avg_fare", "avg_miles"), keys)
    if mart == "trips_by_pickup_area":
        named = S.name_areas(groups, areas, "pickup_community_area", "area_name", "is_airport")
        return S.busiest(named.select("pickup_community_area", "area_name", "is_airport", "trips",
                                      "revenue", "avg_fare"), ["pickup_community_area"])
    return ordered(groups, mart)


def mart(silver: DataFrame, name: str, areas: DataFrame | None = None) -> DataFrame:
    return _finish(name, grouped(silver, name), areas)


def trips_daily(silver: DataFrame) -> DataFrame:
    return mart(silver, "trips_daily")


def trips_by_hour(silver: DataFrame) -> DataFrame:
    return mart(silver, "trips_by_hour")


def trips_by_company(silver: DataFrame) -> DataFrame:
    return mart(silver, "trips_by_company")


def payment_mix(silver: DataFrame) -> DataFrame:
    return mart(silver, "payment_mix")


def top_routes(silver: DataFrame, areas: DataFrame) -> DataFrame:
    return mart(silver, "top_routes", areas)


def trips_by_pickup_area(silver: DataFrame, areas: DataFrame) -> DataFrame:
    return mart(silver, "trips_by_pickup_area", areas)


# rebuild through the per-month state -------------------------------------------------------

def state(silver: DataFrame) -> DataFrame:
    """Mergeable aggregates of all marts, per month, from one scan and one shuffle."""
    columns = [MONTH, *KEY_TYPES]
    rows = silver.withColumnRenamed("trip_date", "day").select(*columns, *S.MEASURES.values())
    sets = [[F.col(MONTH), *[F.col(key) for key in spec.keys]] for spec in MARTS.values()]
    # grouping_id has one bit per column, set where the column is not part of the grouping set
    label = F.lit(None)
    for name, spec in MARTS.items():
        bits = "".join("0" if column in (MONTH, *spec.keys) else "1" for column in columns)
        label = F.when(F.col("_set") == int(bits, 2), F.lit(name)).otherwise(label)
    return (rows.groupingSets(sets, *[F.col(name) for name in columns])
            .agg(F.grouping_id().alias("_set"), *S.partial())
            .withColumn("mart", label).drop("_set"))


def state_of(stored: DataFrame, mart: str) -> DataFrame:
    """The state rows of one mart: its keys (NULL as in silver), trips and measures."""
    return stored.filter(F.col("mart") == mart)


def grouped_from_state(stored: DataFrame, mart: str) -> DataFrame:
    """The same as ``grouped``, from the state."""
    spec = MARTS[mart]
    rows = state_of(stored, mart).withColumnRenamed("day", "trip_date")
    if spec.known_only:
        rows = rows.dropna(subset=list(spec.keys))
    return (rows.groupBy(*[key_column(name).alias(name) for name in spec.keys])
            .agg(*S.merged(tuple(S.needed(spec.outputs))))
            .select(*spec.keys, *[S.final(output) for output in spec.outputs]))


def mart_from_state(stored: DataFrame, name: str, areas: DataFrame | None = None) -> DataFrame:
    return _finish(name, grouped_from_state(stored, name), areas)


def state_table(lake: Lake) -> DataFrame:
    lake.create_monthly("gold", STATE, STATE_DDL)
    return lake.table("gold", STATE)


def refresh_state(lake: Lake, window: Window | None = None, rows_of=None) -> None:
    """Recompute the state of the window's months, or of all months. All months also when another
    silver month has no state yet, as in a first run. State of months that silver has no more is
    dropped. ``rows_of(lake, window)`` makes the state's rows from another source than silver."""
    state_table(lake)
    for month in lake.stored_months("gold", STATE) - lake.stored_months("silver"):
        lake.drop_month("gold", month, STATE)
    if window is not None and (lake.stored_months("silver") - set(window.months)
                               - lake.stored_months("gold", STATE)):
        window = None
    rows = rows_of(lake, window) if rows_of else state(lake.read("silver", window))
    lake.overwrite_months(rows, "gold", STATE, window=window, drop_missing=True)


def rebuild(lake: Lake, areas: DataFrame, window: Window | None = None, rows_of=None
            ) -> dict[str, str]:
    """Stage a new version of every mart and return the locations; ``promote`` publishes them.

    ``window`` limits the silver scan to changed months; the other months come from the state."""
    refresh_state(lake, window, rows_of)
    stored = state_table(lake)
    return {name: lake.stage(mart_from_state(stored, name, areas), name) for name in MARTS}


# check inputs --------------------------------------------------------------------------------

def counts(marts: dict[str, DataFrame]) -> DataFrame:
    """Rows of each mart as (mart, rows)."""
    return reduce(DataFrame.unionByName, [
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("mart"), "rows")
        for name, df in marts.items()])


def rollup(daily: DataFrame, silver: DataFrame) -> DataFrame:
    """One row: the daily mart's totals next to the same totals taken from silver."""
    whole = silver.agg(F.count("*").alias("silver_trips"),
                       F.coalesce(amount(sum_units("trip_total")), F.lit(0.0))
                       .alias("silver_revenue"))
    return daily.agg(
        F.count("*").alias("daily_rows"),
        F.min("revenue").alias("min_revenue"),
        F.coalesce(amount(sum_units("revenue")), F.lit(0.0)).alias("gold_revenue"),
        F.coalesce(F.sum("trips"), F.lit(0).cast("bigint")).alias("gold_trips"),
    ).select("*",
             whole.select("silver_trips").scalar().alias("silver_trips"),
             whole.select("silver_revenue").scalar().alias("silver_revenue"))
