"""Grouped measures and the steps that shape grouped rows into reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from faremill.functions.fixed_point import amount, mean, sum_units

# measure prefix -> silver column; each is kept as an exact sum and a non-null count
MEASURES = {
    "total": "trip_total",
    "fare": "fare",
    "tip": "tip_pct",
    "miles": "trip_miles",
    "minutes": "duration_min",
}
# output column -> (measure, digits)
AVERAGES = {
    "avg_fare": ("fare", 2),
    "avg_tip_pct": ("tip", 4),
    "avg_miles": ("miles", 2),
    "avg_duration_min": ("minutes", 2),
}


def needed(outputs) -> list[str]:
    """The measures behind the given output columns."""
    found = [AVERAGES[name][0] for name in outputs if name in AVERAGES]
    return (["total"] if "revenue" in outputs else []) + found


def partial(measures=tuple(MEASURES)) -> list[Column]:
    """Mergeable aggregates: adding them over any split of the rows gives the same result."""
    found = [F.count("*").alias("trips")]
    for name in measures:
        column = MEASURES[name]
        found.append(sum_units(column).alias(f"{name}_units"))
        if name != "total":
            found.append(F.count(column).alias(f"{name}_count"))
    return found


def merged(measures=tuple(MEASURES)) -> list[Column]:
    names = ["trips"]
    for name in measures:
        names += [f"{name}_units"] + ([f"{name}_count"] if name != "total" else [])
    return [F.sum(name).alias(name) for name in names]


def final(output: str) -> Column:
    """A report column from the merged aggregates."""
    if output == "revenue":
        return amount(F.col("total_units")).alias(output)
    if output in AVERAGES:
        measure, digits = AVERAGES[output]
        return mean(F.col(f"{measure}_units"), F.col(f"{measure}_count"), digits).alias(output)
    return F.col(output)


def summarize(df: DataFrame, keys: dict[str, Column], outputs: list[str]) -> DataFrame:
    """Group by the named key expressions and compute ``outputs``."""
    grouped = df.groupBy(*[key.alias(name) for name, key in keys.items()])
    return (grouped.agg(*partial(needed(outputs)))
            .select(*keys, *[final(name) for name in outputs]))


def busiest(df: DataFrame, ties: list[str], k: int | None = None) -> DataFrame:
    """Most trips first, equal counts by key; a limit makes it a distributed top-k."""
    ordered = df.orderBy(F.desc("trips"), *[F.asc_nulls_last(name) for name in ties])
    return ordered if k is None else ordered.limit(k)


def with_share(groups: DataFrame) -> DataFrame:
    """``trips`` as a fraction of all groups' trips. The window sees one row per group, after the
    aggregation, so the trips are scanned once."""
    whole = F.greatest(F.sum("trips").over(W.partitionBy()), F.lit(1))
    return groups.withColumn("pct_of_trips", F.round(F.col("trips") / whole, 4))


def name_areas(df: DataFrame, areas: DataFrame, code: str, name: str,
               flag: str | None = None) -> DataFrame:
    """Left join of the (unique) area dimension on an area code column. No broadcast hint:
    Spark broadcasts the dimension while its size is under the session's threshold."""
    picked = [F.col("area_no").alias(f"_{code}"), F.col("area_name").alias(name)]
    if flag:
        picked.append(F.col("area_airport").alias(flag))
    return df.join(areas.select(*picked), F.col(code) == F.col(f"_{code}"), "left").drop(f"_{code}")


def heatmap(by_hour: DataFrame) -> DataFrame:
    """All 24 hours of every weekday present, missing ones as 0, with intensity against the peak.

    Input has one row per weekday and hour, so a weekday's map has at most 24 entries and the
    final window at most 7 x 24 rows."""
    days = by_hour.groupBy("dow_num", "day_name").agg(
        F.map_from_entries(F.collect_list(F.struct("hour", "trips"))).alias("_trips"))
    dense = (days.withColumn("hour", F.explode(F.sequence(F.lit(0), F.lit(23))))
             .select("dow_num", "day_name", "hour",
                     F.coalesce(F.try_element_at("_trips", F.col("hour")),
                                F.lit(0).cast("bigint")).alias("trips")))
    peak = F.greatest(F.max("trips").over(W.partitionBy()), F.lit(1))
    return (dense.withColumn("intensity", F.col("trips") / peak)
            .orderBy("dow_num", "hour"))
