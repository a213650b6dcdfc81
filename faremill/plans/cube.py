"""A cube of trips for filtered BI queries: exact partial sums by day or weekday, hour, company,
payment type, pickup area and route, so that a filtered report scans no trips.

Every grouping is a month-partitioned table ``gold.cube_<name>``. The groupings with days answer any
filter; those with weekdays only are smaller and answer the months that a date filter covers whole.
A query takes, for whole months and for months cut by its dates, the smallest stored grouping that
has its keys and filter columns, and merges both. The groupings with pickup areas are computed from
silver, whose needed columns are shuffled once, by month, weekday and pickup area: every group of
theirs then lies in one task and is written from there. The others are rolled up from the smallest
finer one that is stored, and so are the aggregates the marts are built from. All sums are of
integers, so every way gives the same result."""

from __future__ import annotations

import operator
from dataclasses import replace
from datetime import date, timedelta
from functools import reduce
from math import ceil

from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F

from faremill import storage
from faremill.functions.fixed_point import UNITS_TYPE
from faremill.lake import Lake
from faremill.operators import summaries as S
from faremill.operators.filters import Filters
from faremill.operators.windows import Window
from faremill.plans import gold
from faremill.schema import MONTH
from faremill.session import setting

WEEKDAY = ("dow_num", "day_name")
DAY = ("trip_date", *WEEKDAY)
_CHOICES = ("company", "payment_type", "pickup_community_area")
_ROUTE = (*_CHOICES, "dropoff_community_area")
#: Grouping -> its columns, finest first: each is rolled up from one before it.
GROUPINGS: dict[str, tuple[str, ...]] = {
    "day_route": (*DAY, *_ROUTE),
    "day_hour": (*DAY, "trip_hour", *_CHOICES),
    "weekday_route": (*WEEKDAY, *_ROUTE),
    "weekday_hour": (*WEEKDAY, "trip_hour", *_CHOICES),
    "day_choice": (*DAY, *_CHOICES),
    "weekday_choice": (*WEEKDAY, *_CHOICES),
    "weekday_areas": (*WEEKDAY, "pickup_community_area", "dropoff_community_area"),
    "weekday_company": (*WEEKDAY, "company"),
    "weekday_payment": (*WEEKDAY, "payment_type"),
    "weekday_area": (*WEEKDAY, "pickup_community_area"),
    "weekday_hours": (*WEEKDAY, "trip_hour"),
    "day": DAY,
}
#: Columns silver is shuffled by, and the groupings that have them all.
GATHERED_BY = (MONTH, "dow_num", "pickup_community_area")
FROM_SILVER = tuple(name for name, keys in GROUPINGS.items() if {*GATHERED_BY} <= {MONTH, *keys})
TASK_BYTES = 8 << 20  # stored silver bytes whose groups a task sums up and sorts, in memory
LEAST_BYTES = 1 << 20
_TYPES = {**gold.KEY_TYPES, "trip_date": "date"}
_SUMS = {"trips": "bigint"}
for _measure in S.MEASURES:
    _SUMS[f"{_measure}_units"] = UNITS_TYPE
    if _measure != "total":
        _SUMS[f"{_measure}_count"] = "bigint"


def table_name(grouping: str) -> str:
    return f"cube_{grouping}"


def write_order(grouping: str) -> tuple[str, ...]:
    return tuple(key for key in GROUPINGS[grouping] if key != "day_name")


def _table(lake: Lake, grouping: str) -> DataFrame:
    columns = {key: _TYPES[key] for key in GROUPINGS[grouping]} | _SUMS | {MONTH: "string"}
    lake.create_monthly("gold", table_name(grouping),
                        ", ".join(f"{name} {kind}" for name, kind in columns.items()))
    return lake.table("gold", table_name(grouping))


def _finer(grouping: str) -> list[str]:
    """Groupings before ``grouping`` that have all its columns."""
    names = list(GROUPINGS)
    return [name for name in names[:names.index(grouping)]
            if set(GROUPINGS[grouping]) <= set(GROUPINGS[name])]


# refresh -------------------------------------------------------------------------------------

def _missing(lake: Lake) -> set[str]:
    """Months of silver that some grouping does not hold."""
    held = [lake.stored_months("gold", table_name(name)) for name in GROUPINGS]
    return lake.stored_months("silver") - set.intersection(*held)


def _tasks(lake: Lake, window: Window | None) -> int:
    """Tasks for silver's stored bytes: small tables use the session's cores, if their share is
    worth a task."""
    root = lake.location("silver")
    stored = storage.size(lake.spark, root) if window is None else sum(
        storage.size(lake.spark, f"{root}/{MONTH}={month}") for month in window.months)
    cores = lake.spark.sparkContext.defaultParallelism
    return max(1, ceil(stored / TASK_BYTES), min(cores, stored // LEAST_BYTES))


def _gathered(lake: Lake, window: Window | None) -> DataFrame:
    """The silver columns of the cube, gathered by GATHERED_BY."""
    keys = list(dict.fromkeys(key for name in FROM_SILVER for key in GROUPINGS[name]))
    return (lake.read("silver", window).select(MONTH, *keys, *S.MEASURES.values())
            .repartitionByRange(_tasks(lake, window), *GATHERED_BY))


def _rolled(finer: DataFrame, grouping: str) -> DataFrame:
    return finer.groupBy(MONTH, *GROUPINGS[grouping]).agg(*S.merged())


def refresh(lake: Lake, window: Window | None = None) -> None:
    """Computes every grouping again for the window's months, or for all; for all as well when
    another silver month is missing in the cube. Months that silver has no more are dropped."""
    for name in GROUPINGS:
        _table(lake, name)
        for month in (lake.stored_months("gold", table_name(name)) - lake.stored_months("silver")):
            lake.drop_month("gold", month, table_name(name))
    if window is not None and _missing(lake) - set(window.months):
        window = None
    # cached with its partitioning, which spares every grouping below a shuffle of its own
    with setting(lake.spark, "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning", "false"):
        gathered = _gathered(lake, window).persist(StorageLevel.DISK_ONLY)
    try:
        for name in FROM_SILVER:
            rows = gathered.groupBy(MONTH, *GROUPINGS[name]).agg(*S.partial())
            lake.overwrite_months(rows, "gold", table_name(name), window=window, drop_missing=True,
                                  order=write_order(name), cluster=())
    finally:
        gathered.unpersist()
    sizes = {name: storage.size(lake.spark, lake.location("gold", table_name(name)))
             for name in FROM_SILVER}
    for name in GROUPINGS:
        if name in FROM_SILVER:
            continue
        source = min((finer for finer in _finer(name) if finer in sizes), key=sizes.__getitem__)
        finer = _table(lake, source)
        rows = _rolled(finer if window is None else finer.filter(window.partitions()), name)
        lake.overwrite_months(rows, "gold", table_name(name), window=window, drop_missing=True,
                              order=write_order(name))
        sizes[name] = storage.size(lake.spark, lake.location("gold", table_name(name)))


# queries -------------------------------------------------------------------------------------

class Cube:
    """The stored groupings of a lake as the input of BI queries.

    ``measured`` (grouping -> stored bytes) is read once, when the cube is opened."""

    def __init__(self, lake: Lake):
        self.lake = lake
        self.measured = {name: storage.size(lake.spark, lake.location("gold", table_name(name)))
                         for name in GROUPINGS if lake.exists("gold", table_name(name))}
        if not self.measured:
            raise ValueError("the lake has no cube; run cube.refresh")

    def choose(self, columns) -> str:
        """The smallest grouping that has all columns."""
        fitting = [name for name in self.measured if set(columns) <= set(GROUPINGS[name])]
        if not fitting:
            raise ValueError(f"no grouping of the cube has {sorted(columns)}")
        return min(fitting, key=lambda name: (self.measured[name], name))

    def plan(self, keys, filters: Filters = Filters()) -> list[tuple[str, list]]:
        """(grouping, conditions) of the parts that together hold the filtered trips once each."""
        columns = {*keys, *filters.columns()} - {MONTH}
        choices = replace(filters, start=None, end=None)
        by_day = (self.choose(columns), [*filters.pruning(), *filters.conditions()])
        if "trip_date" in keys or not (filters.start or filters.end):
            return [by_day]
        months, edges = whole_months(filters)
        if months is None:
            return [by_day]
        inner = self.choose(columns - {"trip_date"})
        if inner == by_day[0]:
            return [by_day]
        parts = [(inner, [months, *choices.conditions()])]
        if edges is not None:
            parts.append((by_day[0], [edges, *by_day[1]]))
        return parts

    def rows(self, keys, filters: Filters = Filters()) -> DataFrame:
        """Partial sums of the filtered trips by ``keys`` or finer; no trips are read."""
        parts = []
        for grouping, conditions in self.plan(keys, filters):
            rows = self.lake.table("gold", table_name(grouping))
            rows = rows.filter(reduce(operator.and_, conditions)) if conditions else rows
            parts.append(rows.select(*keys, *_SUMS))
        return reduce(DataFrame.unionByName, parts)

    def grouped(self, mart: str, filters: Filters = Filters()) -> DataFrame:
        """The same as ``gold.grouped`` on filtered silver."""
        keys = ["trip_date" if key == "day" else key for key in gold.MARTS[mart].keys]
        rows = self.rows(keys, filters)
        return gold.grouped_from_state(rows.withColumn("mart", F.lit(mart)), mart)


def whole_months(filters: Filters):
    """Conditions on the month: for the months a date range covers whole (None: there is none) and
    for those it cuts (None: it cuts none)."""
    try:
        first = date.fromisoformat(filters.start) if filters.start else None
        after = (date.fromisoformat(filters.end) + timedelta(days=1)) if filters.end else None
    except ValueError:  # other forms of a date, which Spark may know
        return None, None
    cut = {f"{first:%Y-%m}"} if first and first.day > 1 else set()
    if after and after.day > 1:
        cut.add(f"{after:%Y-%m}")
    if first and after:
        start, end = f"{first:%Y-%m}", f"{after:%Y-%m}"  # months up to, not with, that of after
        if start >= end or not set(Window.of(start, end).months) - cut:
            return None, None
    month = F.col(MONTH)
    edges = month.isin(*sorted(cut)) if cut else None
    return reduce(operator.and_, [*filters.pruning(), *([~edges] if cut else [])]), edges


def state(lake: Lake, window: Window | None = None) -> DataFrame:
    """Rows of ``gold.state`` from the cube."""
    cube = Cube(lake)
    parts = []
    for mart, spec in gold.MARTS.items():
        keys = ["trip_date" if key == "day" else key for key in spec.keys]
        table = lake.table("gold", table_name(cube.choose(keys)))
        table = table if window is None else table.filter(window.partitions())
        rows = table.groupBy(MONTH, *keys).agg(*S.merged()).withColumnRenamed("trip_date", "day")
        parts.append(rows.select(
            F.lit(mart).alias("mart"),
            *[(F.col(key) if key in spec.keys else F.lit(None).cast(kind)).alias(key)
              for key, kind in gold.KEY_TYPES.items()],
            *[c for c in rows.columns if c not in spec.keys]))
    return reduce(DataFrame.unionByName, parts)
