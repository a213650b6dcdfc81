"""Lakes that registered queries run on, derived by Spark from the test tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from faremill import storage
from faremill.functions.trip import month_label
from faremill.lake import Lake
from faremill.operators.windows import Window
from faremill.plans import cube, gold, silver
from faremill.schema import MONTH
from faremill.session import sized_shuffles
from faremill.sources import feed, raw_csv


def new_lake(spark: SparkSession) -> Lake:
    """An empty lake in a new shared folder, with table names of its own."""
    return Lake(spark, storage.working_folder(spark, "lake"),
                f"fm_{uuid.uuid4().hex[:8]}_").create()


TASK_BYTES = 16 << 20  # shuffled feed rows of a task that sorts them, much wider, and writes bronze


def typed_trips(spark: SparkSession, folder: str) -> DataFrame:
    """The feed as bronze rows."""
    trips = feed.trips(spark, folder)
    start = F.col("trip_start_timestamp")
    return trips.filter(start.isNotNull()).withColumn(MONTH, month_label(start))


class Workspace:
    """One lake per session and data folder: feed -> bronze -> silver, as stored tables. Silver, raw
    parts, marts and the cube are added when a query first needs them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._lake = new_lake(spark)
        lines = storage.size(spark, f"{folder}/lineitem.parquet")
        with sized_shuffles(spark, lines):
            self._lake.overwrite_months(
                self._gathered(), "bronze", order=("trip_start_timestamp",), cluster=(),
                shuffled=TASK_BYTES)
        self.areas = feed.areas(spark, folder)
        first, last = self._lake.table("bronze").agg(F.min(MONTH), F.max(MONTH)).first()
        self.span = Window(Window.of(first).start, Window.of(last).end)
        self._refined = self._landed = self._published = False
        self._cube = None

    def _gathered(self) -> DataFrame:
        """``typed_trips`` gathered by month while the rows are still narrow."""
        lines = feed.lines(self.spark, self.folder).filter(feed.STARTS).withColumn(
            MONTH, month_label(F.col("start_at")))
        trips = feed.from_lines(lines.hint("rebalance", F.col(MONTH)))
        return trips.withColumn(MONTH, month_label(F.col("trip_start_timestamp")))

    @property
    def lake(self) -> Lake:
        """The lake with bronze and silver."""
        if not self._refined:
            silver.load(self._lake, self.span)
            self._refined = True
        return self._lake

    @property
    def bronze_lake(self) -> Lake:
        """The lake; only its bronze and raw layers are sure to be there."""
        return self._lake

    @property
    def bronze(self) -> DataFrame:
        return self._lake.table("bronze")

    def text(self) -> DataFrame:
        """The feed's rows with a start time as raw text, from stored bronze: it holds the same
        values, and a month is read without the others."""
        return feed.as_text(self.bronze)

    @property
    def silver(self) -> DataFrame:
        return self.lake.table("silver")

    def landed(self) -> "Workspace":
        if not self._landed:
            raw_csv.land(self.text(), self._lake.raw_root, self.span, gathered=True)
            self._landed = True
        return self

    def published(self) -> "Workspace":
        if not self._published:
            self.lake.promote(gold.rebuild(self.lake, self.areas))
            self._published = True
        return self

    def cube(self) -> cube.Cube:
        if self._cube is None:
            cube.refresh(self.lake)
            self._cube = cube.Cube(self.lake)
        return self._cube

    def marts(self) -> dict[str, DataFrame]:
        return {name: self.published().lake.table("gold", name) for name in gold.MARTS}


_OPEN: dict[tuple[str, str], Workspace] = {}


def workspace(spark: SparkSession, folder: str) -> Workspace:
    key = (spark.sparkContext.applicationId, folder)
    if key not in _OPEN:
        _OPEN[key] = Workspace(spark, folder)
    return _OPEN[key]
