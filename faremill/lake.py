"""The stored tables: bronze and silver trips partitioned by month, versioned gold marts.

Tables are external Parquet tables of the session catalog below one root folder. With a
persistent catalog ``create`` finds them again; in a fresh in-memory catalog it re-attaches them
from the files and the version ledger."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from faremill import storage
from faremill.operators.windows import Window, in_window
from faremill.records import Records
from faremill.schema import BRONZE_DDL, MONTH, SILVER_DDL
from faremill.session import SHUFFLED_PER_STORED, setting, sized_shuffles, task_bytes

TRIPS = "taxi_trips"
STATE = "mart_state"
LARGE_MONTH_BYTES = 4 << 30
FILE_BYTES = 128 << 20  # intended size of table files
FILE_ROWS = 4_000_000   # and their most rows
SORT_BYTES = 64 << 20   # shuffled bytes that a loading task sorts in memory; compaction makes files whole
VERSIONS_DDL = "table_name string, version_id string, location string, committed_at timestamp_ntz"


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


class Lake:
    def __init__(self, spark: SparkSession, root: str, prefix: str = ""):
        self.spark, self.root, self.prefix = spark, root.rstrip("/"), prefix

    # names and locations -------------------------------------------------------------------

    def name(self, layer: str, table: str = TRIPS) -> str:
        return f"{self.prefix}{layer}.{table}"

    def location(self, layer: str, table: str = TRIPS) -> str:
        return f"{self.root}/{layer}/{table}"

    @property
    def raw_root(self) -> str:
        return f"{self.root}/raw/taxi"

    def exists(self, layer: str, table: str = TRIPS) -> bool:
        return self.spark.catalog.tableExists(self.name(layer, table))

    def table(self, layer: str, table: str = TRIPS) -> DataFrame:
        return self.spark.table(self.name(layer, table))

    # creation ------------------------------------------------------------------------------

    def create(self) -> "Lake":
        for layer in ("bronze", "silver", "gold"):
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.prefix}{layer} "
                           f"LOCATION '{self.root}/{layer}'")
        self.create_monthly("bronze", TRIPS, BRONZE_DDL)
        self.create_monthly("silver", TRIPS, SILVER_DDL)
        if storage.exists(self.spark, self.versions_path):
            latest = self.versions().groupBy("table_name").agg(
                F.max_by("location", F.struct("committed_at", "version_id")).alias("location"))
            for row in latest.collect():  # one row per mart
                if not self.exists("gold", row["table_name"]):
                    self._point("gold", row["table_name"], row["location"])
        return self

    def create_monthly(self, layer: str, table: str, ddl: str) -> None:
        """A month-partitioned table whose overwrites replace only the months they write and whose
        files are bounded: both are table options, so they hold whatever the session setting is."""
        if self.exists(layer, table):
            return
        location = self.location(layer, table)
        found = storage.exists(self.spark, location)
        self.spark.sql(
            f"CREATE TABLE {self.name(layer, table)} ({ddl}) USING parquet "
            f"OPTIONS (partitionOverwriteMode 'dynamic', maxRecordsPerFile '{FILE_ROWS}') "
            f"PARTITIONED BY ({MONTH}) "
            f"LOCATION '{location}'")
        if found:
            self.spark.sql(f"ALTER TABLE {self.name(layer, table)} RECOVER PARTITIONS")

    # month-partitioned tables --------------------------------------------------------------

    def jobs(self, window: Window, root: str, key: str = MONTH) -> Iterator[Window]:
        """How to load ``window`` from month directories below ``root``: months that are large on
        average one job each, which then needs no shuffle to gather a month; small ones together.
        While a job runs, shuffles have enough partitions for the bytes it reads."""
        sizes = {month: storage.size(self.spark, f"{root}/{key}={month}")
                 for month in window.months}
        large = sum(sizes.values()) >= len(sizes) * LARGE_MONTH_BYTES
        for job in window.split() if large else [window]:
            with sized_shuffles(self.spark, sum(sizes[month] for month in job.months)):
                yield job

    def read(self, layer: str, window: Window | None = None) -> DataFrame:
        trips = self.table(layer)
        return trips if window is None else in_window(trips, window)

    def read_partitions(self, layer: str, window: Window) -> DataFrame:
        """What is stored under the window's months, whatever the rows' own timestamps say."""
        return self.table(layer).filter(window.partitions())

    def overwrite_months(self, df: DataFrame, layer: str, table: str = TRIPS,
                         window: Window | None = None, drop_missing: bool = False,
                         order: tuple[str, ...] = (), cluster: tuple[str, ...] = (MONTH,),
                         shuffled: int | None = None, whole_files: bool = False,
                         apart: bool = False) -> None:
        """Replace exactly the months present in ``df``.

        ``cluster`` gathers a month's rows in few tasks before the write; AQE splits a month that
        outgrows the target file size and merges small ones, so no task ever has to take a whole
        hot month; a task takes at most ``shuffled`` bytes, by default as many as it sorts
        without spilling, or with ``whole_files`` those of a file of the intended size. With
        ``drop_missing``, months of ``window`` that have no row any more are removed as well."""
        whole = FILE_BYTES * SHUFFLED_PER_STORED
        shuffled = shuffled or (whole if whole_files else min(whole, SORT_BYTES))
        target = self.table(layer, table)
        rows = df.select(*target.columns)
        if cluster:
            rows = rows.hint("rebalance", *[F.col(name) for name in cluster])
        if order:
            rows = rows.sortWithinPartitions(MONTH, *order)
        written = None
        if drop_missing:
            written = Observation()  # after the last shuffle, where retries count once
            rows = rows.observe(written, F.collect_set(MONTH).alias("months"))
        # Spark sorts by month before a partitioned write; one unordered month a task (``apart``, or
        # a window of one) needs no such sort
        plain = (apart or window is not None and len(window.months) == 1) and not order
        writers = setting(self.spark, "spark.sql.maxConcurrentOutputFileWriters",
                          "2" if plain else "0")
        # merged and split shuffle partitions, and with them files, follow the file size; the
        # settings hold for the session's other jobs of this moment as well, which lose nothing by it
        sizes = setting(self.spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes",
                        str(task_bytes(df, shuffled)))
        with writers, sizes:
            rows.write.insertInto(self.name(layer, table), overwrite=True)
        if drop_missing:
            gone = self.stored_months(layer, table) - set(written.get["months"])
            for month in gone if window is None else gone & set(window.months):
                self.drop_month(layer, month, table)

    def stored_months(self, layer: str, table: str = TRIPS) -> set[str]:
        """Month labels known to the catalog; reads no data."""
        found = self.spark.sql(f"SHOW PARTITIONS {self.name(layer, table)}").collect()
        return {row[0].split("=", 1)[1] for row in found}

    def drop_month(self, layer: str, month: str, table: str = TRIPS) -> None:
        self.spark.sql(f"ALTER TABLE {self.name(layer, table)} "
                       f"DROP IF EXISTS PARTITION ({MONTH} = '{month}')")
        storage.delete(self.spark, f"{self.location(layer, table)}/{MONTH}={month}")

    def month_counts(self, layer: str, window: Window | None = None) -> DataFrame:
        """Rows per stored month. Reads no column, only file footers and partition values."""
        trips = self.table(layer)
        if window is not None:
            trips = trips.filter(window.partitions())
        return trips.groupBy(MONTH).agg(F.count("*").alias("rows"))

    # versioned marts -----------------------------------------------------------------------

    @property
    def versions_path(self) -> str:
        return f"{self.root}/ledger/versions"

    @property
    def version_records(self) -> Records:
        return Records(self.spark, self.versions_path, VERSIONS_DDL)

    def versions(self) -> DataFrame:
        return self.version_records.read()

    def current_location(self, mart: str) -> str:
        return (self.versions().filter(F.col("table_name") == mart)
                .agg(F.max_by("location", F.struct("committed_at", "version_id"))).first()[0])

    def stage(self, df: DataFrame, mart: str) -> str:
        """Write a new version of a mart without publishing it; returns its location."""
        location = f"{self.location('gold', mart)}/version={utc_now():%Y%m%dT%H%M%S}-" \
                   f"{uuid.uuid4().hex[:8]}"
        df.write.parquet(location)
        return location

    def staged(self, location: str) -> DataFrame:
        return self.spark.read.parquet(location)

    def promote(self, staged: dict[str, str]) -> None:
        """Make staged versions (mart -> location) the current ones: readers of a mart see the
        old version or the new one, never a mix."""
        rows = [(mart, location.rsplit("version=", 1)[1], location, utc_now())
                for mart, location in staged.items()]
        # recorded first: a fresh catalog then finds what another one already serves
        self.version_records.append(self.spark.createDataFrame(rows, VERSIONS_DDL))
        for mart, location in staged.items():
            self._point("gold", mart, location)

    def publish(self, df: DataFrame, mart: str) -> None:
        self.promote({mart: self.stage(df, mart)})

    def _point(self, layer: str, table: str, location: str) -> None:
        name = self.name(layer, table)
        schema = self.staged(location).schema
        if self.exists(layer, table) and self.spark.table(name).schema != schema:
            self.spark.sql(f"DROP TABLE {name}")  # external: the files stay
        if self.exists(layer, table):
            self.spark.sql(f"ALTER TABLE {name} SET LOCATION '{location}'")
            self.spark.catalog.refreshTable(name)
        else:
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet LOCATION '{location}'")

    # serving -------------------------------------------------------------------------------

    def register_areas(self, areas: DataFrame, view: str = "areas") -> None:
        """The dimension under its serving name and column names."""
        areas.withColumnRenamed("area_airport", "is_airport").createOrReplaceTempView(view)
