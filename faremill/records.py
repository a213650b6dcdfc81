"""Small append-only tables of run records: one file per write, folded into snapshots.

A reader takes the newest snapshot and the files that it does not hold. ``fold`` writes a snapshot
of all it finds, puts it in place by a rename, and then deletes what it holds: a fold that is broken
off leaves either the old state or files that the snapshot's list already names, so no record is lost
or read twice. Without folds a long-lived ledger would list every run's file on the driver."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from faremill import storage

SNAPSHOT, HELD = "snapshot=", "_held"  # Spark's readers pass over names that begin with _


class Records:
    def __init__(self, spark: SparkSession, path: str, ddl: str):
        self.spark, self.path, self.ddl = spark, path, ddl

    def append(self, rows: DataFrame) -> str:
        """Stores rows as one entry; returns its location, which only holds them."""
        location = f"{self.path}/entry={uuid.uuid4().hex}"
        rows.coalesce(1).write.parquet(location)
        return location

    def read(self) -> DataFrame:
        return self._read(self._current())

    def entry(self, location: str) -> DataFrame:
        return self._read([location])

    def _read(self, locations: list[str]) -> DataFrame:
        if not locations:
            return self.spark.createDataFrame([], self.ddl)
        return self.spark.read.schema(self.ddl).parquet(*locations)

    def _current(self) -> list[str]:
        snapshot, tail, _ = self._state()
        return self._paths(snapshot, tail)

    def _paths(self, snapshot: str | None, tail: list[str]) -> list[str]:
        return [f"{self.path}/{name}" for name in ([snapshot] if snapshot else []) + tail]

    def _state(self) -> tuple[str | None, list[str], list[str]]:
        """Newest snapshot, entries after it, and what may be deleted."""
        names = [name for name in storage.children(self.spark, self.path)
                 if not name.startswith(("_", "."))]
        snapshots = sorted(name for name in names if name.startswith(SNAPSHOT))
        newest = snapshots[-1] if snapshots else None
        held = set(storage.read_text(self.spark, f"{self.path}/{newest}/{HELD}").split("\n")
                   ) if newest else set()
        tail = sorted(name for name in names if not name.startswith(SNAPSHOT) and name not in held)
        return newest, tail, [n for n in names if n in held or n in snapshots[:-1]]

    def entries(self) -> int:
        """Entries that are in no snapshot yet."""
        return len(self._state()[1])

    def fold(self, at_least: int = 20) -> int:
        """Folds the table if that many entries are in no snapshot; returns the number folded."""
        snapshot, tail, gone = self._state()
        tail = [name for name in tail if name.endswith(".parquet")  # not one being written
                or storage.exists(self.spark, f"{self.path}/{name}/_SUCCESS")]
        if len(tail) >= at_least:
            number = int(snapshot.removeprefix(SNAPSHOT).split("-")[0]) + 1 if snapshot else 1
            made = f"{SNAPSHOT}{number:09d}-{uuid.uuid4().hex[:8]}"
            building = f"{self.path}/_building-{made}"
            self._read(self._paths(snapshot, tail)).coalesce(1).write.parquet(building)
            storage.write_text(self.spark, f"{building}/{HELD}", "\n".join(tail))
            storage.rename(self.spark, building, f"{self.path}/{made}")
            gone += tail + ([snapshot] if snapshot else [])
        for name in gone:
            storage.delete(self.spark, f"{self.path}/{name}")
        return len(tail) if len(tail) >= at_least else 0
