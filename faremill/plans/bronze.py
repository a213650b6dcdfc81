"""Bronze: typed trips, one row per raw row with a start time."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, functions as F

from faremill import storage
from faremill.functions import parse
from faremill.functions.trip import month_label
from faremill.lake import Lake
from faremill.operators import digests
from faremill.operators.windows import Window
from faremill.schema import MONTH, TRIP_COLUMNS, TRIP_TYPES
from faremill.sources import raw_csv

TYPED = [name for name in TRIP_COLUMNS if TRIP_TYPES[name] != "string"]


@dataclass
class BronzeLoad:
    window: Window
    raw_rows: dict[str, int] = field(default_factory=dict)  # per raw month
    kept: dict[str, int] = field(default_factory=dict)      # and what of them this load stored
    digests: dict[str, str] = field(default_factory=dict)   # of the rows stored for each month
    kept_rows: int = 0
    missing_start: int = 0
    other_month: int = 0
    bad_cells: dict[str, int] = field(default_factory=dict)

    def add(self, counts: dict) -> None:
        self.raw_rows.update(counts["raw_rows"])
        self.kept.update(counts["kept"])
        self.digests.update(counts["digests"])
        for name in ("kept_rows", "missing_start", "other_month"):
            setattr(self, name, getattr(self, name) + counts[name])
        for name in TYPED:
            if counts[f"bad_{name}"]:
                self.bad_cells[name] = self.bad_cells.get(name, 0) + counts[f"bad_{name}"]


def typed(raw: DataFrame, *extra: Column) -> DataFrame:
    """Every raw row with typed columns and its month, plus ``extra`` columns of the raw row."""
    rows = raw.select(*[parse.cell(name).alias(name) for name in TRIP_COLUMNS], *extra)
    return rows.withColumn(MONTH, month_label(F.col("trip_start_timestamp")))


def build(raw: DataFrame) -> DataFrame:
    return typed(raw).filter(F.col("trip_start_timestamp").isNotNull())


def load(lake: Lake, window: Window, strict: bool = False, drop_empty: bool = False
         ) -> BronzeLoad:
    """Load the raw months of ``window`` into the bronze table.

    Rows of another month than their directory's are counted and left out, so a stray row can
    never replace a month. Months without raw rows keep their old content unless ``drop_empty``.
    With ``strict`` a malformed cell anywhere in the window fails the load before it stores a month.

    One month is written straight from the scan, without any shuffle. Several small months in one
    job are gathered by month first, since a scan task may hold parts of many; middling ones are
    scanned apart instead, so that no task holds parts of two."""
    total = BronzeLoad(window)
    if strict:
        _refuse_malformed(lake, window)
    for job in lake.jobs(window, lake.raw_root, "month"):
        total.add(_load(lake, job, drop_empty))
    return total


def _refuse_malformed(lake: Lake, window: Window) -> None:
    broken = F.lit(False)
    for name in TYPED:
        broken = broken | parse.is_bad(name)
    raw = raw_csv.scan(lake.spark, lake.raw_root, window)
    found = raw.filter(broken).agg(F.count("*").alias("rows"), F.min("trip_id").alias("id")).first()
    if found["rows"]:
        raise ValueError(f"malformed cell in trip {found['id'] or '?'} "
                         f"({found['rows']} such rows in {window.label})")


def _load(lake: Lake, window: Window, drop_empty: bool) -> dict:
    flags = [parse.is_bad(name).alias(f"_bad_{name}") for name in TYPED]
    stored = sum(storage.size(lake.spark, f"{lake.raw_root}/month={m}") for m in window.months)
    apart = stored >= len(window.months) * raw_csv.APART_BYTES
    rows = typed(raw_csv.scan(lake.spark, lake.raw_root, window, apart), F.col("month"), *flags)
    if len(window.months) > 1 and not apart:
        rows = rows.hint("rebalance", F.col(MONTH))
    start = F.col("trip_start_timestamp")
    inside = F.coalesce(F.col(MONTH) == F.col("month"), F.lit(False))
    alone = len(window.months) == 1  # then its digest needs no pass of its own
    seen = Observation()  # after the shuffle, if any: only there do retried tasks count once
    rows = rows.observe(
        seen,
        raw_csv.per_month(window, "raw"), raw_csv.per_month(window, "kept", inside),
        *(digests.aggregates("digest_", inside) if alone else []),
        F.count_if(inside).alias("kept_rows"),
        F.count_if(start.isNull()).alias("missing_start"),
        F.count_if(start.isNotNull() & ~inside).alias("other_month"),
        *[F.count_if(F.col(f"_bad_{name}")).alias(f"bad_{name}") for name in TYPED])
    lake.overwrite_months(rows.filter(inside), "bronze", window=window, cluster=(),
                          drop_missing=drop_empty, apart=apart)
    counts = seen.get
    if alone:  # a month without rows keeps what it has, or goes
        found = ({window.months[0]: digests.as_text(counts, "digest_")} if counts["kept_rows"]
                 else {})
    else:
        stored = lake.read_partitions("bronze", window)
        found = {row[MONTH]: row["digest"] for row in digests.by_month(stored).collect()}
    return {**counts, "digests": found, "raw_rows": raw_csv.of_months(window, "raw", counts),
            "kept": raw_csv.of_months(window, "kept", counts)}
