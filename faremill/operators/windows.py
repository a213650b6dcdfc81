"""Month windows: half-open [start, end) ranges that runs load, and their planning."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from faremill.functions.trip import moment
from faremill.schema import MONTH


def _month_start(text: str) -> datetime:
    day = datetime.fromisoformat(text if len(text) > 7 else f"{text}-01")
    if day != datetime(day.year, day.month, 1):
        raise ValueError(f"not the start of a month: {text}")
    return day


def _next_month(day: datetime) -> datetime:
    return datetime(day.year + day.month // 12, day.month % 12 + 1, 1)


@dataclass(frozen=True)
class Window:
    """Whole months from ``start`` (inclusive) to ``end`` (exclusive)."""

    start: datetime
    end: datetime

    @classmethod
    def of(cls, start: str, end: str | None = None) -> "Window":
        """From ISO text, "2023-10" or "2023-10-01T00:00:00"; one month unless ``end`` is given."""
        first = _month_start(start)
        last = _month_start(end) if end else _next_month(first)
        if last <= first:
            raise ValueError(f"empty window: {start}..{end}")
        return cls(first, last)

    @property
    def months(self) -> list[str]:
        labels, day = [], self.start
        while day < self.end:
            labels.append(day.strftime("%Y-%m"))
            day = _next_month(day)
        return labels

    @property
    def label(self) -> str:
        months = self.months
        return months[0] if len(months) == 1 else f"{months[0]}..{months[-1]}"

    def split(self) -> list["Window"]:
        return [Window.of(month) for month in self.months]

    def contains(self, ts: Column) -> Column:
        return (ts >= moment(self.start)) & (ts < moment(self.end))

    def partitions(self) -> Column:
        """The same range on the partition column, which prunes directories."""
        return F.col(MONTH).between(self.months[0], self.months[-1])


def in_window(df: DataFrame, window: Window, column: str = "trip_start_timestamp") -> DataFrame:
    if MONTH in df.columns:
        df = df.filter(window.partitions())
    return df.filter(window.contains(F.col(column)))


def backfill(start: str, end: str | None, as_of: datetime) -> list[Window]:
    """Every completed month from ``start`` up to ``end`` (exclusive) or ``as_of``."""
    first = Window.of(start).start
    limit = datetime(as_of.year, as_of.month, 1)
    if end:
        limit = min(limit, Window.of(end).start)
    return Window(first, limit).split() if first < limit else []


def delta(planned: list[Window]) -> list[Window]:
    return planned[-1:]


def lookback(planned: list[Window], months: int = 2) -> list[Window]:
    return planned[-months:]


def as_rows(spark: SparkSession, planned: list[Window]) -> DataFrame:
    """Planned months as rows: month, window_start, window_end."""
    return spark.createDataFrame(
        [(month.label, month.start, month.end) for window in planned for month in window.split()],
        "month string, window_start timestamp_ntz, window_end timestamp_ntz")


def spans(months: list[Window]) -> list[Window]:
    """Runs of months that follow each other without a gap."""
    found: list[Window] = []
    for month in months:
        if found and found[-1].end == month.start:
            found[-1] = Window(found[-1].start, month.end)
        else:
            found.append(month)
    return found


def plan_months(events: DataFrame, column: str) -> DataFrame:
    """One row per month of the span covered by ``column``: month, start, end."""
    span = events.agg(F.trunc(F.min(column).cast("date"), "month").alias("lo"),
                      F.trunc(F.max(column).cast("date"), "month").alias("hi"))
    return (span.filter(F.col("lo").isNotNull())
            .select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 month"))).alias("day"))
            .select(F.substring(F.col("day").cast("string"), 1, 7).alias("month"),
                    F.col("day").cast("timestamp_ntz").alias("window_start"),
                    F.add_months("day", 1).cast("timestamp_ntz").alias("window_end")))


def last_planned(plan: DataFrame, months: int) -> DataFrame:
    return plan.orderBy(F.desc("window_start")).limit(months)
