"""Order-independent digests of rows, to see whether a month holds the same trips as before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from faremill.schema import MONTH, TRIP_COLUMNS

_NULL = "\u0000"  # no text of a trip
_SUM = "decimal(38,0)"


def row_hash(columns=TRIP_COLUMNS) -> Column:
    """64 bits over the values and which of them are null; unlike a bare hash, a value that moves
    to a neighbouring null column changes it."""
    return F.xxhash64(*[F.coalesce(F.col(name).cast("string"), F.lit(_NULL)) for name in columns])


def aggregates(prefix: str = "", rows: Column | None = None, columns=TRIP_COLUMNS) -> list[Column]:
    """Mergeable parts of a digest of the rows for which ``rows`` holds. The exclusive-or alone
    would not see a row that came twice, the count not a changed one; both with the sum do."""
    chosen = row_hash(columns) if rows is None else F.when(rows, row_hash(columns))
    return [F.count(chosen).alias(f"{prefix}rows"), F.bit_xor(chosen).alias(f"{prefix}xor"),
            F.sum(chosen.cast(_SUM)).alias(f"{prefix}sum")]


def text(prefix: str = "") -> Column:
    parts = [F.col(f"{prefix}{name}") for name in ("rows", "xor", "sum")]
    return F.concat_ws(":", *[F.coalesce(part.cast("string"), F.lit("0")) for part in parts])


def as_text(parts: dict, prefix: str = "") -> str:
    """The same from collected aggregates."""
    return ":".join(str(parts[f"{prefix}{name}"] or 0) for name in ("rows", "xor", "sum"))


def by_month(trips: DataFrame, columns=TRIP_COLUMNS) -> DataFrame:
    """(trip_month, digest), combined map-side to one row per month and task."""
    return (trips.groupBy(MONTH).agg(*aggregates(columns=columns))
            .select(MONTH, text().alias("digest")))


def differing(found: DataFrame, known: DataFrame) -> DataFrame:
    """Months of ``found`` whose digest is not the known one."""
    before = known.withColumnRenamed("digest", "known")
    return (found.join(before, MONTH, "left")
            .filter(~F.col("digest").eqNullSafe(F.col("known"))).select(MONTH))
