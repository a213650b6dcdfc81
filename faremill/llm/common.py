"""Helpers the text operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from faremill import storage

WORD = r"[^\x20\x09-\x0D]+"
BATCH_ROWS, BATCH_BYTES = 2000, 8 << 20
SMALL_ROWS = 100_000  # a table with at most this many narrow rows may be broadcast


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


_SCOPES: list[list[str]] = []  # of the driver; paths to delete at the end of each open scope


@contextmanager
def scratch(spark: SparkSession):
    """Deletes what ``stored`` wrote in the block when it ends. Frames that read it must have been
    written elsewhere by then."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for path in _SCOPES.pop():
            storage.delete(spark, path)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Writes a table below the shared folder and reads it back: later plans start from files that
    survive lost executors, and read the same rows however often they run."""
    spark = df.sparkSession
    path = storage.working_folder(spark, purpose)
    if _SCOPES:
        _SCOPES[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, limit: int = SMALL_ROWS) -> DataFrame:
    """Hints a broadcast of a stored narrow table if its counted rows are within ``limit``; a larger
    one is left to a shuffled join, whose skewed partitions AQE splits."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def bounded_batches(df: DataFrame, most_bytes: int = BATCH_BYTES) -> DataFrame:
    """Lowers the session's Arrow batches to a size of which a Python task holds several copies
    without harm. Rows longer than that still pass, one to a batch. Plans run after the call that
    made them, so the setting stays."""
    conf = df.sparkSession.conf
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", most_bytes)):
        key = f"spark.sql.execution.arrow.{name}"
        now = int(conf.get(key).removesuffix("b"))
        if not 0 < now <= most:
            conf.set(key, str(most))
    return df


def column(name: str) -> Column:
    """A column by its whole name, also one with dots."""
    return F.col("`" + name.replace("`", "``") + "`")


def whole_row(df: DataFrame) -> Column:
    return F.struct(*map(column, df.columns))


def word_count(text: Column) -> Column:
    """Number of words; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """A non-null key in code point order with null last, so joins and windows share partitions."""
    return F.coalesce(F.concat(F.lit("0"), source.cast("string")), F.lit("1"))


def seeded_hash(seed: int, *columns: Column) -> Column:
    """60 uniform bits of a digest over the seed and the columns, as a long."""
    parts = [F.coalesce(c.cast("string"), F.lit("null")) for c in columns]
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *parts))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def hash_bucket(hashed: Column, buckets: Column) -> Column:
    """Cuts the hash range into equal parts, in the order of the hash."""
    return F.floor(hashed / F.lit(float(1 << 60)) * buckets).cast("long")


def map_texts(df: DataFrame, rows: Callable[..., Iterator[tuple]], schema: str) -> DataFrame:
    """Runs ``rows`` (a generator over lists of the columns of one Arrow batch) in each task."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        for batch in batches:
            made = list(rows(*(column.to_pylist() for column in batch.columns)))
            columns = list(zip(*made)) if made else [()] * len(arrow)
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, type=field.type) for values, field in zip(columns, arrow)],
                schema=arrow)

    return bounded_batches(df).mapInArrow(run, schema)


def finite(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) != F.lit(float("inf")))
