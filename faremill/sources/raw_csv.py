"""The raw layer: text CSV parts under month=YYYY-MM directories."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from faremill import storage
from faremill.operators.windows import Window
from faremill.schema import RAW, TRIP_COLUMNS
from faremill.session import setting, small_scans, task_bytes

TASK_BYTES = 32 << 20  # shuffled rows that a task sorts and lands
APART_BYTES = 32 << 20  # stored text of a month from which a scan's tasks are worth being its own
PAGE_ROWS = 50_000  # fixed value: most rows per source page and per raw part

# RFC 4180 text: doubled quotes, quoted line breaks, spaces kept. A file is then not splittable,
# which is fine for parts of PAGE_ROWS rows.
_QUOTING = {"header": True, "quote": '"', "escape": '"',
            "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
_SCHEMA = T.StructType([*RAW.fields, T.StructField("month", T.StringType())])


def scan(spark: SparkSession, root: str, window: Window | None = None,
         apart: bool = False) -> DataFrame:
    """All-string trip columns plus ``month``. Headers are verified against the schema, so parts
    with another column order fail instead of being misread. Only the window's month directories
    are listed; missing ones read as empty. A task of months ``apart`` reads one month only."""
    paths = [root] if window is None else [f"{root}/month={month}" for month in window.months]
    paths = [path for path in paths if storage.exists(spark, path)]
    if not paths:
        return spark.createDataFrame([], _SCHEMA)
    read = spark.read.schema(_SCHEMA).options(**_QUOTING, multiLine=True, enforceSchema=False,
                                              basePath=root)
    return reduce(DataFrame.union, map(read.csv, paths)) if apart else read.csv(paths)


MOST_MONTHS = 7_500  # of a window; more than six centuries


def per_month(window: Window, name: str, counted: Column | None = None) -> Column:
    """Observed counts of each month's rows, as one aggregate: a map of counts per task, whatever
    the number of months. Spark's top-k sketch is exact while it holds fewer items than it tracks."""
    if len(window.months) > MOST_MONTHS:
        raise ValueError(f"{window.label} has over {MOST_MONTHS} months")
    month = F.col("month") if counted is None else F.when(counted, F.col("month"))
    return F.call_function("approx_top_k", month, F.lit(len(window.months) + 1),  # null is an item
                           F.lit(MOST_MONTHS * 4 // 3)).alias(name)


def of_months(window: Window, name: str, seen: dict) -> dict[str, int]:
    found = {row["item"]: row["count"] for row in seen[name] or ()}
    return {month: found.get(month, 0) for month in window.months}


def part_counts(raw: DataFrame) -> DataFrame:
    """Data rows per raw part file; quoted line breaks do not count as rows."""
    return raw.groupBy("month", F.col("_metadata.file_path").alias("part")).agg(
        F.count("*").alias("rows"))


def part_ranges(raw: DataFrame) -> DataFrame:
    """First and last start time of each raw part file, and its rows with one."""
    ts = F.col("trip_start_timestamp")
    return raw.groupBy(F.col("_metadata.file_path").alias("part")).agg(
        F.min(ts).alias("first"), F.max(ts).alias("last"), F.count(ts).alias("rows"))


def land(source: DataFrame, root: str, window: Window, page_rows: int = PAGE_ROWS,
         gathered: bool = False, compression: str = "none") -> dict[str, int]:
    """Replace the raw parts of every month of ``window`` with the source rows in it; returns the
    rows per month.

    Rows are clustered by month and ordered inside each part. The rebalance lets AQE split a
    month that is far larger than the others over several tasks and merge small ones. A source
    whose tasks hold few months each, like a stored table, is ``gathered`` and not shuffled; its tasks
    then read as little as they can sort in memory. Parts may be stored with a ``compression`` that
    readers tell from the file name (gzip); they are read whole by one task in any case."""
    spark = source.sparkSession
    lo, hi = (day.strftime("%Y-%m-%dT%H:%M:%S") for day in (window.start, window.end))
    ts = F.col("trip_start_timestamp")
    rows = (source.filter((ts >= lo) & (ts < hi))
            .select(*TRIP_COLUMNS, F.substring(ts, 1, 7).alias("month")))
    landed = Observation()
    # observed after the last shuffle: only there do retried tasks count once
    with small_scans(spark) if gathered else setting(
            spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes",
            str(task_bytes(source, TASK_BYTES))):
        ((rows if gathered else rows.hint("rebalance", F.col("month")))
         .sortWithinPartitions("month", "trip_start_timestamp", "trip_id")
         .observe(landed, per_month(window, "rows"))
         .write.partitionBy("month").mode("overwrite")
         .options(**_QUOTING, maxRecordsPerFile=page_rows, partitionOverwriteMode="dynamic",
                  compression=compression)
         .csv(root))
    found = of_months(window, "rows", landed.get)
    for month, rows in found.items():
        if not rows:
            storage.delete(spark, f"{root}/month={month}")
    return found
