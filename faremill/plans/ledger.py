"""Run ledgers: timed steps, materializations and check results, and reports over them."""

from __future__ import annotations

import time
import uuid
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import DataFrame, Window as W, functions as F

from faremill.functions.trip import moment, month_label, seconds_between
from faremill.lake import Lake, utc_now
from faremill.plans.checks import BRONZE, CHECK_DDL, GOLD, RAW, SILVER
from faremill.records import Records
from faremill.schema import MONTH

STEP_DDL = ("run_id string, step string, window string, status string, "
            "started_at timestamp_ntz, finished_at timestamp_ntz, elapsed_seconds double, "
            "counters map<string,string>, error string")
MATERIALIZATION_DDL = ("run_id string, asset string, window string, data_version string, "
                       "finished_at timestamp_ntz, metadata map<string,string>")
CHECK_RESULT_DDL = f"run_id string, {CHECK_DDL}, recorded_at timestamp_ntz"
_TABLES = {"step_runs": STEP_DDL, "materializations": MATERIALIZATION_DDL,
           "check_results": CHECK_RESULT_DDL}


def _text(values: dict) -> dict[str, str]:
    return {key: str(value) for key, value in values.items()}


class Ledger:
    """Appends records of one run below the lake's root."""

    def __init__(self, lake: Lake, run_id: str | None = None):
        self.lake, self.run_id = lake, run_id or uuid.uuid4().hex

    def records(self, table: str) -> Records:
        return Records(self.lake.spark, f"{self.lake.root}/ledger/{table}", _TABLES[table])

    def _append(self, table: str, row: tuple) -> None:
        self.records(table).append(self.lake.spark.createDataFrame([row], _TABLES[table]))

    def table(self, table: str) -> DataFrame:
        return self.records(table).read()

    def fold(self, at_least: int = 20) -> dict[str, int]:
        """Folds every ledger's small files into a snapshot; returns the files folded."""
        folded = {table: self.records(table).fold(at_least) for table in _TABLES}
        return folded | {"versions": self.lake.version_records.fold(at_least)}

    @contextmanager
    def step(self, name: str, window: str = "all"):
        """Times a stage; what the caller puts into the yielded dict is kept as counters."""
        started, clock, counters = utc_now(), time.monotonic(), {}

        def record(status: str, error: str | None) -> None:
            elapsed = round(time.monotonic() - clock, 1)
            self._append("step_runs", (self.run_id, name, window, status, started, utc_now(),
                                       elapsed, _text(counters), error))

        try:
            yield counters
        except Exception as problem:
            record("FAILED", str(problem))
            raise
        record("DONE", None)

    def materialized(self, asset: str, window: str, rows: int, **metadata) -> None:
        self._append("materializations", (self.run_id, asset, window, f"{window}:{rows}",
                                          utc_now(), _text({"rows": rows, **metadata})))

    def record(self, checks: DataFrame) -> DataFrame:
        """Stores check rows and returns the stored rows, so checks are evaluated once. They are an
        entry of their own: a gate reads no other rows, however long the ledger and its run are."""
        book = self.records("check_results")
        return book.entry(book.append(checks.select(
            F.lit(self.run_id).alias("run_id"), "*", moment(utc_now()).alias("recorded_at"))))


def latest(materializations: DataFrame, tie_break: str = "run_id") -> DataFrame:
    """The newest record of each asset. An aggregate of whole records sorts all that a task reads, so
    the newest times are found first, and only records of these times are aggregated."""
    columns = [name for name in materializations.columns if name != "asset"]
    times = materializations.groupBy(F.col("asset").alias("_asset")).agg(
        F.max("finished_at").alias("_newest"))
    last = materializations.join(times, F.col("asset").eqNullSafe(F.col("_asset"))
                                 & F.col("finished_at").eqNullSafe(F.col("_newest")))
    newest = F.max_by(F.struct(*columns), F.struct("finished_at", tie_break))
    return last.groupBy("asset").agg(newest.alias("r")).select("asset", "r.*")


DIGEST = "digest "  # metadata key of a month's digest, followed by the month


def month_digests(materializations: DataFrame, asset: str) -> DataFrame:
    """(trip_month, digest) of each month's newest load of the asset."""
    entries = (materializations.filter(F.col("asset") == asset)
               .select("finished_at", "run_id", F.explode("metadata").alias("name", "digest"))
               .filter(F.startswith("name", F.lit(DIGEST))))
    return entries.groupBy(F.substring("name", len(DIGEST) + 1, 7).alias(MONTH)).agg(
        F.max_by("digest", F.struct("finished_at", "run_id")).alias("digest"))


def by_month(records: DataFrame) -> DataFrame:
    """A record per month of its window ("2023-10", or "2023-10..2023-12"); other windows, like
    "all", belong to no month."""
    first, last = (F.to_date(F.concat(part, F.lit("-01"))) for part in (
        F.substring("window", 1, 7), F.substring("window", -7, 7)))
    months = F.sequence(first, last, F.expr("interval 1 month"))
    return (records.filter(F.rlike("window", F.lit(r"^\d{4}-\d{2}(\.\.\d{4}-\d{2})?$")))
            .select("*", F.explode(months).alias("_day"))
            .withColumn(MONTH, month_label(F.col("_day"))).drop("_day"))


def month_status(planned: DataFrame, materializations: DataFrame, checks: DataFrame,
                 steps: DataFrame, source: str, asset: str) -> DataFrame:
    """(trip_month, status) of every planned month: ``failed`` if an attempt failed after the asset
    was last loaded, else ``missing`` if it never was, ``stale`` if its source was loaded later, or
    ``loaded``. A failed attempt is a failed step or a blocking check that did not pass."""
    def newest(records, name, at):
        return by_month(records).groupBy(MONTH).agg(F.max(at).alias(name))

    loads = materializations.select("asset", "window", "finished_at")
    done = newest(loads.filter(F.col("asset") == asset), "done", "finished_at")
    fed = newest(loads.filter(F.col("asset") == source), "fed", "finished_at")
    broken = steps.filter(F.col("status") == "FAILED").select("window", "finished_at").unionByName(
        checks.filter((F.col("severity") == "ERROR") & ~F.col("passed"))
        .select("window", F.col("recorded_at").alias("finished_at")))
    failed = newest(broken, "failed", "finished_at")
    at = F.col("done")
    status = (F.when(F.col("failed").isNotNull() & (at.isNull() | (F.col("failed") >= at)), "failed")
              .when(at.isNull(), "missing").when(F.col("fed") > at, "stale").otherwise("loaded"))
    joined = planned.select(MONTH)
    for side in (done, fed, failed):
        joined = joined.join(side, MONTH, "left")
    return joined.select(MONTH, status.alias("status"))


def month_ranges(status: DataFrame) -> DataFrame:
    """Gaps and islands: (status, first_month, last_month, months) of neighbouring months of one
    status, but for loaded ones. The windows see one row per planned month."""
    number = F.substring(MONTH, 1, 4).cast("int") * 12 + F.substring(MONTH, 6, 2).cast("int")
    place = F.row_number().over(W.partitionBy("status").orderBy(MONTH))
    return (status.filter(F.col("status") != "loaded").withColumn("_island", number - place)
            .groupBy("status", "_island")
            .agg(F.min(MONTH).alias("first_month"), F.max(MONTH).alias("last_month"),
                 F.count("*").alias("months")).drop("_island"))


def freshness(materializations: DataFrame, now: datetime, hours: int) -> DataFrame:
    """WARN check per asset: was it last rebuilt at most ``hours`` ago?"""
    last = F.col("last_finished")
    age = seconds_between(last, moment(now))
    return (materializations.groupBy("asset").agg(F.max("finished_at").alias("last_finished"))
            .select("asset", F.lit("all").alias("window"), F.lit("freshness").alias("check_name"),
                    F.lit("WARN").alias("severity"), (age <= hours * 3600).alias("passed"),
                    age.cast("double").alias("observed"),
                    F.create_map(F.lit("last_finished"), last.cast("string"))
                    .alias("metadata")))


# Steps by the asset they make.
STEP_ASSETS = {"raw.land": RAW, "bronze.load": BRONZE, "silver.load": SILVER,
               "gold.rebuild": GOLD, "gold.publish": GOLD}


def attempts(checks: DataFrame, steps: DataFrame, materializations: DataFrame) -> DataFrame:
    """(asset, window, at, run_id, failure) of every try to load an asset's window: failure is what
    broke it, or null for a materialization. A run's blocking checks are one failure. A
    materialization that a blocking check of the same run rejects is no success."""
    step = F.col("step")
    asset = F.coalesce(*[F.when(step == name, F.lit(value)) for name, value in STEP_ASSETS.items()],
                       step)
    rejected = (checks.filter((F.col("severity") == "ERROR") & ~F.col("passed"))
                .groupBy("asset", "window", "run_id")
                .agg(F.max("recorded_at").alias("at"),
                     F.concat_ws(",", F.sort_array(F.collect_set("check_name"))).alias("failure")))
    broken = steps.filter(F.col("status") == "FAILED").select(
        asset.alias("asset"), "window", "run_id", F.col("finished_at").alias("at"),
        F.concat(F.lit("step "), step).alias("failure"))
    loaded = materializations.select(
        "asset", "window", "run_id", F.col("finished_at").alias("at"),
        F.lit(None).cast("string").alias("failure")).join(
            rejected.select("asset", "window", "run_id"), ["asset", "window", "run_id"], "left_anti")
    return rejected.unionByName(broken).unionByName(loaded)


def failure_streaks(attempts: DataFrame) -> DataFrame:
    """Every failure with the last success of its asset and window as of then, and how many failures
    stand in a row since (itself included). Successes are as-of joined by one sort of the attempts
    of an asset's window."""
    in_time = W.partitionBy("asset", "window").orderBy("at", F.col("failure").isNotNull(), "run_id")
    so_far = in_time.rowsBetween(W.unboundedPreceding, W.currentRow)
    works = F.col("failure").isNull()
    seen = (attempts.withColumn("last_success", F.max(F.when(works, F.col("at"))).over(so_far))
            .withColumn("_successes", F.count_if(works).over(so_far)))
    streak = W.partitionBy("asset", "window", "_successes").orderBy("at", "run_id")
    return (seen.filter(~works).withColumn("streak", F.row_number().over(streak))
            .select("asset", "window", "run_id", "at", "failure", "last_success", "streak"))


def standing(attempts: DataFrame) -> DataFrame:
    """Per asset and window: tries, failures, last success, and the failures since (0: it works)."""
    last = F.max(F.when(F.col("failure").isNull(), F.col("at")))
    successes = attempts.groupBy("asset", "window").agg(
        F.count("*").alias("tries"), F.count("failure").alias("failures"),
        last.alias("last_success"))
    since = attempts.filter(F.col("failure").isNotNull()).join(
        successes.select("asset", "window", "last_success"), ["asset", "window"]).filter(
        F.col("last_success").isNull() | (F.col("at") >= F.col("last_success")))
    open_now = since.groupBy("asset", "window").agg(F.count("*").alias("failing"))
    return (successes.join(open_now, ["asset", "window"], "left")
            .withColumn("failing", F.coalesce("failing", F.lit(0).cast("bigint"))))


def alarms(checks: DataFrame, steps: DataFrame) -> DataFrame:
    """What made runs fail: blocking check failures and failed steps, one row each."""
    blocking = checks.filter((F.col("severity") == "ERROR") & ~F.col("passed")).select(
        "run_id", "window", F.lit("check").alias("kind"),
        F.concat_ws(":", "asset", "check_name").alias("name"),
        F.when(F.size("metadata") > 0, F.to_json("metadata"))
        .otherwise(F.lit("blocking check failed")).alias("detail"))
    failed = steps.filter(F.col("status") == "FAILED").select(
        "run_id", "window", F.lit("step").alias("kind"), F.col("step").alias("name"),
        F.coalesce("error", F.lit("step failed")).alias("detail"))
    return blocking.unionByName(failed)
