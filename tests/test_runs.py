"""Digests and late corrections, missing months, record snapshots, failure streaks."""

from datetime import datetime, timedelta

import pytest

from conftest import at, counts, rows
from faremill import storage
from faremill.operators import digests, windows
from faremill.operators.windows import Window
from faremill.plans import checks, ledger, pipeline
from faremill.plans.ledger import Ledger
from faremill.records import HELD, Records
from faremill.registry import runs
from faremill.schema import MONTH
from faremill.sources import raw_csv

AUTUMN = Window.of("2023-09", "2023-12").split()


def trip(i, day, **more):
    return {"trip_id": f"t{i}", "trip_start_timestamp": f"{day}T10:00:00.000", "fare": "5.0",
            "trip_total": "6.5", "pickup_community_area": "8", **more}


def autumn():
    return [trip(i, f"2023-{9 + i % 3:02d}-{1 + i % 20:02d}") for i in range(60)]


# digests -----------------------------------------------------------------------------------------

def test_digests_see_every_change_but_the_order(spark, trips):
    def digest(*found):
        made = trips(*[{"trip_start_timestamp": "2023-10-01T00:00:00", **f} for f in found])
        return rows(digests.by_month(made.repartition(3)))[0][1]

    a, b = {"trip_id": "a", "fare": 1.0}, {"trip_id": "b", "fare": 2.0}
    whole = digest(a, b)
    assert digest(b, a) == whole
    others = [digest(a), digest(a, a, b), digest(a, b, b), digest(a, a, b, b), digest(a, a, a, b),
              digest({**a, "fare": 1.5}, b), digest({"trip_id": "a", "tips": 1.0}, b),
              digest({"taxi_id": "a", "fare": 1.0}, b), digest({**a, "fare": 2.0}, {**b, "fare": 1.0})]
    assert len({whole, *others}) == 1 + len(others)
    assert digest({**a, "company": None}, b) == whole


def test_one_month_and_joint_loads_record_the_same_digests(lake, raw_text):
    raw_csv.land(raw_text(*autumn()), lake.raw_root, Window.of("2023-09", "2023-12"))
    found = []
    for by_month in (True, False):
        book = Ledger(lake)
        for window in AUTUMN if by_month else [Window.of("2023-09", "2023-12")]:
            pipeline.load_bronze(lake, window, book)
        found.append(rows(ledger.month_digests(book.table("materializations"), checks.BRONZE)))
    assert found[0] == found[1] == rows(digests.by_month(lake.table("bronze")))
    assert [m for m, _ in found[0]] == ["2023-09", "2023-10", "2023-11"]


def test_only_changed_months_are_loaded_again(lake, raw_text):
    pipeline.backfill(lake, AUTUMN, raw_text(*autumn()))
    before = {m: storage.children(lake.spark, f"{lake.location('silver')}/{MONTH}={m}")
              for m in ("2023-10", "2023-11")}

    def reload(found):
        return [m.label for m in pipeline.reload_changed(lake, AUTUMN[1:], raw_text(*found))]

    assert reload(reversed(autumn())) == []
    corrected = [{**t, "fare": "9.0"} if t["trip_id"] == "t1" else t for t in autumn()]
    assert reload(corrected) == ["2023-10"]  # a count of rows would not see it
    assert rows(lake.table("silver").filter("fare = 9").select("trip_id")) == [("t1",)]
    assert storage.children(lake.spark, f"{lake.location('silver')}/{MONTH}=2023-11") == \
        before["2023-11"]
    assert reload(corrected) == []
    assert reload([*corrected, trip(99, "2023-11-30")]) == ["2023-11"]
    assert counts(lake.table("silver")) == {"2023-09": 20, "2023-10": 20, "2023-11": 21}
    assert reload([*corrected, trip(99, "2023-11-30"), trip(98, "2023-09-30")]) == []
    with pytest.raises(checks.GateError, match="rows_landed_positive"):
        reload([t for t in corrected if "2023-11" not in t["trip_start_timestamp"]])
    assert storage.children(lake.spark, f"{lake.root}/staging") == []


# months to load ----------------------------------------------------------------------------------

def status(spark, loads, failures=(), planned=None):
    months = windows.as_rows(spark, planned or Window.of("2023-01", "2024-01").split()).selectExpr(
        f"month as {MONTH}")
    made = spark.createDataFrame([(a, w, at(t)) for a, w, t in loads] or [],
                                 "asset string, window string, finished_at timestamp_ntz")
    none = spark.createDataFrame([], "window string, severity string, passed boolean, "
                                     "recorded_at timestamp_ntz")
    steps = spark.createDataFrame([(w, "FAILED", at(t)) for w, t in failures] or [],
                                  "window string, status string, finished_at timestamp_ntz")
    return ledger.month_status(months, made, none, steps, "b", "s")


def test_ranges_of_missing_stale_and_failed_months(spark):
    found = status(spark, [
        ("s", "2023-01..2023-04", "2024-01-02"), ("b", "2023-02..2023-03", "2024-01-03"),
        ("s", "2023-07", "2024-01-02"), ("b", "2023-07", "2024-01-01"), ("s", "all", "2024-02-01"),
        ("s", "2023-09", "2024-01-05"), ("b", "2023-12", "2024-01-01")],
        [("2023-09", "2024-01-04"), ("2023-10..2023-11", "2024-01-04"), ("2023-04", "2024-01-02")])
    assert dict(rows(found)) == {
        "2023-01": "loaded", "2023-02": "stale", "2023-03": "stale", "2023-04": "failed",
        "2023-05": "missing", "2023-06": "missing", "2023-07": "loaded", "2023-08": "missing",
        "2023-09": "loaded", "2023-10": "failed", "2023-11": "failed", "2023-12": "missing"}
    assert rows(ledger.month_ranges(found)) == [
        ("failed", "2023-04", "2023-04", 1), ("failed", "2023-10", "2023-11", 2),
        ("missing", "2023-05", "2023-06", 2), ("missing", "2023-08", "2023-08", 1),
        ("missing", "2023-12", "2023-12", 1), ("stale", "2023-02", "2023-03", 2)]
    assert rows(ledger.month_ranges(status(spark, [], planned=AUTUMN))) == [
        ("missing", "2023-09", "2023-11", 3)]


def test_ranges_cross_the_turn_of_the_year(spark):
    planned = Window.of("2022-11", "2023-03").split()
    assert rows(ledger.month_ranges(status(spark, [], planned=planned))) == [
        ("missing", "2022-11", "2023-02", 4)]


def test_backfill_of_what_is_missing(lake, raw_text):
    pipeline.backfill(lake, AUTUMN[:1], raw_text(*autumn()))
    assert rows(pipeline.unloaded(lake, AUTUMN)) == [("missing", "2023-10", "2023-11", 2)]
    with pytest.raises(checks.GateError):  # the source lacks a month
        pipeline.backfill_missing(lake, AUTUMN, raw_text(
            *[t for t in autumn() if "2023-11" not in t["trip_start_timestamp"]]))
    assert rows(pipeline.unloaded(lake, AUTUMN)) == [("failed", "2023-11", "2023-11", 1)]
    done = pipeline.backfill_missing(lake, AUTUMN, raw_text(*autumn()))
    assert [m.label for m in done] == ["2023-11"]
    pipeline.load_bronze(lake, AUTUMN[1], Ledger(lake))
    assert rows(pipeline.unloaded(lake, AUTUMN)) == [("stale", "2023-10", "2023-10", 1)]
    pipeline.load_silver(lake, AUTUMN[1], Ledger(lake))
    assert pipeline.backfill_missing(lake, AUTUMN, raw_text(*autumn())) == []


# snapshots ---------------------------------------------------------------------------------------

@pytest.fixture
def book(spark, tmp_path):
    return Records(spark, str(tmp_path / "records"), "n bigint, text string")


def put(book, *numbers):
    return [book.append(book.spark.createDataFrame([(n, f"r{n}")], book.ddl)) for n in numbers]


def numbers(book):
    return [n for n, _ in rows(book.read())]


def test_folds_bound_the_files_and_lose_nothing(book):
    assert numbers(book) == [] and book.fold() == 0
    put(book, *range(7))
    assert book.fold(at_least=8) == 0 and book.entries() == 7
    assert book.fold(at_least=7) == 7 and numbers(book) == list(range(7)) and book.entries() == 0
    first = storage.children(book.spark, book.path)
    assert len(first) == 1
    location = put(book, 7, 8, 9)[-1]
    assert rows(book.entry(location)) == [(9, "r9")] and numbers(book) == list(range(10))
    assert book.fold(at_least=3) == 3 and numbers(book) == list(range(10))
    assert len(storage.children(book.spark, book.path)) == 1


def test_a_fold_that_breaks_off_counts_nothing_twice(book, monkeypatch):
    put(book, 1, 2, 3)
    delete, gone = storage.delete, []
    monkeypatch.setattr(storage, "delete", lambda spark, path: gone.append(path))
    book.fold(at_least=1)  # in place, but nothing deleted
    assert len(gone) == 3 and numbers(book) == [1, 2, 3] and book.entries() == 0
    monkeypatch.setattr(storage, "delete", delete)
    put(book, 4)
    monkeypatch.setattr(storage, "rename", lambda *args: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):  # not in place
        book.fold(at_least=1)
    assert numbers(book) == [1, 2, 3, 4]
    monkeypatch.undo()
    assert book.fold(at_least=1) == 1 and numbers(book) == [1, 2, 3, 4]
    assert not [n for n in storage.children(book.spark, book.path) if n.startswith("entry=")]


def test_an_entry_that_is_being_written_is_not_folded(book):
    put(book, 1, 2)
    open_entry = put(book, 3)[0]
    storage.delete(book.spark, f"{open_entry}/_SUCCESS")
    assert book.fold(at_least=2) == 2 and numbers(book) == [1, 2, 3] and book.entries() == 1
    held = storage.read_text(book.spark, f"{book.path}/"
                             f"{[n for n in storage.children(book.spark, book.path) if 'snap' in n][0]}"
                             f"/{HELD}")
    assert open_entry.rsplit("/", 1)[1] not in held


def test_maintenance_folds_the_ledgers(lake, raw_text, spark):
    for _ in range(3):
        pipeline.backfill(lake, AUTUMN[:1], raw_text(*autumn()), by_month=True)
    book = Ledger(lake)
    before = [rows(book.table(t).select("run_id")) for t in
              ("step_runs", "materializations", "check_results")]
    alarms = rows(pipeline.alarms(book))
    assert book.fold(at_least=3)["step_runs"] == 9
    assert [rows(book.table(t).select("run_id")) for t in
            ("step_runs", "materializations", "check_results")] == before
    assert rows(pipeline.alarms(book)) == alarms
    assert len(storage.children(spark, f"{lake.root}/ledger/check_results")) == 1


def test_the_registered_ledger_folds_twice(spark, tmp_path, monkeypatch):
    spark.createDataFrame(
        [(i, at(f"2024-01-{1 + i % 28:02d}"), "abc"[i % 3]) for i in range(96)],
        "event_id bigint, ts timestamp_ntz, event_type string").write.parquet(
            str(tmp_path / "events.parquet"))
    fold, folded = Records.fold, []

    def counted(book, *args, **more):
        folded.append((fold(book, *args, **more), book.entries()))
        return folded[-1][0]

    monkeypatch.setattr(Records, "fold", counted)
    found = rows(runs.ledger_fold(spark, str(tmp_path)))
    assert folded == [(16, 0), (8, 0)]
    assert [row[2:] for row in found] == [(96, 96, 0)] * 3


# streaks -----------------------------------------------------------------------------------------

def tried(spark, *events):
    start = datetime(2024, 1, 1)
    return spark.createDataFrame(
        [(a, w, start + timedelta(hours=h), f"r{h}", f) for a, w, h, f in events],
        "asset string, window string, at timestamp_ntz, run_id string, failure string")


def test_streaks_since_the_last_success(spark):
    attempts = tried(
        spark, ("a", "m1", 1, "x"), ("a", "m1", 2, "y"), ("a", "m1", 3, None), ("a", "m1", 4, "z"),
        ("a", "m2", 1, None), ("b", "m1", 2, None), ("b", "m1", 2, "late"), ("b", "m1", 5, "again"),
        ("c", "m1", 9, "never"))
    got = {(r.asset, r.window, r.failure): (r.last_success and r.last_success.hour, r.streak)
           for r in ledger.failure_streaks(attempts).collect()}
    assert got == {("a", "m1", "x"): (None, 1), ("a", "m1", "y"): (None, 2), ("a", "m1", "z"): (3, 1),
                   ("b", "m1", "late"): (2, 1), ("b", "m1", "again"): (2, 2),
                   ("c", "m1", "never"): (None, 1)}
    assert {(r.asset, r.window): (r.tries, r.failures, r.failing)
            for r in ledger.standing(attempts).collect()} == {
        ("a", "m1"): (4, 3, 1), ("a", "m2"): (1, 0, 0), ("b", "m1"): (3, 2, 2),
        ("c", "m1"): (1, 1, 1)}


def test_rejected_loads_are_failures_of_the_run(lake, raw_text):
    broken = raw_text(*[t for t in autumn() if "2023-10" not in t["trip_start_timestamp"]])
    for _ in range(2):
        with pytest.raises(checks.GateError):
            pipeline.backfill(lake, AUTUMN[:2], broken, by_month=True)
    pipeline.backfill(lake, AUTUMN[:2], raw_text(*autumn()), by_month=True)
    with pytest.raises(checks.GateError):
        pipeline.backfill(lake, AUTUMN[1:2], broken)
    found = sorted((r.at, r.asset, r.window, r.failure, r.last_success is None, r.streak)
                   for r in pipeline.failures(Ledger(lake)).collect())
    assert [f[1:] for f in found] == [
        (checks.RAW, "2023-10", "rows_landed_positive", True, 1),
        (checks.RAW, "2023-10", "rows_landed_positive", True, 2),
        (checks.RAW, "2023-10", "rows_landed_positive", False, 1)]


# counters ----------------------------------------------------------------------------------------

def test_counts_of_many_months_are_one_aggregate(spark):
    long = Window.of("1900-01", "2024-01")
    assert len(long.months) > 1400
    counted = raw_csv.per_month(long, "rows")
    months = spark.createDataFrame([(m,) for m in long.months for _ in range(2)] + [("other",)],
                                   "month string")
    seen = months.filter("month <> 'other'").agg(
        counted, raw_csv.per_month(long, "even", months.month.endswith("2"))).first().asDict()
    assert set(raw_csv.of_months(long, "rows", seen).values()) == {2}
    even = raw_csv.of_months(long, "even", seen)
    assert {m for m, n in even.items() if n} == {m for m in long.months if m.endswith("2")}
    with pytest.raises(ValueError, match="months"):
        raw_csv.per_month(Window.of("1000-01", "2024-01"), "rows")
