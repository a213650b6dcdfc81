import csv
import io
import json
import os
import random
import re
from urllib.error import HTTPError, URLError
from urllib.parse import parse_qs, urlparse

import pytest
from pyspark.sql import functions as F

from conftest import counts, plan, rows
from faremill import lake as lake_module
from faremill.operators.windows import Window
from faremill.plans import bronze
from faremill.schema import TRIP_COLUMNS
from faremill.sources import extract, pages as source, raw_csv

OCT, NOV, BOTH = Window.of("2023-10"), Window.of("2023-11"), Window.of("2023-10", "2023-12")


def trip(i, start, **more):
    return {"trip_id": f"t{i}", "trip_start_timestamp": start, "fare": "1.5", **more}


def october(n):
    return [trip(i, f"2023-10-{i % 28 + 1:02d}T10:00:00.000") for i in range(n)]


def parts_of(root, month):
    folder = f"{root}/month={month}"
    return [f"{folder}/{name}" for name in os.listdir(folder) if name.endswith(".csv")] \
        if os.path.isdir(folder) else []


def test_landing_pages_orders_and_replaces_months(raw_text, tmp_path):
    root = str(tmp_path / "raw")
    november = [trip(f"n{i}", "2023-11-05T00:00:00.000") for i in range(3)]
    outside = [trip("x", "2023-12-01T00:00:00.000"), trip("y", None)]
    landed = raw_csv.land(raw_text(*october(25), *november, *outside), root, BOTH, page_rows=10)
    assert landed == {"2023-10": 25, "2023-11": 3}
    for path in parts_of(root, "2023-10"):
        with open(path, newline="") as f:
            lines = list(csv.DictReader(f))
        assert len(lines) <= 10
        keys = [(line["trip_start_timestamp"], line["trip_id"]) for line in lines]
        assert keys == sorted(keys)
    # landing October again leaves November alone; landing nothing empties the month
    raw_csv.land(raw_text(*october(4)), root, OCT)
    scanned = raw_csv.scan(raw_text().sparkSession, root)
    assert dict(rows(scanned.groupBy("month").count())) == {"2023-10": 4, "2023-11": 3}
    assert raw_csv.land(raw_text(), root, NOV) == {"2023-11": 0}
    assert parts_of(root, "2023-11") == []


def test_text_survives_csv(raw_text, tmp_path, spark):
    odd = ['x "q" y', "line\nbreak", "comma, here", " spaced ", "back\\slash", '"', "", None]
    source = raw_text(*[trip(i, "2023-10-01T00:00:00.000", company=text)
                        for i, text in enumerate(odd)])
    root = str(tmp_path / "raw")
    raw_csv.land(source, root, OCT)
    scanned = raw_csv.scan(spark, root, OCT)
    assert {r["trip_id"]: r["company"] for r in scanned.collect()} == {
        f"t{i}": text or None for i, text in enumerate(odd)}  # an empty cell is NULL
    assert rows(extract.extract(spark, root, OCT).filter("company is not null"), "company") == \
        sorted((text,) for text in odd if text)
    assert rows(raw_csv.part_counts(scanned).groupBy("month").agg(F.sum("rows"))) == [
        ("2023-10", len(odd))]


def test_header_in_another_order_is_refused(spark, tmp_path):
    folder = tmp_path / "raw" / "month=2023-10"
    folder.mkdir(parents=True)
    names = [TRIP_COLUMNS[1], TRIP_COLUMNS[0], *TRIP_COLUMNS[2:]]
    (folder / "part.csv").write_text(",".join(names) + "\n" + ",".join("x" for _ in names) + "\n")
    with pytest.raises(Exception, match="(?i)header"):
        raw_csv.scan(spark, str(tmp_path / "raw")).collect()


def write_raw(lake, month, *records):
    folder = f"{lake.raw_root}/month={month}"
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/part-{len(os.listdir(folder)):05d}.csv", "w", newline="") as f:
        out = csv.DictWriter(f, TRIP_COLUMNS)
        out.writeheader()
        out.writerows(records)


@pytest.mark.parametrize("large_month", [0, 1 << 40])
def test_load_counts_and_drops(lake, monkeypatch, large_month):
    """The same result whether months are loaded one job each or together."""
    monkeypatch.setattr(lake_module, "LARGE_MONTH_BYTES", large_month)
    write_raw(lake, "2023-10",
              trip(1, "2023-10-05T00:00:00.000", trip_seconds="60"),
              trip(2, "2023-10-05 00:00:00"),                       # malformed start: dropped
              trip(3, "2023-11-05T00:00:00", fare="9"),             # another month: dropped
              trip(4, "2023-10-06T00:00:00", trip_seconds="12.0", fare="abc"),
              trip(5, ""))
    write_raw(lake, "2023-11", trip(6, "2023-11-01T00:00:00"))
    loaded = bronze.load(lake, BOTH)
    assert loaded.raw_rows == {"2023-10": 5, "2023-11": 1}
    assert (loaded.kept_rows, loaded.missing_start, loaded.other_month) == (3, 2, 1)
    assert loaded.bad_cells == {"trip_start_timestamp": 1, "trip_seconds": 1, "fare": 1}
    assert rows(lake.table("bronze"), "trip_id", "trip_seconds", "fare", "trip_month") == [
        ("t1", 60, 1.5, "2023-10"), ("t4", None, None, "2023-10"), ("t6", None, 1.5, "2023-11")]


@pytest.mark.parametrize("large_month", [0, 1 << 40])
def test_strict_load_fails_before_it_stores_anything(lake, monkeypatch, large_month):
    monkeypatch.setattr(lake_module, "LARGE_MONTH_BYTES", large_month)
    write_raw(lake, "2023-10", trip(1, "2023-10-05T00:00:00"))
    write_raw(lake, "2023-11", trip(2, "2023-11-05T00:00:00", fare="abc"))
    with pytest.raises(Exception, match="malformed cell in trip t2"):
        bronze.load(lake, BOTH, strict=True)
    assert lake.table("bronze").count() == 0
    assert bronze.load(lake, OCT, strict=True).kept == {"2023-10": 1}


def test_reload_is_idempotent_and_leaves_neighbours(lake):
    write_raw(lake, "2023-10", trip(1, "2023-10-05T00:00:00"))
    write_raw(lake, "2023-11", trip(2, "2023-11-05T00:00:00"))
    bronze.load(lake, BOTH)
    write_raw(lake, "2023-11", trip(3, "2023-11-06T00:00:00"))
    for _ in range(2):
        bronze.load(lake, NOV)
        assert counts(lake.table("bronze")) == {"2023-10": 1, "2023-11": 2}


def test_empty_month_keeps_or_drops(lake, trips):
    lake.overwrite_months(trips({"trip_id": "a", "trip_start_timestamp": "2023-10-05T00:00:00"},
                                {"trip_id": "b", "trip_start_timestamp": "2023-11-05T00:00:00"}),
                          "bronze")
    assert bronze.load(lake, NOV).raw_rows == {"2023-11": 0}
    assert counts(lake.table("bronze")) == {"2023-10": 1, "2023-11": 1}
    bronze.load(lake, NOV, drop_empty=True)
    assert counts(lake.table("bronze")) == {"2023-10": 1}


def test_one_month_load_has_no_shuffle(lake, raw_text):
    raw_csv.land(raw_text(*october(5)), lake.raw_root, OCT)
    typed = bronze.build(raw_csv.scan(lake.spark, lake.raw_root, OCT))
    assert "Exchange" not in plan(typed)


def test_paged_extract(spark, raw_text, tmp_path):
    root = str(tmp_path / "raw")
    november = [trip(f"n{i}", "2023-11-05T00:00:00.000", company='a "b",\nc') for i in range(3)]
    raw_csv.land(raw_text(*october(25), *november), root, BOTH, page_rows=10)
    assert extract.extract(spark, root, BOTH).count() == 28
    pages = extract.extract(spark, root, NOV)
    assert pages.columns == TRIP_COLUMNS
    assert rows(pages, "trip_id", "company", "fare", "tips") == [
        (f"tn{i}", 'a "b",\nc', "1.5", None) for i in range(3)]
    one_each = extract.extract(spark, root, OCT, pages_per_task=1)
    assert one_each.rdd.getNumPartitions() == len(parts_of(root, "2023-10")) >= 3
    assert extract.extract(spark, root, OCT).rdd.getNumPartitions() == 1
    assert one_each.count() == extract.extract(spark, root, OCT).count() == 25
    assert extract.extract(spark, root, Window.of("2022-01")).count() == 0
    assert extract.extract(spark, str(tmp_path / "nothing"), OCT).count() == 0


def test_a_page_without_a_column_is_an_error(spark, tmp_path):
    os.makedirs(tmp_path / "raw" / "month=2023-10")
    (tmp_path / "raw" / "month=2023-10" / "p.csv").write_text(
        ",".join("fare_amount" if c == "fare" else c for c in TRIP_COLUMNS) + "\n"
        + ",".join("2023-10-05T00:00:00" if c == "trip_start_timestamp" else "1"
                   for c in TRIP_COLUMNS) + "\n")
    with pytest.raises(Exception, match="fare"):
        extract.extract(spark, str(tmp_path / "raw"), OCT).collect()


class Table:
    """A dataset server in memory that understands the listings' parameters."""

    def __init__(self, rows, trouble=()):
        self.rows, self.trouble, self.asked, self.late = list(rows), list(trouble), [], []

    def __call__(self, request, timeout):
        self.asked.append(request)
        if self.trouble:
            raise self.trouble.pop()
        query = {k: v[0] for k, v in parse_qs(urlparse(request.full_url).query).items()}
        low, high = re.match(r"trip_start_timestamp >= '(.*?)' AND trip_start_timestamp < '(.*?)'",
                             query["$where"]).groups()
        found = [r for r in self.rows if low <= r[1] < high]
        if "count" in query["$select"]:
            return io.BytesIO(json.dumps([{"rows": str(len(found))}]).encode())
        assert query["$order"] == "trip_start_timestamp,trip_id" and query["$select"]
        with_id = "trip_id IS NOT NULL" in query["$where"]
        found = sorted((r for r in found if (r[0] is not None) == with_id),
                       key=lambda r: (r[1], r[0] or ""))
        after = re.search(r"\(trip_start_timestamp > '(.*?)' OR \(trip_start_timestamp = '\1' AND "
                          r"trip_id >= '(.*)'\)\)$", query["$where"])
        if after:
            found = [r for r in found if (r[1], r[0]) >= (after[1], after[2].replace("''", "'"))]
        again = re.search(r"NULL AND trip_start_timestamp >= '(.*?)'$", query["$where"])
        if again:
            found = [r for r in found if r[1] >= again[1]]
        first = int(query["$offset"])
        page = found[first:first + int(query["$limit"])]
        self.rows += self.late[:1]  # a row comes after every page
        del self.late[:1]
        return io.BytesIO(("trip_id,trip_start_timestamp\n" + "".join(
            f"{i or ''},{t}\n" for i, t in page)).encode())


def seeking(table, size="10", per_task="2", pauses=None):
    reader = source.PageReader(["trip_id", "trip_start_timestamp"], {
        "base": "https://example.org/trips", "start": "2023-10-01T00:00:00",
        "end": "2023-11-01T00:00:00", "pagesize": size, "pagespertask": per_task, "apptoken": "key"})
    reader.pages.dataset.get = lambda url, token: source.fetch(
        url, token, table, (pauses if pauses is not None else []).append)
    return reader


def read_all(reader):
    return [(i, t) for p in reader.partitions() for batch in reader.read(p)
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]


def by_text(found):
    return sorted(found, key=lambda r: (r[1], r[0] or "", r[0] is None))


def test_ranges_are_halved_and_busy_servers_asked_again():
    pauses = []
    table = Table([(f"t{i}", f"2023-10-{1 + i % 30:02d}T00:{i % 60:02d}:00") for i in range(95)],
                  [HTTPError("u", 429, "busy", None, None), URLError("down"),
                   HTTPError("u", 503, "later", None, None)])
    reader = seeking(table, pauses=pauses)
    spans = reader.partitions()
    assert pauses == [1, 2, 4] and len(spans) > 4
    assert spans[0].low == "2023-10-01T00:00:00" and spans[-1].high == "2023-11-01T00:00:00"
    assert all(a.high == b.low for a, b in zip(spans, spans[1:]))
    assert all(sum(s.low <= t < s.high for _, t in table.rows) <= 20 for s in spans)
    assert by_text(read_all(reader)) == by_text(table.rows)
    assert all(r.get_header("X-app-token") == "key" for r in table.asked)
    with pytest.raises(HTTPError):
        source.fetch("u://x", "", Table([], [HTTPError("u", 404, "none", None, None)]))
    with pytest.raises(URLError):
        source.fetch("u://x", "", Table([], [URLError("down")] * source.TRIES), pauses.append)


@pytest.mark.parametrize("size", [1, 2, 3, 7, 100])
def test_seeking_reads_every_row_once_whatever_the_ties(size):
    draw = random.Random(size)
    for _ in range(20):
        rows = [(draw.choice([None, "a", "b'c", "d"]), f"2023-10-0{draw.randint(1, 3)}T00:00:00")
                for _ in range(draw.randint(0, 40))]
        assert by_text(read_all(seeking(Table(rows), str(size), "1"))) == by_text(rows)


def test_rows_added_during_the_read_shift_no_page():
    rows = [(f"t{i:03d}", "2023-10-05T00:00:00") for i in range(50)]
    table = Table(rows)
    table.late = [("t000a", "2023-10-05T00:00:00"), ("new", "2023-10-01T00:00:00"),
                  ("t049a", "2023-10-05T00:00:00")]
    found = read_all(seeking(table, "10", "100"))
    assert sorted(found) == sorted([*rows, ("t049a", "2023-10-05T00:00:00")])


def test_pages_cost_the_same_wherever_they_are():
    table = Table([(f"t{i:03d}", "2023-10-05T00:00:00") for i in range(100)])
    read_all(seeking(table, "10", "100"))
    offsets = [int(parse_qs(urlparse(r.full_url).query).get("$offset", ["0"])[0])
               for r in table.asked]
    assert max(offsets) <= 1


def test_page_urls_are_stable_and_projected():
    listing = source.Listing("2023-10-01T00:00:00", "2023-11-01T00:00:00", limit=50000)
    url = source.Dataset("https://example.org/resource/trips", ["trip_id", "fare"]).url(listing)
    assert "%24select=trip_id%2Cfare" in url and "%24offset=0" in url
    assert "%24order=trip_start_timestamp%2Ctrip_id%2Cfare" in url and "%24limit=50000" in url
    assert "trip_start_timestamp+%3C+%272023-11-01T00%3A00%3A00%27" in url
