"""The BI cube: same reports as from trips, smallest groupings, months kept current."""

import itertools

import pytest

from conftest import SF, plan, rows
from faremill.lake import Lake
from faremill.operators.filters import Filters
from faremill.operators.windows import Window
from faremill.plans import bi, cube, gold, maintain, silver
from faremill.registry.workspace import workspace

FILTERS = [
    Filters(pickup_area=30), Filters(start="1996-02-10"), Filters(end="1997-06-30"),
    Filters(start="1996-02-29", end="1996-03-01"), Filters(start="1997-05-05", end="1996-01-01"),
    Filters(start="1996-01-15", end="1999-03-14", company="Brand#7", payment_type="Cash",
            day_type="weekday"),
    Filters(start="1996-01-15", end="1999-03-14", pickup_area=12, day_type="weekend"),
]


@pytest.fixture(scope="module")
def ws(spark):
    return workspace(spark, SF)


def reports(ws, filters):
    return {
        "summary": lambda t: bi.summary(t, filters),
        "daily": lambda t: bi.trips_daily(t, filters),
        "hours": lambda t: bi.trips_by_hour(t, filters),
        "company": lambda t: bi.trips_by_company(t, filters),
        "payment": lambda t: bi.payment_mix(t, filters),
        "routes": lambda t: bi.top_routes(t, ws.areas, filters),
        "areas": lambda t: bi.pickup_areas(t, ws.areas, filters),
    }


@pytest.mark.parametrize("filters", FILTERS, ids=str)
def test_reports_equal_those_from_trips_and_read_no_trips(ws, filters):
    for name, report in reports(ws, filters).items():
        from_cube = report(ws.cube())
        assert rows(from_cube) == rows(report(ws.silver)), name
        assert "silver" not in plan(from_cube), name


def test_options(ws):
    for query in (bi.date_range, lambda t: bi.options(t, "company"),
                  lambda t: bi.options(t, "payment_type"), lambda t: bi.area_options(t, ws.areas)):
        assert query(ws.cube()).collect() == query(ws.silver).collect()


def test_smallest_grouping_is_chosen(ws):
    opened = ws.cube()
    assert [g for g, _ in opened.plan(["company"])] == ["weekday_company"]
    assert [g for g, _ in opened.plan(["company"], Filters(pickup_area=3))] == ["weekday_choice"]
    assert [g for g, _ in opened.plan(["trip_date"])] == ["day"]
    whole = Filters(start="1996-02-01", end="1996-04-30")
    assert [g for g, _ in opened.plan(["payment_type"], whole)] == ["weekday_payment"]
    cut = Filters(start="1996-02-02", end="1996-04-29")
    assert [g for g, _ in opened.plan(["payment_type"], cut)] == ["weekday_payment", "day_choice"]
    short = Filters(start="1996-02-02", end="1996-03-29")
    assert [g for g, _ in opened.plan(["payment_type"], short)] == ["day_choice"]
    with pytest.raises(ValueError, match="taxi_id"):
        opened.choose(["taxi_id"])


def test_every_filter_and_key_is_covered(ws):
    keys = [[k if k != "day" else "trip_date" for k in spec.keys] for spec in gold.MARTS.values()]
    given = {"start": "1996-01-02", "company": "x", "payment_type": "y", "pickup_area": 1,
             "day_type": "weekend"}
    for n in range(len(given) + 1):
        for some in itertools.combinations(given, n):
            for columns in keys:
                assert ws.cube().plan(columns, Filters(**{k: given[k] for k in some}))


def test_plan_prunes_months(ws):
    text = plan(bi.trips_by_company(ws.cube(), Filters(start="1996-02-02", end="1996-04-29")))
    assert text.count("PartitionFilters: [isnotnull(trip_month") == 2


def test_state_from_the_cube_is_that_from_silver(ws):
    ws.cube()
    stored = cube.state(ws.lake)
    found = [stored, gold.state(ws.silver)]
    assert found[0].exceptAll(found[1].select(stored.columns)).count() == 0
    assert found[0].count() == found[1].count()


def months_of(lake: Lake, grouping: str):
    return lake.stored_months("gold", cube.table_name(grouping))


def test_refresh_follows_changed_new_and_gone_months(lake, trips):
    def load(*found):
        lake.overwrite_months(trips(*found), "bronze")

    def trip(n, day, fare):
        return {"trip_id": str(n), "trip_start_timestamp": f"{day}T08:00:00", "fare": fare,
                "trip_total": fare, "pickup_community_area": 8, "company": "A"}

    load(trip(1, "2023-01-05", 5.0), trip(2, "2023-02-06", 7.0))
    silver.load(lake, Window.of("2023-01", "2023-03"))
    with pytest.raises(ValueError, match="no cube"):
        cube.Cube(lake)
    cube.refresh(lake, Window.of("2023-02"))  # the other month has no cube yet: it is made too
    assert all(months_of(lake, g) == {"2023-01", "2023-02"} for g in cube.GROUPINGS)
    load(trip(2, "2023-02-06", 9.0), trip(3, "2023-02-07", 1.0))
    silver.load(lake, Window.of("2023-02"))
    cube.refresh(lake, Window.of("2023-02"))
    assert rows(bi.summary(cube.Cube(lake)))[0][:2] == (3, 15.0)
    lake.drop_month("silver", "2023-01")
    cube.refresh(lake, Window.of("2023-02"))
    assert all(months_of(lake, g) == {"2023-02"} for g in cube.GROUPINGS)
    done = {r.table_name: r.status for r in maintain.run(lake).collect()}
    assert done["gold.cube_day"] == "maintained"


def test_cube_of_nothing(lake):
    cube.refresh(lake)
    assert rows(bi.summary(cube.Cube(lake))) == [(0, 0.0, 0, 0.0, 0.0, 0.0)]
    assert bi.trips_daily(cube.Cube(lake), Filters(company="A")).count() == 0


def test_groupings_with_areas_are_written_without_shuffles_of_their_own(lake, trips, monkeypatch):
    found = [{"trip_id": str(n), "trip_start_timestamp": f"2023-0{n % 3 + 1}-"
              f"{n % 28 + 1:02d}T0{n % 9}:30:00",
              "fare": n / 4, "trip_total": n / 4, "company": f"C{n % 2}",
              "pickup_community_area": n % 5 or None, "dropoff_community_area": n % 7 or None}
             for n in range(400)]
    lake.overwrite_months(trips(*found, *found[:3]), "bronze")
    silver.load(lake, Window.of("2023-01", "2023-04"))
    shuffles, whole = {}, Lake.overwrite_months

    def noted(self, df, layer, table="taxi_trips", **more):
        whole(self, df, layer, table, **more)
        above, cached, _ = plan(df.select("*")).partition("InMemoryRelation")  # now it is filled
        shuffles[table] = "Exchange" in above or not cached or more.get("cluster") != ()

    monkeypatch.setattr(Lake, "overwrite_months", noted)
    monkeypatch.setattr(cube, "TASK_BYTES", 2000)
    cube.refresh(lake)
    small = {"weekday_company", "weekday_payment", "weekday_hours", "day"}
    assert {name for name in cube.GROUPINGS if shuffles[cube.table_name(name)]} == small
    for name, keys in cube.GROUPINGS.items():  # whole groups, one row each
        stored = lake.table("gold", cube.table_name(name))
        wanted = lake.table("silver").groupBy("trip_month", *keys).agg(*cube.S.partial())
        assert sorted(map(repr, stored.select(wanted.columns).collect())) == sorted(
            map(repr, wanted.collect())), name
