import pytest
from pyspark.sql import functions as F

from faremill.functions import parse, trip
from faremill.functions.fixed_point import amount, mean, sum_units


@pytest.mark.parametrize("text, good", [
    ("2023-11-01T00:15:00.000", True), ("2023-11-01T00:15:00", True),
    ("2023-11-01 00:15:00", False), ("2023-11-01T00:15:00.0000", False),
    ("2023-13-01T00:15:00", False), ("2023-11-01", False), ("x", False), ("", False),
    ("2023-11-01T00:15:00.000\n", False), ("2023-11-01T00:15:00Z", False), (None, False)])
def test_timestamp_text(spark, text, good):
    df = spark.createDataFrame([(text,)], "trip_start_timestamp string")
    row = df.select(parse.cell("trip_start_timestamp").alias("v"),
                    parse.is_bad("trip_start_timestamp").alias("bad")).first()
    assert (row["v"] is not None) == good
    assert row["bad"] == (not good and text not in (None, ""))


def test_timestamp_does_not_depend_on_the_session_zone(spark):
    """02:30 does not exist on this day in New York; a zone-less value keeps it."""
    df = spark.createDataFrame([("2023-03-12T02:30:00.000",)], "trip_start_timestamp string")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        value = df.select(parse.cell("trip_start_timestamp").cast("string")).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert value == "2023-03-12 02:30:00"


@pytest.mark.parametrize("text, whole, real, bad_whole, bad_real", [
    ("12", 12, 12.0, False, False), ("12.0", None, 12.0, True, False),
    ("abc", None, None, True, True), ("", None, None, False, False),
    (" 5 ", 5, 5.0, False, False), ("NaN", None, None, True, True),
    ("Infinity", None, None, True, True), (None, None, None, False, False),
    ("-1", -1, -1.0, False, False)])
def test_numbers(spark, text, whole, real, bad_whole, bad_real):
    df = spark.createDataFrame([(text, text)], "trip_seconds string, fare string")
    row = df.select(parse.cell("trip_seconds"), parse.cell("fare"),
                    parse.is_bad("trip_seconds"), parse.is_bad("fare")).first()
    assert tuple(row) == (whole, real, bad_whole, bad_real)


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("pickup, dropoff, expected", [
    (76, None, True), (None, 56, True), (None, 1, None), (1, None, None), (1, 2, False),
    (None, None, None), (56, 76, True)])
def test_airport_is_three_valued(spark, pickup, dropoff, expected):
    found = value(spark, trip.touches_airport(F.lit(pickup).cast("int"),
                                              F.lit(dropoff).cast("int")))
    assert found is expected


def test_metrics(spark):
    def num(x):
        return F.lit(x).cast("double")

    assert value(spark, trip.duration_min(F.lit(100))) == 1.67
    assert value(spark, trip.speed_mph(num(10), F.lit(1800))) == 20.0
    assert value(spark, trip.speed_mph(num(10), F.lit(0))) is None
    assert value(spark, trip.speed_mph(num(None), F.lit(60))) is None
    assert value(spark, trip.tip_fraction(num(2), num(10))) == 0.2
    assert value(spark, trip.tip_fraction(num(2), num(0))) is None
    assert value(spark, trip.tip_fraction(num(2), num(-5))) is None
    assert value(spark, trip.tip_fraction(num(None), num(5))) is None
    assert value(spark, trip.non_negative(F.lit(-1))) is None
    assert value(spark, trip.non_negative(F.lit(0))) == 0


def test_month_label_and_names(spark):
    assert value(spark, trip.month_label(F.lit("2023-10-31").cast("date"))) == "2023-10"
    assert value(spark, trip.area_label(F.lit(None).cast("string"), F.lit(5))) == "Area 5"
    assert value(spark, trip.area_label(F.lit(""), F.lit(5))) == "Area 5"
    assert value(spark, trip.area_label(F.lit("Centre"), F.lit(5))) == "Centre"
    assert value(spark, trip.or_unknown(F.lit(None).cast("string"))) == "Unknown"


@pytest.mark.parametrize("expected, actual, gap", [
    (100, 95, 0.05), (0, 0, 0.0), (0, 3, 1.0), (-10, -5, 0.5)])
def test_relative_gap(spark, expected, actual, gap):
    assert value(spark, trip.relative_gap(F.lit(expected), F.lit(actual))) == gap


def test_sums_are_exact_in_any_order(spark):
    values = [0.1, 0.2, 0.3, 1e9, -1e9, 7.77, None] * 1000
    df = spark.createDataFrame([(v,) for v in values], "x double")
    want = round(1000 * (0.1 + 0.2 + 0.3 + 7.77), 2)
    for parts in (1, 7, 64):
        row = df.repartition(parts).agg(
            amount(sum_units("x")).alias("s"),
            mean(sum_units("x"), F.count("x"), 4).alias("m")).first()
        assert (row["s"], row["m"]) == (want, round(want / 6000, 4))
    empty = df.filter("x is null").agg(amount(sum_units("x")),
                                       mean(sum_units("x"), F.count("x"), 2)).first()
    assert tuple(empty) == (None, None)


def test_small_amounts_are_not_cut_off(spark):
    df = spark.range(100_000).selectExpr("0.00004D as x", "id")
    for parts in (1, 8):
        row = df.repartition(parts).agg(amount(sum_units("x"), 6).alias("s"),
                                        mean(sum_units("x"), F.count("x"), 8).alias("m")).first()
        assert (row["s"], row["m"]) == (4.0, 0.00004)


def test_overflow_raises_instead_of_wrapping(spark):
    df = spark.createDataFrame([(9e14,), (9e14,)], "x double")
    with pytest.raises(Exception, match="OVERFLOW"):
        df.agg(sum_units("x")).collect()
