from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from segmentry.operators import trips as op
from segmentry.plans import trip_load
from segmentry.sources import tables
from segmentry.sources import trips as src

SCHEMA = (
    "tpep_pickup_datetime string, tpep_dropoff_datetime string, passenger_count double, trip_distance double, "
    "PULocationID int, DOLocationID int, fare_amount double, tip_amount double, total_amount double"
)


def features(spark, *rows):
    return op.with_trip_features(spark.createDataFrame(list(rows), SCHEMA)).collect()


def trip(pickup="2023-01-02 08:00:00", dropoff="2023-01-02 08:30:00", passengers=1.0, miles=5.0, pu=132, do=10, fare=20.0, tip=4.0):
    return (pickup, dropoff, passengers, miles, pu, do, fare, tip, None if fare is None else fare + (tip or 0))


def test_two_plain_trips(spark):
    a, b = features(spark, trip(), trip("2023-01-07 17:00:00", "2023-01-07 17:15:00", 2.0, 3.0, 20, 30, 12.0, 0.0))
    assert a["trip_duration_minutes"] == 30.0
    assert (a["is_airport_trip"], b["is_airport_trip"]) == (1, 0)
    assert (a["is_rush_hour"], b["is_rush_hour"]) == (1, 1)
    assert (a["is_weekend"], b["is_weekend"]) == (0, 1)
    assert a["pickup_day_of_week"] == 0
    assert a["tip_rate"] == 0.2
    assert a["speed_mph"] == 10.0
    assert a["fare_per_mile"] == 4.0
    assert (a["is_valid"], b["is_valid"]) == (1, 1)


def test_unreadable_and_missing_values_are_invalid_not_null(spark):
    rows = features(
        spark,
        trip(pickup="soon"),
        trip(miles=None),
        trip(fare=None),
        trip(passengers=None),
        trip(pu=None, do=None),
    )
    assert [r["is_valid"] for r in rows] == [0, 0, 0, 0, 1]
    assert rows[0]["trip_duration_minutes"] is None and rows[0]["speed_mph"] == 0.0
    assert rows[0]["is_rush_hour"] == 0 and rows[0]["is_weekend"] == 0
    assert rows[1]["fare_per_mile"] == 0.0
    assert rows[1]["speed_mph"] is None  # duration is fine, distance is not
    assert rows[2]["tip_rate"] == 0.0
    assert rows[4]["is_airport_trip"] == 0


@pytest.mark.parametrize(
    "changes, column, expected",
    [
        ({"dropoff": "2023-01-02 08:00:00"}, "speed_mph", 0.0),
        ({"dropoff": "2023-01-02 08:00:01"}, "speed_mph", 100.0),
        ({"miles": 0.1}, "fare_per_mile", 0.0),
        ({"miles": 0.2}, "fare_per_mile", 50.0),
        ({"miles": -1.0}, "speed_mph", 0.0),
        ({"tip": 100.0}, "tip_rate", 2.0),
        ({"fare": -3.0}, "tip_rate", 0.0),
        ({"dropoff": "2023-01-02 12:00:00"}, "is_valid", 0),
        ({"passengers": 9.0}, "is_valid", 0),
        ({"miles": 200.0}, "is_valid", 0),
    ],
)
def test_limits(spark, changes, column, expected):
    assert features(spark, trip(**changes))[0][column] == expected


def test_rounding_is_half_even_on_the_binary_value(spark):
    from segmentry.functions.numeric import round_away, round_even

    values = [0.125, 1.005, 10.005, -0.125, 2.675]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    import numpy as np

    assert [r[0] for r in df.select(round_even(F.col("v"), 2)).collect()] == [float(np.round(v, 2)) for v in values]
    assert df.select(round_away(F.col("v"), 2)).first()[0] == 0.13


def test_summary_of_nothing(spark):
    empty = op.with_trip_features(spark.createDataFrame([], SCHEMA))
    row = op.valid_summary(empty).first()
    assert (row["trips"], row["valid_trips"], row["valid_share"]) == (0, 0, None)


def test_month_helpers(spark):
    day = spark.createDataFrame([(dt.date(2024, 3, 31),), (dt.date(2024, 1, 1),)], "d date")
    assert [r[0] for r in day.select(src.previous_month(F.col("d"))).collect()] == ["2024-02", "2023-12"]
    assert src.month_bounds("2023-12") == (dt.datetime(2023, 12, 1), dt.datetime(2024, 1, 1))
    assert src.missing_columns(day) == [
        "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count", "trip_distance",
        "fare_amount", "total_amount", "PULocationID", "DOLocationID",
    ]


def typed(spark, *rows):
    return op.with_timestamps(spark.createDataFrame(list(rows), SCHEMA))


def test_month_replace_is_repeatable_and_drops_strays(spark, path):
    first = typed(spark, trip(), trip("2023-02-03 09:00:00", "2023-02-03 09:10:00"))
    tables.write_months(first, path)
    load = typed(spark, trip(fare=99.0), trip(fare=98.0), trip("2023-03-01 00:00:00", "2023-03-01 00:10:00"))
    for _ in range(2):
        tables.replace_month(load, path, "2023-01")
    fares = sorted(r["fare_amount"] for r in spark.read.parquet(path).collect())
    assert fares == [20.0, 98.0, 99.0]
    tables.replace_month(load.where("false"), path, "2023-01")
    assert [r["fare_amount"] for r in spark.read.parquet(path).collect()] == [20.0]


def test_month_filter_reaches_the_scan(spark, path):
    tables.write_version(typed(spark, trip()), path)
    scan = tables.read_versioned(spark, path).where(src.in_month("tpep_pickup_datetime", "2023-01")).select("fare_amount")
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(tpep_pickup_datetime), GreaterThanOrEqual(" in plan
    assert scan.count() == 1


def test_monthly_load(spark, tmp_path):
    layout = trip_load.Layout(str(tmp_path))
    raw = typed(spark, *[trip(fare=10.0 + i) for i in range(20)], trip(miles=0.0), trip("2023-02-01 00:00:00", "2023-02-01 00:09:00"))
    for _ in range(2):
        assert trip_load.load_month(raw, layout, "2023-01", "run-1", min_rows=10) == 21
    trip_load.register_layers(spark, layout)
    assert tables.query(spark, "SELECT count(*) FROM staging_trips").first()[0] == 21
    assert tables.query(spark, "SELECT sum(trips) FROM mart_trips WHERE load_month = :m", m="2023-01").first()[0] == 20
    log = tables.read_keyed(spark, layout.run_log).collect()
    assert [(r["run_id"], r["row_count"]) for r in log] == [("run-1", 21)]
    with pytest.raises(trip_load.CheckFailed):
        trip_load.load_month(raw, layout, "2023-01", "run-2", min_rows=1000)
    with pytest.raises(trip_load.CheckFailed):
        trip_load.load_month(raw.drop("fare_amount"), layout, "2023-01", "run-3", min_rows=1)
