"""Trip features, validity, layered trip models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmentry import fixed_values as fv
from segmentry.functions.numeric import flag, guarded_ratio, round_even

PICKUP, DROPOFF = "tpep_pickup_datetime", "tpep_dropoff_datetime"


def with_timestamps(trips: DataFrame) -> DataFrame:
    """Text timestamps are parsed, unreadable ones become null; timestamp columns pass unchanged."""
    types = dict(trips.dtypes)
    parsed = {
        c: F.col(c).try_cast("timestamp_ntz")
        for c in (PICKUP, DROPOFF)
        if not types[c].startswith("timestamp")
    }
    return trips.withColumns(parsed) if parsed else trips


def with_trip_features(trips: DataFrame) -> DataFrame:
    """Adds the derived trip columns. One projection stack, no shuffle, no Python."""
    pickup, dropoff = F.col(PICKUP), F.col(DROPOFF)
    # The difference of two plain timestamps is an exact interval and knows no time zone.
    seconds = (dropoff - pickup).cast("decimal(18,6)").cast("double")
    duration, distance = F.col("trip_duration_minutes"), F.col("trip_distance")
    fare, passengers = F.col("fare_amount"), F.col("passenger_count")
    low, high = fv.PASSENGER_RANGE
    airport = F.coalesce(F.col("PULocationID").isin(fv.AIRPORT_LOCATION_IDS), F.lit(False)) | F.coalesce(
        F.col("DOLocationID").isin(fv.AIRPORT_LOCATION_IDS), F.lit(False)
    )
    return (
        with_timestamps(trips)
        .withColumns(
            {
                "trip_duration_minutes": round_even(seconds / 60.0, 2),
                "pickup_hour": F.hour(pickup),
                "pickup_day_of_week": F.weekday(pickup),
            }
        )
        .withColumns(
            {
                "is_weekend": flag(F.col("pickup_day_of_week").isin(fv.WEEKEND_DAYS)),
                "is_rush_hour": flag(F.col("pickup_hour").isin(fv.RUSH_HOURS)),
                "is_airport_trip": flag(airport),
                "speed_mph": guarded_ratio(distance, duration / 60.0, duration > 0, 0, fv.MAX_SPEED_MPH, 2),
                "fare_per_mile": guarded_ratio(
                    fare, distance, distance > fv.MIN_FARE_DISTANCE, 0, fv.MAX_FARE_PER_MILE, 2
                ),
                "tip_rate": guarded_ratio(F.col("tip_amount"), fare, fare > 0, 0, fv.MAX_TIP_RATE, 3),
                "is_valid": flag(
                    (duration > 0)
                    & (duration < fv.MAX_TRIP_MINUTES)
                    & (distance > 0)
                    & (distance < fv.MAX_TRIP_MILES)
                    & (fare > 0)
                    & (passengers >= low)
                    & (passengers <= high)
                ),
            }
        )
    )


def valid_summary(features: DataFrame) -> DataFrame:
    """Valid trips and their share; an empty table has a null share."""
    return features.agg(
        F.count(F.lit(1)).alias("trips"),
        F.coalesce(F.sum("is_valid"), F.lit(0)).alias("valid_trips"),
        F.avg("is_valid").alias("valid_share"),
    )


def clean_trips(trips: DataFrame) -> DataFrame:
    """The intermediate layer: features of valid trips only."""
    return with_trip_features(trips).where("is_valid = 1")


def trip_mart(clean: DataFrame) -> DataFrame:
    """The mart layer: one row per pickup month and pickup location.

    Aggregated on the map side first, so a location with most of the trips adds one row per task. Months
    are grouped as dates and spelled out once per group.
    """
    month = F.trunc(F.col(PICKUP).cast("date"), "MM")
    grouped = clean.groupBy(month.alias("_month"), "PULocationID").agg(
        F.count(F.lit(1)).alias("trips"),
        F.avg("fare_amount").alias("avg_fare"),
        F.avg("speed_mph").alias("avg_speed_mph"),
        F.avg("tip_rate").alias("avg_tip_rate"),
        F.avg("is_airport_trip").alias("airport_share"),
        F.avg("is_rush_hour").alias("rush_share"),
    )
    return grouped.select(F.date_format("_month", "yyyy-MM").alias("pickup_month"), *grouped.columns[1:])
