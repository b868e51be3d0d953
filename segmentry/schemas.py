"""Explicit schemas; readers never infer types."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


TRIP = _struct(
    tpep_pickup_datetime=T.TimestampNTZType(),
    tpep_dropoff_datetime=T.TimestampNTZType(),
    passenger_count=T.DoubleType(),
    trip_distance=T.DoubleType(),
    fare_amount=T.DoubleType(),
    tip_amount=T.DoubleType(),
    total_amount=T.DoubleType(),
    PULocationID=T.IntegerType(),
    DOLocationID=T.IntegerType(),
)

# Ratings are read as text: sources hold 5, "4.7" and junk, and a bad value must not drop its row.
REVIEW_RAW = _struct(
    id=T.StringType(),
    text=T.StringType(),
    rating=T.StringType(),
    review_id=T.StringType(),
    review_body=T.StringType(),
    star_rating=T.StringType(),
    product_id=T.StringType(),
    customer_id=T.StringType(),
    timestamp=T.StringType(),
    review_date=T.StringType(),
)

REVIEW = _struct(
    id=T.StringType(),
    text=T.StringType(),
    rating=T.IntegerType(),
    product_id=T.StringType(),
    customer_id=T.StringType(),
    timestamp=T.StringType(),
)

VECTOR = _struct(
    record_id=T.StringType(),
    embedding=T.ArrayType(T.FloatType(), False),
    model_name=T.StringType(),
    model_version=T.StringType(),
    created_at=T.TimestampType(),
)

SEGMENT_ASSIGNMENT = _struct(
    record_id=T.StringType(),
    segment_id=T.IntegerType(),
    segment_label=T.StringType(),
    confidence=T.DoubleType(),
    rating=T.IntegerType(),
    customer_id=T.StringType(),
    product_id=T.StringType(),
    run_timestamp=T.TimestampType(),
)

RUN_LOG = _struct(
    dag_id=T.StringType(),
    run_id=T.StringType(),
    target_month=T.StringType(),
    row_count=T.LongType(),
    status=T.StringType(),
    completed_at=T.TimestampType(),
)

MODEL_RUN = _struct(
    run_id=T.StringType(),
    version=T.IntegerType(),
    stage=T.StringType(),
    metric=T.StringType(),
    value=T.DoubleType(),
)
