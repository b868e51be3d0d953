"""Monthly trip files: scan, month arithmetic, month filter, landing layout."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from segmentry import fixed_values as fv
from segmentry import schemas


@dataclass(frozen=True)
class Extraction:
    trips: DataFrame
    month: str
    path: str


def month_path(base: str, month: str) -> str:
    """Hive-style folder of one month under the landing area."""
    year, number = month.split("-")
    return f"{base.rstrip('/')}/year={year}/month={number}"


def extract_month(spark: SparkSession, base: str, month: str) -> Extraction:
    """The trips of one landed month. Nothing is read until an action asks for it."""
    path = month_path(base, month)
    return Extraction(spark.read.schema(schemas.TRIP).parquet(path), month, path)


def file_inventory(df: DataFrame) -> DataFrame:
    """Rows and bytes per source file. Only file metadata is projected, no data column is read."""
    return (
        df.select(
            F.col("_metadata.file_name").alias("file_name"),
            F.col("_metadata.file_size").alias("file_size"),
        )
        .groupBy("file_name", "file_size")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def previous_month(day: Column) -> Column:
    """``yyyy-MM`` of the month before the one ``day`` lies in."""
    return F.date_format(F.add_months(F.trunc(day, "MM"), -1), "yyyy-MM")


def month_bounds(month: str) -> tuple[dt.datetime, dt.datetime]:
    first = dt.datetime.strptime(month, "%Y-%m")
    after = (first + dt.timedelta(days=32)).replace(day=1)
    return first, after


def in_month(column: str, month: str) -> Column:
    """Month membership as a range, so that Parquet can skip row groups by their minimum and maximum."""
    first, after = (F.lit(f"{d:%Y-%m-%d %H:%M:%S}").cast("timestamp_ntz") for d in month_bounds(month))
    return (F.col(column) >= first) & (F.col(column) < after)


def month_of(column: str) -> Column:
    return F.date_format(F.col(column), "yyyy-MM")


def missing_columns(df: DataFrame, required: list[str] | None = None) -> list[str]:
    """Required columns the table lacks; schema only, no job."""
    return [c for c in (required or fv.REQUIRED_TRIP_COLUMNS) if c not in df.columns]


def land_month(trips: DataFrame, base: str, month: str) -> str:
    """Writes the raw file of one month to its landing folder, replacing what a retry left there."""
    path = month_path(base, month)
    trips.write.mode("overwrite").parquet(path)
    return path


def land_partitioned(trips: DataFrame, base: str, column: str = "tpep_pickup_datetime") -> str:
    """Writes trips of many months to ``year=/month=`` folders; only months present are replaced.

    Rows are spread over several writers per month: a hot month does not end in one task, and no task
    opens a file in every folder.
    """
    keyed = trips.withColumns(
        {"year": F.date_format(column, "yyyy"), "month": F.date_format(column, "MM")}
    )
    spread_by_partition(keyed, ["year", "month"]).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("year", "month").parquet(base)
    return base


def spread_by_partition(df: DataFrame, keys: list[str]) -> DataFrame:
    """Clusters rows by partition folder before a partitioned write.

    The REBALANCE hint lets adaptive execution split a folder that holds much of the data into
    files of the advisory size and merge small ones.
    """
    return df.hint("rebalance", *keys)
