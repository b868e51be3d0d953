"""One month of trips: check, land, load, model, check again, log."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmentry import fixed_values as fv
from segmentry.operators import quality, runs, trips
from segmentry.session import size_shuffles
from segmentry.sources import tables
from segmentry.sources import trips as src


class CheckFailed(ValueError):
    pass


@dataclass(frozen=True)
class Layout:
    """Where the layers live. Pointing ``base`` elsewhere is how a test and a production run differ."""

    base: str

    @property
    def landing(self) -> str:
        return f"{self.base}/raw/trips"

    @property
    def staging(self) -> str:
        return f"{self.base}/staging/trips"

    @property
    def intermediate(self) -> str:
        return f"{self.base}/intermediate/trips"

    @property
    def mart(self) -> str:
        return f"{self.base}/marts/trips"

    @property
    def run_log(self) -> str:
        return f"{self.base}/pipeline_runs"


def load_month(
    raw: DataFrame,
    layout: Layout,
    month: str,
    run_id: str,
    min_rows: int = fv.MIN_MONTH_ROWS,
    max_null_rate: float = 0.01,
) -> int:
    """Loads one month from its raw file; running it again replaces what it wrote. Returns rows loaded."""
    spark = raw.sparkSession
    missing = src.missing_columns(raw)
    if missing:
        raise CheckFailed(f"missing columns: {missing}")
    rows = raw.count()
    if rows < min_rows:
        raise CheckFailed(f"{rows} rows before the load, expected at least {min_rows}")

    path = src.land_month(raw, layout.landing, month)
    size_shuffles(spark, path)
    landed = spark.read.parquet(path)
    tables.replace_month(landed, layout.staging, month)
    staged = spark.read.parquet(layout.staging).where(F.col("load_month") == month).drop("load_month")

    tables.replace_month(trips.clean_trips(staged), layout.intermediate, month)
    clean = spark.read.parquet(layout.intermediate).where(F.col("load_month") == month)
    mart = trips.trip_mart(clean).withColumn("load_month", F.lit(month))
    mart.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("load_month").parquet(layout.mart)

    loaded = staged.count()
    if loaded < min_rows:
        raise CheckFailed(f"{loaded} rows after the load, expected at least {min_rows}")
    critical = ["tpep_pickup_datetime", "tpep_dropoff_datetime", "fare_amount"]
    failed = quality.null_rates(staged, critical, max_null_rate).where("passed = 0").collect()  # one row per column
    if failed:
        raise CheckFailed(f"null rate over {max_null_rate}: {[r['column_name'] for r in failed]}")
    runs.log_run(spark, layout.run_log, "monthly_trips", run_id, month, loaded)
    return loaded


def register_layers(spark, layout: Layout) -> None:
    """Views over the layers for ad-hoc SQL."""
    spark.read.parquet(layout.staging).createOrReplaceTempView("staging_trips")
    spark.read.parquet(layout.intermediate).createOrReplaceTempView("intermediate_trips")
    spark.read.parquet(layout.mart).createOrReplaceTempView("mart_trips")
