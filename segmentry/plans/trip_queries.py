"""Trip features, layers, month handling."""

from __future__ import annotations

from pyspark.sql import functions as F

from segmentry.functions.numeric import round_even
from segmentry.operators import trips as op
from segmentry.plans.inputs import FEATURES_SQL, TRIPS_SQL, table, trips
from segmentry.plans.registry import query
from segmentry.session import scratch_path
from segmentry.sources import tables
from segmentry.sources import trips as src

FEATURES = [
    "l_orderkey", "l_linenumber", "trip_duration_minutes", "pickup_hour", "pickup_day_of_week", "is_weekend",
    "is_rush_hour", "is_airport_trip", "speed_mph", "fare_per_mile", "tip_rate", "is_valid",
]


@query(f"WITH {FEATURES_SQL} SELECT {', '.join(FEATURES)} FROM features")
def trip_features(spark, sf):
    return op.with_trip_features(trips(spark, sf)).select(*FEATURES)


@query(
    f"""WITH {FEATURES_SQL} SELECT count(*) AS trips, CAST(sum(is_valid) AS BIGINT) AS valid_trips,
    round_even(avg(is_valid) * 1e6, 0) / 1e6 AS valid_share FROM features"""
)
def trip_valid_summary(spark, sf):
    out = op.valid_summary(op.with_trip_features(trips(spark, sf)))
    return out.withColumn("valid_share", round_even(F.col("valid_share"), 6))


MART_SQL = """SELECT strftime(tpep_pickup_datetime, '%Y-%m') AS pickup_month, PULocationID, count(*) AS trips,
      round_even(avg(fare_amount) * 1e8, 0) / 1e8 AS avg_fare, round_even(avg(speed_mph) * 1e8, 0) / 1e8 AS avg_speed_mph,
      round_even(avg(tip_rate) * 1e8, 0) / 1e8 AS avg_tip_rate, round_even(avg(is_airport_trip) * 1e8, 0) / 1e8 AS airport_share,
      round_even(avg(is_rush_hour) * 1e8, 0) / 1e8 AS rush_share
    FROM features WHERE is_valid = 1 GROUP BY 1, 2"""


def rounded_mart(mart):
    averages = ["avg_fare", "avg_speed_mph", "avg_tip_rate", "airport_share", "rush_share"]
    return mart.withColumns({c: round_even(F.col(c), 8) for c in averages})


@query(f"WITH {FEATURES_SQL} {MART_SQL}")
def trip_mart(spark, sf):
    return rounded_mart(op.trip_mart(op.clean_trips(trips(spark, sf))))


@query(
    f"""WITH {TRIPS_SQL} SELECT l_orderkey, l_linenumber, tpep_pickup_datetime, fare_amount FROM trips
    WHERE strftime(tpep_pickup_datetime, '%Y-%m') = '1997-03'"""
)
def month_load(spark, sf):
    month = trips(spark, sf).where(src.in_month("tpep_pickup_datetime", "1997-03"))
    return month.select("l_orderkey", "l_linenumber", "tpep_pickup_datetime", "fare_amount")


@query(
    f"""WITH {TRIPS_SQL}, stored AS (
      SELECT strftime(tpep_pickup_datetime, '%Y-%m') AS load_month, fare_amount AS fare FROM trips
      WHERE strftime(tpep_pickup_datetime, '%Y-%m') <> '1997-03'
      UNION ALL SELECT '1997-03', fare_amount + 1 FROM trips WHERE strftime(tpep_pickup_datetime, '%Y-%m') = '1997-03')
    SELECT load_month, count(*) AS trips, round_even(sum(fare) * 1e4, 0) / 1e4 AS fare_sum FROM stored GROUP BY 1"""
)
def month_replace(spark, sf):
    """All months are written, then one is replaced twice by corrected rows of all months (strays are dropped)."""
    path = scratch_path(spark, "months")
    base = trips(spark, sf).select("tpep_pickup_datetime", "fare_amount")
    tables.write_months(base, path)
    for _ in range(2):
        tables.replace_month(base.withColumn("fare_amount", F.col("fare_amount") + 1), path, "1997-03")
    stored = spark.read.parquet(path)
    return stored.groupBy(F.date_format("tpep_pickup_datetime", "yyyy-MM").alias("load_month")).agg(
        F.count(F.lit(1)).alias("trips"), round_even(F.sum("fare_amount"), 4).alias("fare_sum")
    )


@query(
    f"""WITH {TRIPS_SQL} SELECT CAST(year(tpep_pickup_datetime) AS INT) AS year, CAST(month(tpep_pickup_datetime) AS INT) AS month,
    count(*) AS trips FROM trips GROUP BY 1, 2"""
)
def landing_partitions(spark, sf):
    path = src.land_partitioned(trips(spark, sf), scratch_path(spark, "landing"))
    return spark.read.parquet(path).groupBy("year", "month").agg(F.count(F.lit(1)).alias("trips"))


@query(
    f"""WITH {TRIPS_SQL} SELECT count(*) AS trips, CAST(sum(l_linenumber) AS BIGINT) AS line_sum FROM trips
    WHERE strftime(tpep_pickup_datetime, '%Y-%m') = '1998-11'"""
)
def month_scan(spark, sf):
    """Lands a month, then scans its folder."""
    path = src.land_partitioned(trips(spark, sf), scratch_path(spark, "landing"))
    month = spark.read.parquet(path).where("year = 1998 AND month = 11")
    return month.agg(F.count(F.lit(1)).alias("trips"), F.sum("l_linenumber").alias("line_sum"))


@query(
    """SELECT o_orderkey, strftime(date_trunc('month', o_orderdate) - INTERVAL 1 DAY, '%Y-%m') AS target_month FROM orders"""
)
def target_month(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", src.previous_month(F.col("o_orderdate").cast("date")).alias("target_month")
    )


@query(
    """SELECT t.file_name, count(*) AS row_count FROM (
      SELECT 'lineitem.parquet' AS file_name FROM lineitem UNION ALL SELECT 'orders.parquet' FROM orders) t GROUP BY 1"""
)
def file_inventory(spark, sf):
    return (
        src.file_inventory(table(spark, sf, "lineitem"))
        .unionByName(src.file_inventory(table(spark, sf, "orders")))
        .select("file_name", "row_count")
    )


@query(
    f"""WITH {FEATURES_SQL} {MART_SQL}"""
)
def layered_models(spark, sf):
    """Staging written by month, intermediate and mart built from it through SQL views."""
    path = scratch_path(spark, "layers")
    tables.write_months(trips(spark, sf), f"{path}/staging")
    tables.write_months(op.clean_trips(spark.read.parquet(f"{path}/staging").drop("load_month")), f"{path}/intermediate")
    op.trip_mart(spark.read.parquet(f"{path}/intermediate")).write.parquet(f"{path}/mart")
    view = path.rsplit("/", 1)[1].replace("-", "_")
    spark.read.parquet(f"{path}/mart").createOrReplaceTempView(view)
    return rounded_mart(tables.query(spark, f"SELECT * FROM {view} WHERE trips >= :least", least=1))
