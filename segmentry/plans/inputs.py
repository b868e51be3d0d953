"""The given tables, and views of them in the shapes the operators expect.

Each view exists as DataFrame code here and as SQL text for the comparison engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segmentry.session import size_shuffles, spread

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    path = f"{sf}/{name}.parquet"
    size_shuffles(spark, path)
    return spark.read.parquet(path)


def texts(spark: SparkSession, sf: str, name: str, key: str) -> DataFrame:
    """A text table over all cores; text work is heavy per row."""
    return spread(table(spark, sf, name), key)


def trips(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as trips, with the edge cases of real ones (bad durations, distances, fares, counts)."""
    key, part, supp = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    minute = key % 1440
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.timestamp_add("MINUTE", minute.cast("int"), F.col("l_shipdate")).alias("tpep_pickup_datetime"),
        F.timestamp_add(
            "SECOND", (minute * 60 + part * 37 % 18000 - 300).cast("int"), F.col("l_shipdate")
        ).alias("tpep_dropoff_datetime"),
        (supp % 10).cast("double").alias("passenger_count"),
        (F.col("l_quantity") / 4 - 0.25).alias("trip_distance"),
        (F.col("l_extendedprice") / 1000 - 2).alias("fare_amount"),
        (F.col("l_discount") * F.col("l_extendedprice") / 1000).alias("tip_amount"),
        ((1 + F.col("l_discount")) * F.col("l_extendedprice") / 1000).alias("total_amount"),
        (1 + part % 265).cast("int").alias("PULocationID"),
        (1 + supp % 265).cast("int").alias("DOLocationID"),
    )


TRIPS_SQL = """trips AS (
  SELECT l_orderkey, l_linenumber,
    l_shipdate + to_minutes(l_orderkey % 1440) AS tpep_pickup_datetime,
    l_shipdate + to_seconds(CAST((l_orderkey % 1440) * 60 + l_partkey * 37 % 18000 - 300 AS DOUBLE)) AS tpep_dropoff_datetime,
    CAST(l_suppkey % 10 AS DOUBLE) AS passenger_count, l_quantity / 4 - 0.25 AS trip_distance,
    l_extendedprice / 1000 - 2 AS fare_amount, l_discount * l_extendedprice / 1000 AS tip_amount,
    (1 + l_discount) * l_extendedprice / 1000 AS total_amount,
    CAST(1 + l_partkey % 265 AS INT) AS PULocationID, CAST(1 + l_suppkey % 265 AS INT) AS DOLocationID
  FROM lineitem)"""

FEATURES_SQL = (
    TRIPS_SQL
    + """,
timed AS (
  SELECT *,
    round_even(date_diff('microsecond', tpep_pickup_datetime, tpep_dropoff_datetime) / 1e6 / 60 * 100, 0) / 100 AS trip_duration_minutes,
    CAST(hour(tpep_pickup_datetime) AS INT) AS pickup_hour,
    CAST(isodow(tpep_pickup_datetime) - 1 AS INT) AS pickup_day_of_week
  FROM trips),
features AS (
  SELECT *,
    CAST(pickup_day_of_week IN (5, 6) AS INT) AS is_weekend,
    CAST(pickup_hour IN (7, 8, 9, 16, 17, 18, 19) AS INT) AS is_rush_hour,
    CAST(PULocationID IN (132, 138) OR DOLocationID IN (132, 138) AS INT) AS is_airport_trip,
    CASE WHEN trip_duration_minutes > 0 THEN round_even(least(greatest(trip_distance / (trip_duration_minutes / 60), 0), 100) * 100, 0) / 100 ELSE 0.0 END AS speed_mph,
    CASE WHEN trip_distance > 0.1 THEN round_even(least(greatest(fare_amount / trip_distance, 0), 50) * 100, 0) / 100 ELSE 0.0 END AS fare_per_mile,
    CASE WHEN fare_amount > 0 THEN round_even(least(greatest(tip_amount / fare_amount, 0), 2) * 1000, 0) / 1000 ELSE 0.0 END AS tip_rate,
    CAST(trip_duration_minutes > 0 AND trip_duration_minutes < 240 AND trip_distance > 0 AND trip_distance < 200
      AND fare_amount > 0 AND passenger_count >= 1 AND passenger_count <= 8 AS INT) AS is_valid
  FROM timed)"""
)


def reviews(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as reviews; words of the sentiment lists are appended, as the documents have none."""
    doc = F.col("doc_id")
    tail = (
        F.when(doc % 5 == 0, " Great product! I love it, great.")
        .when(doc % 5 == 1, " Terrible and broken. The worst?")
        .when(doc % 5 == 2, " Amazing idea, useless result, awful box.")
        .otherwise("")
    )
    return texts(spark, sf, "documents", "doc_id").select(
        F.concat(F.lit("note-"), F.lpad(doc.cast("string"), 9, "0")).alias("id"),
        F.concat("text", tail).alias("text"),
        (1 + doc % 5).cast("int").alias("rating"),
        F.concat(F.lit("item-"), (doc * 3 % 170).cast("string")).alias("product_id"),
        F.concat(F.lit("buyer-"), (doc * 11 % 430).cast("string")).alias("customer_id"),
        "lang",
    )


REVIEWS_SQL = """reviews AS (
  SELECT concat('note-', lpad(CAST(doc_id AS VARCHAR), 9, '0')) AS id,
    concat(text, CASE doc_id % 5 WHEN 0 THEN ' Great product! I love it, great.'
      WHEN 1 THEN ' Terrible and broken. The worst?'
      WHEN 2 THEN ' Amazing idea, useless result, awful box.' ELSE '' END) AS text,
    CAST(1 + doc_id % 5 AS INT) AS rating,
    concat('item-', CAST(doc_id * 3 % 170 AS VARCHAR)) AS product_id,
    concat('buyer-', CAST(doc_id * 11 % 430 AS VARCHAR)) AS customer_id, lang
  FROM documents)"""


def current_run(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors with a first labelling: ten segments and noise."""
    label = F.when(F.col("vec_id") % 50 == 0, -1).otherwise(F.col("label")).cast("int")
    return _labelled(spark, sf, label)


def previous_run(spark: SparkSession, sf: str) -> DataFrame:
    """The same vectors with a second labelling: eight segments."""
    label = F.when(F.col("vec_id") % 4 == 0, F.col("vec_id") % 8).otherwise(F.col("label") % 8).cast("int")
    return _labelled(spark, sf, label)


def _labelled(spark: SparkSession, sf: str, label) -> DataFrame:
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").cast("string").alias("record_id"), "embedding", label.alias("segment_id")
    )


CURRENT_SQL = """cur AS (
  SELECT CAST(vec_id AS VARCHAR) AS record_id, CAST(embedding AS DOUBLE[]) AS embedding,
    CAST(CASE WHEN vec_id % 50 = 0 THEN -1 ELSE label END AS INT) AS segment_id FROM embeddings)"""

PREVIOUS_SQL = """prev AS (
  SELECT CAST(vec_id AS VARCHAR) AS record_id, CAST(embedding AS DOUBLE[]) AS embedding,
    CAST(CASE WHEN vec_id % 4 = 0 THEN vec_id % 8 ELSE label % 8 END AS INT) AS segment_id FROM embeddings)"""


def mean_sql(source: str, name: str) -> str:
    """Mean and unit-length mean vector per segment of a labelled CTE, noise left out."""
    return f"""{name}_long AS (
  SELECT segment_id, i, avg(x) AS m FROM (
    SELECT segment_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM {source} WHERE segment_id <> -1)
  GROUP BY segment_id, i),
{name}_mean AS (SELECT segment_id, list(m ORDER BY i) AS mean FROM {name}_long GROUP BY segment_id),
{name} AS (
  SELECT segment_id, mean, list_transform(mean, lambda x: x / sqrt(list_inner_product(mean, mean))) AS centroid,
    (SELECT count(*) FROM {source} s WHERE s.segment_id = m.segment_id) AS size
  FROM {name}_mean m)"""


def requests(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        "event_id",
        "ts",
        F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status"),
        (F.col("value") / 1000).alias("latency_s"),
    )


REQUESTS_SQL = """requests AS (
  SELECT event_id, ts, CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status, value / 1000 AS latency_s FROM events)"""


def messages(spark: SparkSession, sf: str) -> DataFrame:
    """Conversation turns as prediction requests; some have no id, some no text, some a text over the limit."""
    row = F.col("conv_id") * 100 + F.col("turn")
    return table(spark, sf, "conversations").select(
        row.alias("row_id"),
        F.when(row % 11 != 0, F.concat_ws("-", F.col("conv_id"), F.col("turn"))).alias("record_id"),
        F.when(row % 7 == 0, "").when(row % 13 == 0, F.repeat("text", 200)).otherwise(F.col("text")).alias("text"),
    )


MESSAGES_SQL = """messages AS (
  SELECT conv_id * 100 + turn AS row_id,
    CASE WHEN (conv_id * 100 + turn) % 11 <> 0 THEN concat(conv_id, '-', turn) END AS record_id,
    CASE WHEN (conv_id * 100 + turn) % 7 = 0 THEN '' WHEN (conv_id * 100 + turn) % 13 = 0 THEN repeat(text, 200) ELSE text END AS text
  FROM conversations)"""


def run_log(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as a run log: one pipeline per priority, one run per order."""
    return table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("dag_id"),
        F.col("o_orderkey").cast("string").alias("run_id"),
        F.date_format("o_orderdate", "yyyy-MM").alias("target_month"),
        F.col("o_custkey").alias("row_count"),
        F.when(F.col("o_orderstatus") == "P", "failed").otherwise("success").alias("status"),
        F.col("o_orderdate").alias("completed_at"),
    )


RUN_LOG_SQL = """run_log AS (
  SELECT o_orderpriority AS dag_id, CAST(o_orderkey AS VARCHAR) AS run_id, strftime(o_orderdate, '%Y-%m') AS target_month,
    o_custkey AS row_count, CASE WHEN o_orderstatus = 'P' THEN 'failed' ELSE 'success' END AS status, o_orderdate AS completed_at
  FROM orders)"""


def model_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as a model registry: open ones are candidates, finished ones were promoted."""
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("run_id"),
        F.col("o_orderkey").cast("int").alias("version"),
        F.when(F.col("o_orderstatus") == "O", "Staging").when(F.col("o_orderstatus") == "F", "Production").otherwise("Archived").alias("stage"),
        F.lit("silhouette_score").alias("metric"),
        (F.col("o_totalprice") / 1e6).alias("value"),
    )


MODEL_RUNS_SQL = """runs AS (
  SELECT CAST(o_orderkey AS INT) AS version, o_totalprice / 1e6 AS value,
    CASE o_orderstatus WHEN 'O' THEN 'Staging' WHEN 'F' THEN 'Production' ELSE 'Archived' END AS stage
  FROM orders)"""
