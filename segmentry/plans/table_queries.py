"""Re-runnable writes and quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from segmentry.functions.numeric import round_even
from segmentry.operators import quality
from segmentry.plans.inputs import TRIPS_SQL, table, trips
from segmentry.plans.registry import query
from segmentry.session import scratch_path
from segmentry.sources import tables
from segmentry.sources import trips as src


def _customers(spark, sf, condition="true"):
    return table(spark, sf, "customer").where(condition).select("c_custkey", "c_name", "c_acctbal")


@query(
    """SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_mktsegment <> 'BUILDING'
    UNION ALL SELECT c_custkey, c_name, c_acctbal + 1 FROM customer WHERE c_mktsegment = 'BUILDING'
    UNION ALL SELECT c_custkey, c_name, c_acctbal + 2 FROM customer WHERE c_mktsegment = 'BUILDING'"""
)
def keyed_replace(spark, sf):
    """Every customer of one market segment is replaced by two corrected rows; the load is run twice."""
    path = scratch_path(spark, "keyed")
    tables.replace_by_key(_customers(spark, sf), path, "c_custkey")
    building = _customers(spark, sf, "c_mktsegment = 'BUILDING'")
    load = building.withColumn("c_acctbal", F.col("c_acctbal") + 1).unionByName(
        building.withColumn("c_acctbal", F.col("c_acctbal") + 2)
    )
    for _ in range(2):
        tables.replace_by_key(load, path, "c_custkey")
    return tables.read_keyed(spark, path)


@query(
    """SELECT o_custkey, coalesce(min(o_orderkey) FILTER (o_orderdate < TIMESTAMP '1998-01-01'), min(o_orderkey)) AS o_orderkey
    FROM orders GROUP BY 1"""
)
def insert_if_absent(spark, sf):
    """First the orders before 1998, then all: a customer keeps the first order that was inserted."""
    path = scratch_path(spark, "absent")
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    early = orders.where(F.col("o_orderdate") < F.lit("1998-01-01 00:00:00").cast("timestamp_ntz"))
    for load in (early, orders, orders):
        tables.insert_if_absent(load.drop("o_orderdate"), path, "o_custkey", "o_orderkey")
    return tables.read_keyed(spark, path)


@query(
    """SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders WHERE NOT coalesce(o_totalprice > 100000, false)
    UNION ALL SELECT o_orderkey, 'reloaded', o_totalprice FROM orders WHERE o_totalprice > 100000"""
)
def predicate_replace(spark, sf):
    path = scratch_path(spark, "predicate")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    tables.replace_where(orders, path, None)
    load = orders.where("o_totalprice > 100000").withColumn("o_orderpriority", F.lit("reloaded"))
    for _ in range(2):
        tables.replace_where(load, path, "o_totalprice > 100000")
    return tables.read_versioned(spark, path)


def _copy(spark, sf, file_format):
    """Suppliers exported as files, then loaded over a table that holds them, after deleting by condition."""
    path, files = scratch_path(spark, "copy"), scratch_path(spark, "files")
    suppliers = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    writer = suppliers.write.option("header", True) if file_format == "csv" else suppliers.write
    writer.format(file_format).save(files)
    tables.replace_where(suppliers, path, None)
    tables.copy_into(spark, files, path, suppliers.schema, file_format, "s_acctbal >= 0")
    return tables.read_versioned(spark, path)


COPY_SQL = """SELECT s_suppkey, s_name, s_acctbal FROM supplier
    UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier WHERE NOT coalesce(s_acctbal >= 0, false)"""


@query(COPY_SQL)
def copy_csv(spark, sf):
    return _copy(spark, sf, "csv")


@query(COPY_SQL)
def copy_json(spark, sf):
    return _copy(spark, sf, "json")


@query(COPY_SQL)
def copy_parquet(spark, sf):
    return _copy(spark, sf, "parquet")


@query("SELECT p_partkey, p_name FROM part UNION ALL SELECT p_partkey, p_name FROM part WHERE p_size > 25")
def append_create(spark, sf):
    """Created by the first append; the second gives its columns in another order and is matched by name."""
    path = scratch_path(spark, "append")
    parts = table(spark, sf, "part")
    tables.append(parts.select("p_partkey", "p_name"), path)
    tables.append(parts.where("p_size > 25").select("p_name", "p_partkey"), path)
    return spark.read.parquet(path)


@query("SELECT 2 * count(*) AS stored, count(*) AS added FROM part")
def parquet_append(spark, sf):
    path = scratch_path(spark, "bulk")
    added = [tables.append_parquet(spark, f"{sf}/part.parquet", path) for _ in range(2)]
    return spark.read.parquet(path).agg(
        F.count(F.lit(1)).alias("stored"), F.lit(added[1]).cast("long").alias("added")
    )


@query("SELECT r_name, count(*) AS nations FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'ASIA' GROUP BY 1")
def adhoc_sql(spark, sf):
    table(spark, sf, "nation").createOrReplaceTempView("adhoc_nation")
    table(spark, sf, "region").createOrReplaceTempView("adhoc_region")
    return tables.query(
        spark,
        """SELECT r_name, count(*) AS nations FROM adhoc_nation JOIN adhoc_region ON n_regionkey = r_regionkey
        WHERE r_name <> :excluded GROUP BY r_name""",
        excluded="ASIA",
    )


# Checks ----------------------------------------------------------------------------------


@query(
    f"""WITH {TRIPS_SQL}, checked AS (SELECT unnest(['pickup_is_timestamp', 'dropoff_is_timestamp', 'fare_positive', 'passengers_in_range', 'pickup_not_in_future']) AS rule,
      unnest([tpep_pickup_datetime IS NULL, tpep_dropoff_datetime IS NULL, NOT coalesce(fare_amount > 0, false),
        NOT coalesce(passenger_count BETWEEN 1 AND 8, false), NOT coalesce(tpep_pickup_datetime <= TIMESTAMP '2001-01-01', false)]) AS broken FROM trips)
    SELECT rule, count(*) AS rows, count(*) FILTER (broken) AS failed FROM checked GROUP BY 1"""
)
def dq_expectations(spark, sf):
    rules = quality.trip_rules(F.lit("2001-01-01 00:00:00").cast("timestamp_ntz"))
    return quality.expectations(trips(spark, sf), rules)


NULLABLE_SQL = """nullable AS (SELECT CASE WHEN l_orderkey % 50 = 0 THEN NULL ELSE l_quantity END AS quantity,
  CASE WHEN l_orderkey % 500 = 0 THEN NULL ELSE l_shipdate END AS shipdate FROM lineitem)"""


@query(
    f"""WITH {NULLABLE_SQL}, long AS (SELECT unnest(['quantity', 'shipdate']) AS column_name, unnest([quantity IS NULL, shipdate IS NULL]) AS gone FROM nullable),
    agg AS (SELECT column_name, count(*) AS rows, count(*) FILTER (gone) AS nulls FROM long GROUP BY 1)
    SELECT *, round_even(nulls / rows * 1e6, 0) / 1e6 AS null_rate, CAST(nulls / rows < 0.01 AS INT) AS passed FROM agg"""
)
def null_rates(spark, sf):
    key = F.col("l_orderkey")
    nullable = table(spark, sf, "lineitem").select(
        F.when(key % 50 != 0, F.col("l_quantity")).alias("quantity"),
        F.when(key % 500 != 0, F.col("l_shipdate")).alias("shipdate"),
    )
    return quality.null_rates(nullable, ["quantity", "shipdate"])


@query("SELECT count(*) AS row_count, CAST(count(*) >= 100000 AS INT) AS passed FROM lineitem")
def row_count_check(spark, sf):
    return quality.check_row_count(table(spark, sf, "lineitem"))


@query(
    """SELECT (SELECT count(*) FROM lineitem) AS row_count, 4 * count(*) AS expected,
    CAST(abs((SELECT count(*) FROM lineitem) - 4 * count(*)) <= 0.05 * 4 * count(*) AS INT) AS passed FROM orders"""
)
def count_tolerance(spark, sf):
    return quality.check_loaded_count(table(spark, sf, "lineitem"), 4 * table(spark, sf, "orders").count())


@query(
    """SELECT 'orders' AS table_name, 'tpep_pickup_datetime,tpep_dropoff_datetime,passenger_count,trip_distance,fare_amount,total_amount,PULocationID,DOLocationID' AS missing,
      count(*) AS rows FROM orders UNION ALL SELECT 'trips', '', count(*) FROM lineitem"""
)
def required_columns(spark, sf):
    """A table of another kind lacks every trip column; trips lack none. The check itself reads the schema only."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table_name"), F.lit(",".join(src.missing_columns(df))).alias("missing"), "rows"
        )
        for name, df in (("orders", table(spark, sf, "orders")), ("trips", trips(spark, sf)))
    ]
    return parts[0].unionByName(parts[1])


@query(
    """WITH prices AS (SELECT o_totalprice AS v FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'),
    bounds AS (SELECT quantile_cont(v, 0.01) AS low, quantile_cont(v, 0.99) AS high FROM prices)
    SELECT round_even(low * 1e4, 0) / 1e4 AS low, round_even(high * 1e4, 0) / 1e4 AS high, count(*) AS rows,
      count(*) FILTER (o_totalprice BETWEEN low AND high) AS inside
    FROM orders, bounds WHERE o_orderdate >= TIMESTAMP '2000-01-01' GROUP BY low, high"""
)
def historical_bounds(spark, sf):
    orders = table(spark, sf, "orders")
    cut = F.lit("2000-01-01 00:00:00").cast("timestamp_ntz")
    bounds = quality.historical_bounds(orders.where(F.col("o_orderdate") < cut), "o_totalprice").first()
    load = orders.where(F.col("o_orderdate") >= cut)
    return quality.share_within(load, "o_totalprice", bounds["low"], bounds["high"]).select(
        round_even(F.lit(bounds["low"]), 4).alias("low"),
        round_even(F.lit(bounds["high"]), 4).alias("high"),
        "rows",
        "inside",
    )


@query("SELECT count(*) AS rows, count(*) FILTER (vec_id % 10 = 0) AS wrong_dimension FROM embeddings")
def dimension_check(spark, sf):
    cut = F.when(F.col("vec_id") % 10 == 0, F.slice("embedding", 1, 63)).otherwise(F.col("embedding"))
    return quality.check_dimension(table(spark, sf, "embeddings").withColumn("embedding", cut), 64)


@query("SELECT doc_id, quality AS segment_id FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE lang <> 'fr')")
def orphan_check(spark, sf):
    children = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("segment_id"))
    return quality.orphans(children, table(spark, sf, "documents").where("lang <> 'fr'"), "doc_id")


@query("SELECT doc_id, quality AS segment_id FROM labels WHERE doc_id IN (SELECT doc_id FROM documents WHERE lang <> 'fr')")
def orphan_cascade(spark, sf):
    children = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("segment_id"))
    return quality.cascade(children, table(spark, sf, "documents").where("lang <> 'fr'"), "doc_id")


@query(
    "SELECT 'documents' AS table_name, count(*) AS rows FROM documents UNION ALL SELECT 'embeddings', count(*) FROM embeddings UNION ALL SELECT 'lineitem', count(*) FROM lineitem"
)
def row_counts(spark, sf):
    parts = [
        table(spark, sf, t).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(t).alias("table_name"), "rows")
        for t in ("documents", "embeddings", "lineitem")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
