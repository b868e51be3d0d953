from __future__ import annotations

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as entry
from check_sql import rows_of
from segmentry.plans.inputs import TABLES
from segmentry.session import checkpointed, shared_dir, size_shuffles, spread


@pytest.fixture(scope="module")
def warehouse(sf):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return con


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.oracle_sql()) > 90


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns[:2] == ["pickup_month", "PULocationID"]


@pytest.mark.parametrize(
    "name",
    ["trip_features", "trip_mart", "review_normalize", "review_features", "text_clean", "page_clean", "text_dedup",
     "request_validation", "nearest_centroid", "segment_terms", "drift_verdict", "overdue_months", "error_alerts"],
)
def test_query_agrees_with_sql(spark, sf, warehouse, name):
    df = entry.queries()[name](spark, sf)
    relation = warehouse.execute(entry.oracle_sql()[name])
    names = [d[0] for d in relation.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, df.collect()) == rows_of(names, relation.fetchall())


def test_shared_folder_is_the_configured_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    before = set(Path(shared_dir(spark)).rglob("rdd-*"))
    assert checkpointed(spark.range(3)).count() == 3
    assert set(Path(shared_dir(spark)).rglob("rdd-*")) > before


def test_shuffles_grow_with_the_input_and_never_shrink(spark, sf, monkeypatch):
    import segmentry.session as session

    now = int(spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        assert size_shuffles(spark, f"{sf}/lineitem.parquet", f"{sf}/missing") == now
        monkeypatch.setattr(session, "BYTES_PER_TASK", 1024)
        assert size_shuffles(spark, f"{sf}/lineitem.parquet") > now
        assert int(spark.conf.get("spark.sql.shuffle.partitions")) > now
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", str(now))


def test_spread_leaves_well_split_tables_alone(spark):
    few, many = spark.range(0, 100, 1, 2), spark.range(0, 100, 1, 64)
    assert spread(few, "id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert spread(many, "id") is many


@pytest.mark.parametrize("name", ["overdue_months_by_pipeline", "column_distinct_estimates"])
def test_whole_operators_agree_with_sql(spark, sf, warehouse, name):
    df = entry.queries()[name](spark, sf)
    relation = warehouse.execute(entry.oracle_sql()[name])
    names = [d[0] for d in relation.description]
    found = rows_of(df.columns, df.collect())
    assert sorted(df.columns) == sorted(names) and found == rows_of(names, relation.fetchall()) and found
