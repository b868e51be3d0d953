from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from segmentry import schemas
from segmentry.operators import quality, runs
from segmentry.sources import tables


def frame(spark, rows):
    return spark.createDataFrame(rows, "id string, val int")


def content(df):
    return sorted((r["id"] or "", r["val"]) for r in df.select("id", "val").collect())


def test_keyed_replace(spark, path):
    tables.replace_by_key(frame(spark, [("r1", 1), ("r2", 2)]), path, "id")
    for _ in range(2):
        tables.replace_by_key(frame(spark, [("r1", 10), ("r3", 3)]), path, "id")
    assert content(tables.read_keyed(spark, path)) == [("r1", 10), ("r2", 2), ("r3", 3)]


def test_keyed_replace_keeps_repeats_and_never_matches_null(spark, path):
    tables.replace_by_key(frame(spark, [("a", 1), (None, 2)]), path, "id")
    tables.replace_by_key(frame(spark, [("a", 3), ("a", 4), (None, 5)]), path, "id")
    assert content(tables.read_keyed(spark, path)) == [("", 2), ("", 5), ("a", 3), ("a", 4)]


def test_keyed_replace_with_a_hot_key(spark, path):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("id"), F.lit(1).alias("val"))
    tables.replace_by_key(rows, path, "id")
    tables.replace_by_key(rows.withColumn("val", F.lit(2)), path, "id")
    assert tables.read_keyed(spark, path).groupBy("val").count().collect()[0].asDict() == {"val": 2, "count": 3000}


def test_only_touched_buckets_are_rewritten(spark, path):
    tables.replace_by_key(frame(spark, [(f"k{i}", i) for i in range(200)]), path, "id")

    def files():
        return {r[0] for r in spark.read.parquet(path).select("_metadata.file_path").distinct().collect()}

    before = files()
    tables.replace_by_key(frame(spark, [("k7", -7)]), path, "id")
    after = files()
    assert len(before & after) == len({f.rsplit("/", 2)[1] for f in before}) - 1
    assert tables.read_keyed(spark, path).count() == 200


def test_insert_if_absent(spark, path):
    load = frame(spark, [("a", 2), ("a", 1), ("b", 5)])
    for _ in range(2):
        tables.insert_if_absent(load, path, "id", "val")
    tables.insert_if_absent(frame(spark, [("a", 0), ("c", 9)]), path, "id", "val")
    assert content(tables.read_keyed(spark, path)) == [("a", 1), ("b", 5), ("c", 9)]
    with pytest.raises(Exception, match="null id"):
        tables.insert_if_absent(frame(spark, [(None, 1)]), path, "id", "val")


def test_bucket_count_belongs_to_the_table(spark, path):
    rows = [(str(i), i) for i in range(20)]
    tables.replace_by_key(frame(spark, rows), path, "id", buckets=4)
    tables.replace_by_key(frame(spark, rows), path, "id")
    tables.insert_if_absent(frame(spark, rows), path, "id", "val")
    assert content(tables.read_keyed(spark, path)) == sorted(rows)
    for write in (tables.replace_by_key, tables.append_keyed):
        with pytest.raises(ValueError, match="4 buckets"):
            write(frame(spark, rows), path, "id", buckets=64)


def test_append_matches_by_name(spark, path):
    tables.append(frame(spark, [("a", 1)]), path)
    tables.append(frame(spark, [("b", 2)]).select("val", "id"), path)
    assert content(spark.read.parquet(path)) == [("a", 1), ("b", 2)]
    with pytest.raises(tables.SchemaMismatch):
        tables.append(spark.createDataFrame([("c", 1.0)], "id string, val double"), path)


def test_predicate_replace_keeps_rows_where_it_is_unknown(spark, path):
    tables.replace_where(frame(spark, [("a", 1), ("b", None), ("c", 9)]), path, None)
    for version in (2, 3):
        assert tables.replace_where(frame(spark, [("d", 7)]), path, "val > 5") == version
    got = {r["id"]: r["val"] for r in tables.read_versioned(spark, path).collect()}
    assert got == {"a": 1, "b": None, "d": 7}


def test_unfinished_version_is_ignored(spark, path, tmp_path):
    tables.write_version(frame(spark, [("a", 1)]), path)
    (tmp_path / "table" / "v=2").mkdir()
    assert content(tables.read_versioned(spark, path)) == [("a", 1)]
    assert tables.write_version(frame(spark, [("b", 2)]), path) == 2
    with pytest.raises(FileNotFoundError):
        tables.read_versioned(spark, path + "-none")


@pytest.mark.parametrize("file_format", ["parquet", "csv", "json"])
def test_copy(spark, path, tmp_path, file_format):
    source = frame(spark, [("a", 1), ("b", 2)])
    files = str(tmp_path / "files")
    (source.write.option("header", True) if file_format == "csv" else source.write).format(file_format).save(files)
    for _ in range(2):
        tables.copy_into(spark, files, path, source.schema, file_format.upper(), "id IN ('a', 'b')")
    assert content(tables.read_versioned(spark, path)) == [("a", 1), ("b", 2)]


def test_bulk_append_returns_rows_added(spark, path, tmp_path):
    source = str(tmp_path / "src")
    frame(spark, [("a", 1), ("b", 2)]).write.parquet(source)
    assert [tables.append_parquet(spark, source, path) for _ in range(2)] == [2, 2]
    assert spark.read.parquet(path).count() == 4


def test_namespace_and_query(spark):
    tables.create_namespace(spark, "demo_ns")
    tables.create_namespace(spark, "demo_ns")
    assert spark.catalog.databaseExists("demo_ns")
    assert tables.query(spark, "SELECT :a + 1 AS v", a=2).first()["v"] == 3


def test_json_sink(spark, path):
    tables.write_json(frame(spark, [("a", 1)]), path)
    assert content(spark.read.schema("id string, val int").json(path)) == [("a", 1)]


def test_expectations_and_rates(spark):
    df = frame(spark, [("a", 1), (None, None), ("b", -1)])
    got = {r["rule"]: (r["rows"], r["failed"]) for r in quality.expectations(df, {"positive": F.col("val") > 0}).collect()}
    assert got == {"positive": (3, 2)}
    rates = {r["column_name"]: (r["nulls"], r["passed"]) for r in quality.null_rates(df, ["id", "val"], 0.5).collect()}
    assert rates == {"id": (1, 1), "val": (1, 1)}
    assert quality.check_row_count(df, 3).first()["passed"] == 1
    assert quality.check_loaded_count(df, 4).first()["passed"] == 0


def test_run_log_replaces_by_run_id(spark, path):
    for rows in (5, 6):
        runs.log_run(spark, path, "d", "r", "2024-01", rows, completed_at=dt.datetime(2024, 2, 2))
    log = tables.read_keyed(spark, path)
    assert [r["row_count"] for r in log.collect()] == [6]
    assert runs.stalled(log, F.lit("2024-02-06").cast("timestamp")).first()["stalled"] == 1
    assert runs.stalled(log, F.lit("2024-02-05").cast("timestamp")).first()["stalled"] == 0


def test_metric_gate(spark):
    def gate(*rows):
        df = spark.createDataFrame([("r", v, s, "silhouette_score", x) for v, s, x in rows], schemas.MODEL_RUN)
        return runs.metric_gate(df).first()["passed"]

    assert gate((1, "Staging", 0.1)) == 1
    assert gate((1, "Production", 0.5), (2, "Staging", 0.53)) == 1
    assert gate((1, "Production", 0.5), (2, "Staging", 0.51)) == 0
    assert gate((1, "Production", 0.9), (2, "Production", 0.5), (3, "Staging", 0.53)) == 1
    assert gate((1, "Production", 0.5)) == 0


def test_batch_fingerprint_ignores_order(spark):
    import hashlib

    rows = [(0, "c"), (0, "a"), (0, "b")]
    df = spark.createDataFrame(rows, "batch_index int, id string")
    expected = hashlib.sha256(b"a|b|c").hexdigest()[:16]
    for order in (df, df.orderBy("id"), df.orderBy(F.desc("id"))):
        assert runs.batch_fingerprints(order, "id").first()["batch_id"] == expected


def test_pipeline_stats_without_rows(spark):
    row = runs.pipeline_stats(spark.createDataFrame([], "status string"), elapsed_seconds=0).first()
    assert (row["total_records"], row["throughput_rps"], row["success_rate"]) == (0, 0.0, 0.0)


def test_only_touched_files_are_rewritten(spark, path):
    """Four loads of files of their own; a replacement that hits one of them leaves the others as they are."""
    for low in (0, 100, 200, 300):
        tables.replace_where(spark.range(low, low + 50).selectExpr("cast(id as string) AS id", "cast(id as int) AS val").repartition(2), path, None)
    before = tables.version_files(spark, path)
    assert len(before) == 8
    touching = frame(spark, [("new", 777)])
    version = tables.replace_where(touching, path, "val BETWEEN 110 AND 120")
    after = tables.version_files(spark, path)
    gone = set(before) - set(after)
    assert gone and all(f.startswith("data-2/") for f in gone) and len(set(after) & set(before)) == 8 - len(gone)
    rows = {r["val"] for r in tables.read_versioned(spark, path).collect()}
    assert rows == {v for low in (0, 100, 200, 300) for v in range(low, low + 50)} - set(range(110, 121)) | {777}
    # Nothing to delete: everything stays, the load is added. The earlier version can still be read.
    tables.replace_where(touching, path, "val > 5000")
    assert set(after) < set(tables.version_files(spark, path))
    assert tables.version_files(spark, path, version) == after
