from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import functions as F

from segmentry.operators import vectors as vec
from segmentry.sources import tables
from segmentry.streaming import alerts
from segmentry.streaming import reviews as stream


def drop(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(r) for r in rows))


def test_ingest_reads_only_new_files(spark, tmp_path, sample_reviews):
    source, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    drop(source, "a.jsonl", sample_reviews[:60])
    stream.ingest(stream.read_reviews(spark, str(source)), out, state).awaitTermination()
    drop(source, "b.jsonl", sample_reviews[60:])
    for _ in range(2):
        stream.ingest(stream.read_reviews(spark, str(source)), out, state).awaitTermination()
    rows = spark.read.parquet(out)
    assert rows.count() == 100 and rows.select("id").distinct().count() == 100


def test_embed_and_predict_twice_gives_the_same_tables(spark, tmp_path):
    rows = [{"id": str(i), "text": f"great product number {i}" if i % 2 else f"broken thing number {i}"} for i in range(20)]
    source = tmp_path / "in"
    drop(source, "a.jsonl", rows)
    texts = spark.createDataFrame([("0", "great product"), ("1", "broken thing")], "id string, text string")
    centres = vec.embed_reviews(texts).select(F.col("record_id").cast("int").alias("segment_id"), F.col("embedding").cast("array<double>").alias("centroid"))
    for attempt in ("one", "two"):  # a fresh checkpoint replays everything
        raw = stream.read_reviews(spark, str(source)).select("id", "text")
        query = stream.embed_and_predict(raw, centres, str(tmp_path / "vectors"), str(tmp_path / "assigned"), str(tmp_path / attempt))
        query.awaitTermination()
    assert tables.read_keyed(spark, str(tmp_path / "vectors")).count() == 20
    assigned = tables.read_keyed(spark, str(tmp_path / "assigned"))
    assert {(r["segment_id"], r["count"]) for r in assigned.groupBy("segment_id").count().collect()} == {(0, 10), (1, 10)}


def test_alert_holds_only_without_gaps(spark):
    start = dt.datetime(2024, 1, 1)

    def requests(bad_minutes, quiet=()):
        rows = []
        for m in range(30):
            if m not in quiet:
                rows += [(start + dt.timedelta(minutes=m, seconds=s), 500 if m in bad_minutes and s == 0 else 200, 0.1) for s in range(10)]
        return spark.createDataFrame(rows, "ts timestamp_ntz, status int, latency_s double")

    def held(df):
        rates = alerts.error_rates(df, length_minutes=1)
        return sorted(r[0].minute for r in alerts.held(rates).collect())

    assert held(requests({5, 6, 7})) == []
    assert held(requests({5, 6, 7, 8, 9})) == [8, 9]
    assert held(requests({5, 6, 7, 8, 9}, quiet={7})) == []


def test_windows_do_not_depend_on_the_session_zone(spark):
    at = [dt.datetime(2024, 3, 10, 2, 30), dt.datetime(2024, 3, 10, 3, 30)]
    df = spark.createDataFrame([(t, 200, 1.0) for t in at], "ts timestamp_ntz, status int, latency_s double")
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        rates = alerts.error_rates(df, length_minutes=1).orderBy("window_start").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert [(r["window_start"], r["requests"]) for r in rates] == [(t, 1) for t in at]


def test_windows_count_each_request_in_every_window(spark):
    start = dt.datetime(2024, 1, 1, 0, 10)
    df = spark.createDataFrame([(start, 500, 1.0), (start, 200, 2.0)], "ts timestamp, status int, latency_s double")
    rates = alerts.error_rates(df).orderBy("window_start").collect()
    assert [r["window_start"].minute for r in rates] == [6, 7, 8, 9, 10]
    assert {(r["requests"], r["errors"], r["error_rate"]) for r in rates} == {(2, 1, 0.5)}
    p99 = alerts.p99_latencies(df).collect()
    assert len(p99) == 5 and all(abs(r["p99"] - 1.99) < 1e-12 and r["breach"] == 1 for r in p99)
