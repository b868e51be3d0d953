"""Pipeline statistics, fingerprints, gates, alerts, streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from segmentry.functions.numeric import round_even
from segmentry.operators import predict, runs, sketches
from segmentry.operators.reviews import tagged
from segmentry.plans.inputs import (
    MODEL_RUNS_SQL,
    REQUESTS_SQL,
    RUN_LOG_SQL,
    model_runs,
    requests,
    run_log,
    table,
    texts,
)
from segmentry.plans.registry import query
from segmentry.plans.text_queries import CLEAN_SQL, NORMAL_SQL, RAW_SQL, TAG_SQL, raw_reviews
from segmentry.session import scratch_path, stored
from segmentry.sources import reviews as src
from segmentry.sources import tables
from segmentry.streaming import alerts, held
from segmentry.streaming import reviews as stream


@query(
    """WITH numbered AS (SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 512 AS batch_index FROM documents)
    SELECT CAST(batch_index AS BIGINT) AS batch_index, count(*) AS records,
      substr(sha256(string_agg(CAST(doc_id AS VARCHAR), '|' ORDER BY CAST(doc_id AS VARCHAR))), 1, 16) AS batch_id FROM numbered GROUP BY 1"""
)
def batch_fingerprint(spark, sf):
    batched = src.with_batches(table(spark, sf, "documents").select("doc_id"), "doc_id", 512)
    return runs.batch_fingerprints(batched, "doc_id")


@query(
    f"""WITH {TAG_SQL} SELECT count(*) AS total_records, count(*) FILTER (reason = 'valid') AS processed_records,
    count(*) FILTER (reason = 'duplicate') AS skipped_records, count(*) FILTER (reason = 'filtered') AS failed_records,
    CAST(ceil(count(*) / 512) AS BIGINT) AS total_batches, round_even(count(*) FILTER (reason = 'valid') / 8.0 * 1e6, 0) / 1e6 AS throughput_rps,
    round_even(count(*) FILTER (reason = 'valid') / count(*) * 1e6, 0) / 1e6 AS success_rate FROM tags"""
)
def pipeline_stats(spark, sf):
    tags = tagged(texts(spark, sf, "documents", "doc_id"), "doc_id", min_length=200)
    status = F.when(F.col("reason") == "valid", "processed").when(F.col("reason") == "duplicate", "skipped").otherwise("failed")
    out = runs.pipeline_stats(tags.select(status.alias("status")), elapsed_seconds=8.0)
    return out.withColumns({c: round_even(F.col(c), 6) for c in ("throughput_rps", "success_rate")})


@query(
    f"""WITH {MODEL_RUNS_SQL}, g AS (SELECT max_by(value, version) FILTER (stage = 'Staging') AS candidate, max_by(value, version) FILTER (stage = 'Production') AS production FROM runs)
    SELECT candidate, production, candidate - production AS improvement, CAST(candidate - production >= 0.02 AS INT) AS passed FROM g"""
)
def metric_gate(spark, sf):
    return runs.metric_gate(model_runs(spark, sf))


@query(
    f"""WITH {RUN_LOG_SQL} SELECT dag_id, max(completed_at) AS last_completed,
    CAST(max(completed_at) < TIMESTAMP '2001-08-01 12:00:00' - INTERVAL 3 DAY AS INT) AS stalled FROM run_log WHERE status = 'success' GROUP BY 1"""
)
def stalled_runs(spark, sf):
    now = F.lit("2001-08-01 12:00:00").cast("timestamp_ntz")
    return runs.stalled(run_log(spark, sf).where("status = 'success'"), now)


@query(
    f"""WITH {RUN_LOG_SQL}, m AS (SELECT DISTINCT target_month FROM run_log)
    SELECT target_month FROM m WHERE CAST(target_month || '-01' AS DATE) + INTERVAL 1 MONTH + INTERVAL 2 DAY <= TIMESTAMP '2001-08-01'
      AND target_month NOT IN (SELECT target_month FROM run_log WHERE status = 'success' AND dag_id = '1-URGENT' AND row_count >= 1400)"""
)
def overdue_months(spark, sf):
    """Months of the whole log without a successful urgent run that loaded enough rows."""
    log = run_log(spark, sf)
    now = F.lit("2001-08-01 00:00:00").cast("timestamp_ntz")
    return runs.overdue_months(log.where("dag_id = '1-URGENT' AND row_count >= 1400"), log.select("target_month").distinct(), now)


@query(
    f"""WITH {RUN_LOG_SQL}, per AS (SELECT concat(dag_id, '/', row_count % 50) AS dag_id, target_month, status FROM run_log),
    m AS (SELECT DISTINCT dag_id, unnest(['1995-01', '1996-02', '1997-03', '1998-04', '2001-07']) AS target_month FROM per)
    SELECT dag_id, target_month, CAST(CAST(target_month || '-01' AS DATE) + INTERVAL 1 MONTH + INTERVAL 2 DAY <= TIMESTAMP '2001-08-01'
      AND NOT EXISTS (SELECT 1 FROM per r WHERE r.status = 'success' AND r.dag_id = m.dag_id AND r.target_month = m.target_month) AS INT) AS overdue FROM m"""
)
def overdue_months_by_pipeline(spark, sf):
    """Five months of every pipeline of the log (fifty customers each), due ones without a successful run marked."""
    log = run_log(spark, sf).withColumn("dag_id", F.concat_ws("/", "dag_id", F.col("row_count") % 50))
    now = F.lit("2001-08-01 00:00:00").cast("timestamp_ntz")
    wanted = F.explode(F.array(*map(F.lit, ("1995-01", "1996-02", "1997-03", "1998-04", "2001-07")))).alias("target_month")
    months = log.select("dag_id").distinct().select("dag_id", wanted)
    late = runs.overdue_months(log, months, now, by=("dag_id",)).withColumn("overdue", F.lit(1))
    return months.join(late, ["dag_id", "target_month"], "left").select("dag_id", "target_month", F.coalesce("overdue", F.lit(0)).alias("overdue"))


@query(f"WITH {RUN_LOG_SQL} SELECT dag_id, CAST(count(*) AS BIGINT) AS row_count, 'success' AS status FROM run_log GROUP BY 1")
def run_log_write(spark, sf):
    """One logged run per pipeline, each logged twice under its run id."""
    path = scratch_path(spark, "runs")
    done = run_log(spark, sf).groupBy("dag_id").agg(F.count(F.lit(1)).alias("row_count")).select(
        "dag_id",
        F.concat(F.lit("run-"), "dag_id").alias("run_id"),
        F.lit("2001-07").alias("target_month"),
        "row_count",
        F.lit("success").alias("status"),
        F.current_timestamp().alias("completed_at"),
    )
    for _ in range(2):
        runs.log_runs(done, path)
    return tables.read_keyed(spark, path).select("dag_id", "row_count", "status")


def _windows_sql(minutes: int, slide: int) -> str:
    return f"""w AS (SELECT r.*, time_bucket(INTERVAL {slide} MINUTE, ts) - to_minutes(CAST(b.b * {slide} AS BIGINT)) AS window_start
  FROM requests r, range({minutes // slide}) b(b))"""


RATES_SQL = f"""{REQUESTS_SQL}, {_windows_sql(60, 15)}, rates AS (SELECT window_start, count(*) AS requests, count(*) FILTER (status >= 500) AS errors,
  count(*) FILTER (status >= 500) / count(*) AS error_rate, CAST(count(*) FILTER (status >= 500) / count(*) > 0.1 AS INT) AS breach FROM w GROUP BY 1)"""


def plain_time(df, *columns):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


@query(f"WITH {RATES_SQL} SELECT window_start, requests, errors, round_even(error_rate * 1e6, 0) / 1e6 AS error_rate, breach FROM rates")
def error_rate_windows(spark, sf):
    out = alerts.error_rates(requests(spark, sf), 60, 15, limit=0.1)
    return plain_time(out.withColumn("error_rate", round_even(F.col("error_rate"), 6)), "window_start")


@query(
    f"""WITH {RATES_SQL}, b AS (SELECT window_start FROM rates WHERE breach = 1)
    SELECT window_start FROM b WHERE window_start - INTERVAL 15 MINUTE IN (FROM b) AND window_start - INTERVAL 30 MINUTE IN (FROM b)
      AND window_start - INTERVAL 45 MINUTE IN (FROM b)"""
)
def error_alerts(spark, sf):
    """Windows at which the error rate has been too high for 45 minutes."""
    rates = alerts.error_rates(requests(spark, sf), 60, 15, limit=0.1)
    return plain_time(alerts.held(rates, 45, 15), "window_start")


@query(
    f"""WITH {REQUESTS_SQL}, {_windows_sql(60, 15)}, q AS (SELECT window_start, quantile_cont(latency_s, 0.99) AS p99 FROM w GROUP BY 1)
    SELECT window_start, round_even(p99 * 1e8, 0) / 1e8 AS p99, CAST(p99 > 0.1 AS INT) AS breach FROM q"""
)
def latency_p99_windows(spark, sf):
    out = alerts.p99_latencies(requests(spark, sf), 60, 15, limit=0.1)
    return plain_time(out.withColumn("p99", round_even(F.col("p99"), 8)), "window_start")


def _checked_p99(windows, incoming):
    """Adds whether the rank of each window's p99 among all its latencies is within the sketch's error."""
    slides = incoming.where("latency_s IS NOT NULL").withColumn("_slide", F.window("ts", "15 minutes").getField("start").cast("timestamp"))
    inside = alerts._in_windows(slides, 60, 15).join(windows.select("window_start", "p99"), "window_start")
    ranked = inside.groupBy("window_start").agg(
        F.count_if(F.col("latency_s") < F.col("p99")).alias("_below"), F.count_if(F.col("latency_s") <= F.col("p99")).alias("_upto"), F.count(F.lit(1)).alias("_n")
    )
    near = sketches.within_rank(F.col("_below"), F.col("_upto"), F.col("_n"), 0.99, sketches.rank_error())
    return windows.join(ranked.select("window_start", near.alias("p99_within_bound")), "window_start")


@query(f"WITH {REQUESTS_SQL}, {_windows_sql(60, 15)} SELECT window_start, count(latency_s) AS requests, true AS p99_within_bound FROM w GROUP BY 1")
def latency_sketches(spark, sf):
    """p99 of sliding windows out of stored sketches of their quarter hours, checked against all requests."""
    path, incoming = scratch_path(spark, "sketches"), requests(spark, sf)
    alerts.slide_sketches(incoming, 15).write.parquet(path)
    windows = alerts.sketched_p99(spark.read.parquet(path), 60, 15, limit=0.1)
    return plain_time(_checked_p99(windows, incoming).select("window_start", "requests", "p99_within_bound"), "window_start")


# Streams ---------------------------------------------------------------------------------


@query(f"WITH {RAW_SQL}, {NORMAL_SQL} SELECT id, rating, text FROM normal")
def stream_ingest(spark, sf):
    """Raw reviews arrive in two drops of JSON lines; the stream runs after each and takes only what is new."""
    base = scratch_path(spark, "ingest")
    raw = raw_reviews(spark, sf)
    for even in (True, False):
        part = F.pmod(F.hash("review_body"), F.lit(2)) == (0 if even else 1)
        raw.where(part).write.mode("append").json(f"{base}/in")
        stream.ingest(stream.read_reviews(spark, f"{base}/in"), f"{base}/out", f"{base}/state").awaitTermination()
    return spark.read.parquet(f"{base}/out").select("id", "rating", "text")


@query(f"WITH {CLEAN_SQL} SELECT sha256(clean) AS fingerprint FROM cleaned WHERE length(clean) >= 10 GROUP BY clean")
def stream_dedup(spark, sf):
    """Documents as a stream in one event-time hour: the same fingerprints remain as in batch."""
    base = scratch_path(spark, "dedup")
    docs = texts(spark, sf, "documents", "doc_id").select(
        "doc_id", "text", F.timestamp_seconds(F.pmod("doc_id", F.lit(3600)) + 1704067200).alias("ts")
    )
    docs.write.parquet(f"{base}/in")
    source = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", 4).parquet(f"{base}/in")
    unique = stream.clean_and_deduplicate(source, "ts", delay="2 hours").select("fingerprint")
    writer = unique.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/state")
    writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{base}/out")


@query(
    f"""WITH {REQUESTS_SQL}, {_windows_sql(60, 15)}, closed AS (SELECT window_start, count(*) AS requests, count(*) FILTER (status >= 500) / count(*) AS error_rate FROM w GROUP BY 1)
    SELECT window_start, requests, round_even(error_rate * 1e6, 0) / 1e6 AS error_rate, true AS p99_within_bound FROM closed
    WHERE window_start + INTERVAL 60 MINUTE <= (SELECT max(ts) FROM requests) - INTERVAL 10 MINUTE"""
)
def stream_alerts(spark, sf):
    """Windows closed by the watermark, appended by the stream."""
    base = scratch_path(spark, "alerts")
    incoming = requests(spark, sf)
    incoming.write.parquet(f"{base}/in")
    source = spark.readStream.schema(incoming.schema).parquet(f"{base}/in")
    windows = alerts.stream_windows(source, "10 minutes", "60 minutes", "15 minutes")
    writer = windows.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/state")
    writer.trigger(availableNow=True).start().awaitTermination()
    out = _checked_p99(spark.read.parquet(f"{base}/out"), incoming)
    out = out.select("window_start", "requests", round_even(F.col("error_rate"), 6).alias("error_rate"), "p99_within_bound")
    return plain_time(out, "window_start")


@query("SELECT CAST(doc_id AS VARCHAR) AS record_id, CAST(1 AS BIGINT) AS vectors, CAST(1 AS BIGINT) AS assigned, true AS as_in_batch FROM documents")
def stream_predict(spark, sf):
    """Documents arrive in two drops and once more from the start: one vector and one assignment each, as in batch."""
    from segmentry.plans.vector_queries import _embedded_documents, _language_centroids

    base = scratch_path(spark, "predict")
    docs = texts(spark, sf, "documents", "doc_id").select(F.col("doc_id").cast("string").alias("id"), "text")
    embedded = _embedded_documents(spark, sf)
    centres = _language_centroids(embedded)
    for drop in range(3):
        if drop < 2:
            docs.where(F.pmod(F.xxhash64("id"), F.lit(2)) == drop).write.mode("append").parquet(f"{base}/in")
        source = spark.readStream.schema(docs.schema).parquet(f"{base}/in")
        # The last run has a checkpoint of its own, so it sees everything again.
        state = f"{base}/state-{drop // 2}"
        stream.embed_and_predict(source, centres, f"{base}/vectors", f"{base}/assigned", state).awaitTermination()
    batch = predict.name_segments(embedded.drop("segment_id"), centres).select("record_id", F.col("segment_id").alias("_batch"))
    kept = tables.read_keyed(spark, f"{base}/vectors").groupBy("record_id").agg(F.count(F.lit(1)).alias("vectors"))
    placed = tables.read_keyed(spark, f"{base}/assigned").groupBy("record_id").agg(F.count(F.lit(1)).alias("assigned"), F.min("segment_id").alias("_stream"))
    both = kept.join(placed, "record_id", "full").join(batch, "record_id", "full")
    return both.select("record_id", "vectors", "assigned", F.col("_stream").eqNullSafe(F.col("_batch")).alias("as_in_batch"))


HELD_SQL = f"""{REQUESTS_SQL}, {_windows_sql(60, 15)}, closed AS (
    SELECT window_start, count(*) FILTER (status >= 500) AS errors, count(*) AS requests FROM w GROUP BY 1
    HAVING window_start + INTERVAL 60 MINUTE <= (SELECT max(ts) FROM requests) - INTERVAL 10 MINUTE),
  breaches AS (SELECT 'error_rate' AS alert, window_start FROM closed WHERE errors / requests > 0.1
    UNION ALL SELECT 'few_requests', window_start FROM closed WHERE requests < 8),
  runs AS (SELECT alert, min(window_start) AS first, max(window_start) AS last FROM (
    SELECT *, epoch(window_start) / 900 - row_number() OVER (PARTITION BY alert ORDER BY window_start) AS run FROM breaches) GROUP BY alert, run),
  seen AS (SELECT alert, 'pending' AS transition, first AS at_time FROM runs
    UNION ALL SELECT alert, 'firing', first + INTERVAL 45 MINUTE FROM runs WHERE last >= first + INTERVAL 45 MINUTE
    UNION ALL SELECT alert, 'resolved', last + INTERVAL 15 MINUTE FROM runs WHERE last >= first + INTERVAL 45 MINUTE
      AND last + INTERVAL 75 MINUTE <= (SELECT max(ts) FROM requests) - INTERVAL 10 MINUTE)"""


@query(f"WITH {HELD_SQL} SELECT alert, transition, at_time FROM seen")
def stream_held_alerts(spark, sf):
    """Pending, firing and resolved alerts of a stream that arrives in several drops, in order of time."""
    base = scratch_path(spark, "held")
    incoming = requests(spark, sf)
    span = incoming.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).first()
    conditions = {"error_rate": F.col("errors") / F.col("requests") > 0.1, "few_requests": F.col("requests") < 8}
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", held.STATE_STORE)
    try:
        for part in range(2):
            middle = span["lo"] + (span["hi"] - span["lo"]) / 2
            half = F.col("ts") < F.lit(middle) if part == 0 else F.col("ts") >= F.lit(middle)
            incoming.where(half).write.mode("append").parquet(f"{base}/in")
            source = spark.readStream.schema(incoming.schema).parquet(f"{base}/in")
            transitions = held.held_alerts(source, conditions, "10 minutes", 60, 15, 45)
            writer = transitions.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/state")
            writer.trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass") if before is None else spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    out = spark.read.parquet(f"{base}/out").select("alert", "transition", F.col("at").alias("at_time"))
    return plain_time(out, "at_time")
