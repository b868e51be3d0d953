"""Run log, pipeline statistics, batch fingerprints, metric gate, stalled runs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from segmentry import fixed_values as fv
from segmentry import schemas
from segmentry.sources import tables


def log_run(
    spark: SparkSession,
    path: str,
    dag_id: str,
    run_id: str,
    target_month: str | None,
    row_count: int,
    status: str = "success",
    completed_at: dt.datetime | None = None,
) -> None:
    """Writes one run; a repeated run_id replaces its earlier row."""
    done = completed_at or dt.datetime.now(dt.timezone.utc)
    row = spark.createDataFrame([(dag_id, run_id, target_month, row_count, status, done)], schemas.RUN_LOG)
    log_runs(row, path)


def log_runs(finished: DataFrame, path: str) -> None:
    """Writes finished runs (columns of the run log); repeated run ids replace their earlier rows."""
    tables.replace_by_key(finished.select(*schemas.RUN_LOG.fieldNames()), path, "run_id", buckets=1)


def pipeline_stats(statuses: DataFrame, batch_size: int = fv.EMBEDDING_BATCH, elapsed_seconds: float = 0.0) -> DataFrame:
    """One row from a ``status`` column (processed, skipped, failed): counts, batches, throughput, success."""
    total = F.count(F.lit(1))
    processed = F.count_if(F.col("status") == "processed")
    return statuses.agg(
        total.alias("total_records"),
        processed.alias("processed_records"),
        F.count_if(F.col("status") == "skipped").alias("skipped_records"),
        F.count_if(F.col("status") == "failed").alias("failed_records"),
        F.ceil(total / batch_size).alias("total_batches"),
        (processed / F.lit(elapsed_seconds) if elapsed_seconds > 0 else F.lit(0.0)).alias("throughput_rps"),
        F.coalesce(F.try_divide(processed, total), F.lit(0.0)).alias("success_rate"),
    )


def batch_fingerprints(batched: DataFrame, record_id: str, batch: str = "batch_index") -> DataFrame:
    """First 16 hex digits of the SHA-256 of a batch's sorted ids. Batches have a fixed size by construction."""
    ids = F.array_join(F.sort_array(F.collect_list(F.col(record_id).cast("string"))), "|")
    return batched.groupBy(batch).agg(
        F.count(F.lit(1)).alias("records"),
        F.substring(F.sha2(ids.cast("binary"), 256), 1, 16).alias("batch_id"),
    )


def latest_metric(runs: DataFrame, stage: str, metric: str) -> Column:
    """The metric of the newest version in a stage, null if there is none."""
    chosen = runs.where((F.col("stage") == stage) & (F.col("metric") == metric))
    return chosen.agg(F.max_by("value", "version")).scalar()


def metric_gate(runs: DataFrame, metric: str = "silhouette_score", gain: float = fv.METRIC_GAIN) -> DataFrame:
    """Candidate (stage Staging) against Production; passes without a production model.

    The required gain is absolute. A candidate without the metric counts as 0.
    """
    one = runs.agg(F.count(F.lit(1)).alias("_n"))
    production = latest_metric(runs, "Production", metric)
    candidate = F.coalesce(latest_metric(runs, "Staging", metric), F.lit(0.0))
    compared = one.select(candidate.alias("candidate"), production.alias("production"))
    improvement = F.col("candidate") - F.col("production")
    return compared.withColumns(
        {
            "improvement": improvement,
            "passed": F.coalesce(improvement >= gain, F.lit(True)).cast("int"),
        }
    )


def stalled(run_log: DataFrame, now: Column | None = None, days: int = fv.STALLED_DAYS) -> DataFrame:
    """Last completion per pipeline, and whether it is more than ``days`` ago."""
    now = F.current_timestamp() if now is None else now
    return (
        run_log.groupBy("dag_id")
        .agg(F.max("completed_at").alias("last_completed"))
        .withColumn("stalled", (F.timestamp_diff("SECOND", F.col("last_completed"), now) > days * 86400).cast("int"))
    )


def overdue_months(run_log: DataFrame, months: DataFrame, now: Column, due_day: int = 2, by: tuple[str, ...] = ()) -> DataFrame:
    """Months (``target_month``, yyyy-MM) without a successful run by day ``due_day`` of the next month.

    ``by``: columns of both tables within which a month is looked for, such as the pipeline.
    """
    done = run_log.where("status = 'success'").select(*by, "target_month").distinct()
    due = F.add_months(F.to_date("target_month", "yyyy-MM"), 1) + F.make_dt_interval(days=F.lit(due_day))
    return months.where(due <= now).join(done, [*by, "target_month"], "left_anti")
