"""Reviews to segments: normalise, clean, embed, cluster, describe, assign, report."""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmentry import fixed_values as fv
from segmentry.operators import clustering, density, hierarchy, reviews, segments, vectors
from segmentry.operators.clustering import Clustering
from segmentry.session import checkpointed, size_shuffles
from segmentry.sources import tables
from segmentry.sources.reviews import normalize


@dataclass(frozen=True)
class Run:
    run_id: str
    clustering: Clustering
    assignments: DataFrame
    breakdown: DataFrame
    metrics: DataFrame


def valid_reviews(raw: DataFrame, min_chars: int = fv.MIN_REVIEW_CHARS) -> DataFrame:
    """Normalised reviews with cleaned text, short and repeated texts removed. ``text`` holds the cleaned text."""
    clean = reviews.with_clean_text(normalize(raw, min_chars))
    return (
        reviews.deduplicate(clean.where(F.length("clean") >= fv.MIN_CLEAN_CHARS), "clean", "id")
        .drop("text", "fingerprint")
        .withColumnRenamed("clean", "text")
    )


def cluster(
    stored: DataFrame, algorithm: str = "kmeans", k: int = fv.N_SEGMENTS, core_share: float = 0.9, **options
) -> Clustering:
    """K-Means on reduced vectors (``kmeans``), segments of any density by stability (``density``), or density segments
    at the one distance where ``core_share`` of the records is core (``density_cut``)."""
    if algorithm == "kmeans":
        return clustering.run_kmeans(stored, k, **options)
    started = time.perf_counter()
    reduced = checkpointed(clustering.reduce_dimensions(stored))
    if algorithm == "density":
        labels = checkpointed(hierarchy.stability_segments(reduced, "record_id", vector="reduced", **options))
    else:
        eps = density.eps_at_quantile(reduced, "record_id", core_share, "reduced")
        labels = density.density_segments(reduced, "record_id", eps, vector="reduced", **options)
    return clustering.describe_run(reduced.join(labels, "record_id"), "density", started)


def run(
    raw: DataFrame,
    base: str,
    algorithm: str = "kmeans",
    k: int = fv.N_SEGMENTS,
    run_id: str | None = None,
    **options,
) -> Run:
    """The whole job. Vectors already stored are not embedded again; assignments are replaced by record."""
    spark = raw.sparkSession
    run_id = run_id or uuid.uuid4().hex
    # Cleaned once, kept as a table: embedding and assignment both read it.
    valid_reviews(raw).write.mode("overwrite").parquet(f"{base}/reviews/run_id={run_id}")
    size_shuffles(spark, f"{base}/reviews/run_id={run_id}")
    ready = spark.read.parquet(f"{base}/reviews/run_id={run_id}")
    vectors_path, assignments_path = f"{base}/embeddings", f"{base}/segment_assignments"
    # The text is clean already, so the embedding step does not clean it a second time.
    vectors.embed_new(spark, ready, vectors_path, clean=False)
    # Vectors of several model versions live side by side; one space is clustered.
    stored = vectors.of_model(tables.read_keyed(spark, vectors_path))
    result = cluster(stored, algorithm, k, **options)
    clustering.save_run(result, f"{base}/segments", run_id)

    labels = spark.read.parquet(f"{base}/segments/labels").where(F.col("run_id") == run_id).drop("run_id")
    # All stored vectors are clustered, so records of earlier runs need their facts again. Of every record the facts
    # of the run that brought it last are kept, without its text.
    facts = ready.select("id", "rating", "customer_id", "product_id")
    tables.replace_by_key(facts, f"{base}/record_facts", "id")
    assigned = segments.assignments(labels, tables.read_keyed(spark, f"{base}/record_facts"), F.current_timestamp())
    tables.replace_by_key(assigned, assignments_path, "record_id")
    written = tables.read_keyed(spark, assignments_path)
    summary = spark.read.parquet(f"{base}/segments/summary").where(F.col("run_id") == run_id)
    metrics = summary.withColumnRenamed("silhouette", "silhouette_score").unpivot(
        ["run_id"], ["silhouette_score", "davies_bouldin", "noise_fraction", "elapsed_seconds"], "metric", "value"
    )
    # A repeated run replaces its own metrics.
    metrics.drop("run_id").write.mode("overwrite").parquet(f"{base}/run_metrics/run_id={run_id}")
    return Run(run_id, result, written, segments.breakdown(written), metrics)
