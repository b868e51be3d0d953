"""Segment prediction: the centroid closest to an embedded text."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmentry import fixed_values as fv
from segmentry.functions.matrix import MAX_MATRIX_BYTES, bounded_rows, nearest_row
from segmentry.functions.ordering import global_row_number
from segmentry.operators.search import exact_top_k
from segmentry.operators.segments import segment_name
from segmentry.operators.vectors import Encoder, embed_reviews
from segmentry.session import checkpointed


def nearest_centroid(
    vectors: DataFrame,
    centroids: DataFrame,
    record_id: str = "record_id",
    vector: str = "embedding",
    limit_bytes: int = MAX_MATRIX_BYTES,
) -> DataFrame:
    """Adds ``segment_id`` and ``similarity`` of the centroid with the largest inner product.

    ``centroids``: segment_id, centroid; ties go to the lowest id. Centroids are broadcast once their
    size has been measured, and the vectors never move; more centroids than that are searched in blocks.
    """
    model = centroids.select("segment_id", "centroid")
    rows = bounded_rows(model, limit_bytes)
    if rows == []:
        raise ValueError("no centroids")
    if rows is not None:
        ids = [r["segment_id"] for r in rows]
        matrix = np.array([r["centroid"] for r in rows], dtype=np.float64)
        best = nearest_row(vectors.sparkSession, ids, matrix)
        return (
            vectors.withColumn("_n", best(vector))
            .select("*", F.col("_n.id").alias("segment_id"), F.col("_n.score").alias("similarity"))
            .drop("_n")
        )
    # Zero-padded numbers in the order of the ids compare as text the way the ids do, which keeps the rule for ties.
    numbered = global_row_number(model, "segment_id", "_number")
    numbered = checkpointed(numbered.withColumn("_number", F.lpad(F.col("_number").cast("string"), 19, "0")))
    # A row id of its own: record ids may be null or repeated. It is stored, so both reads see the same.
    vectors = checkpointed(vectors.withColumn("_row", F.monotonically_increasing_id()))
    store = numbered.select("_number", F.col("centroid").alias(vector))
    found = exact_top_k(vectors, store, "_row", "_number", k=1, vector=vector, limit_bytes=limit_bytes)
    found = found.join(numbered.select("_number", "segment_id"), F.col("record_id") == F.col("_number")).select(
        F.col("query_id"), F.col("segment_id").cast("int").alias("segment_id"), F.col("score").alias("similarity")
    )
    return vectors.join(found, F.col("_row").cast("string") == F.col("query_id")).drop("query_id", "_row")


def confidence(similarity: Column) -> Column:
    """Cosine moved from [-1, 1] to [0, 1]."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), (similarity + 1.0) / 2.0))


def predict_segments(
    reviews: DataFrame,
    centroids: DataFrame,
    record_id: str = "id",
    text: str = "text",
    clean: bool = True,
    make_encoder: Callable[[], Encoder] | None = None,
    dim: int = fv.EMBEDDING_DIM,
    names: dict[int, str] | None = None,
) -> DataFrame:
    """Clean, embed, assign, name: record_id, segment_id, segment_label, confidence."""
    return name_segments(embed_reviews(reviews, record_id, text, make_encoder=make_encoder, dim=dim, clean=clean), centroids, names)


def name_segments(vectors: DataFrame, centroids: DataFrame, names: dict[int, str] | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """The same for records that are embedded already: rows of the vector table. ``keep`` names columns that stay."""
    return nearest_centroid(vectors, centroids).select(
        "record_id",
        "segment_id",
        segment_name(F.col("segment_id"), names).alias("segment_label"),
        confidence(F.col("similarity")).alias("confidence"),
        *keep,
    )
