"""Incremental reviews: ingest, clean, deduplicate, embed and predict."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from segmentry import fixed_values as fv
from segmentry import schemas
from segmentry.functions import text as tx
from segmentry.operators.predict import predict_segments
from segmentry.operators.reviews import with_clean_text
from segmentry.operators.vectors import HASH_MODEL, embed_new, first_records
from segmentry.sources import tables
from segmentry.sources.reviews import normalize


def read_reviews(spark: SparkSession, path: str, max_files: int = 100) -> DataFrame:
    """New JSON-lines files as they appear. The checkpoint of the query remembers what was read."""
    return spark.readStream.schema(schemas.REVIEW_RAW).option("maxFilesPerTrigger", max_files).json(path)


def ingest(raw: DataFrame, out: str, checkpoint: str, min_chars: int = fv.MIN_REVIEW_CHARS) -> StreamingQuery:
    """Normalises all unseen input, appends it, and stops."""
    return (
        normalize(raw, min_chars)
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def clean_and_deduplicate(
    reviews: DataFrame,
    event_time: str,
    delay: str = "1 hour",
    text: str = "text",
    min_length: int = fv.MIN_CLEAN_CHARS,
) -> DataFrame:
    """Cleaned, valid reviews; repeats of a text within the delay are dropped.

    State is one fingerprint per text, spread by fingerprint and evicted by the watermark. Repeats
    farther apart pass here and are caught by the keyed write of the vectors.
    """
    stamped = reviews.withColumn(event_time, F.col(event_time).cast("timestamp")).withWatermark(event_time, delay)
    clean = with_clean_text(stamped, text).where(tx.is_long_enough(F.col("clean"), min_length))
    return clean.withColumn("fingerprint", tx.fingerprint(F.col("clean"))).dropDuplicatesWithinWatermark(["fingerprint"])


def embed_and_predict(
    reviews: DataFrame,
    centroids: DataFrame,
    vectors_path: str,
    assignments_path: str,
    checkpoint: str,
    record_id: str = "id",
    model: tuple[str, str] = HASH_MODEL,
) -> StreamingQuery:
    """Per micro-batch: new vectors are inserted if absent, assignments replaced by key.

    Both writes give the same tables when a micro-batch is run again. Of a record that is repeated inside a
    micro-batch, the first row counts in both.
    """

    def handle(batch: DataFrame, _: int) -> None:
        batch = first_records(batch, record_id).persist()
        try:
            embed_new(batch.sparkSession, batch, vectors_path, record_id, model)
            tables.replace_by_key(predict_segments(batch, centroids, record_id), assignments_path, "record_id")
        finally:
            batch.unpersist()

    return (
        reviews.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
