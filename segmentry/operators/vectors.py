"""Vector tables: normalising, embedding text, idempotent writes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segmentry import fixed_values as fv
from segmentry import schemas
from segmentry.functions import text as tx
from segmentry.session import stored
from segmentry.sources import filters, tables

HASH_MODEL = ("hashing-tf", "1")


def l2_normalize(df: DataFrame, column: str = "embedding", element: str = "float32") -> DataFrame:
    """Vectors scaled to unit length; an all-zero vector stays zero."""
    vec = df.withColumn("_v", array_to_vector(F.col(column).cast("array<double>")))
    unit = Normalizer(p=2.0, inputCol="_v", outputCol="_u").transform(vec)
    return unit.withColumn(column, vector_to_array("_u", element)).drop("_v", "_u")


def term_vectors(df: DataFrame, text: str, dim: int = fv.EMBEDDING_DIM) -> DataFrame:
    """Adds ``tf``: the hashed word counts of a text. Stays in the JVM."""
    tokens = df.withColumn("_tokens", tx.words(F.col(text)))
    return HashingTF(numFeatures=dim, inputCol="_tokens", outputCol="tf").transform(tokens).drop("_tokens")


def hash_embed(df: DataFrame, text: str = "clean", dim: int = fv.EMBEDDING_DIM) -> DataFrame:
    """Adds ``embedding``: unit-length hashed word counts over the whole text."""
    unit = Normalizer(p=2.0, inputCol="tf", outputCol="_u").transform(term_vectors(df, text, dim))
    return unit.withColumn("embedding", vector_to_array("_u", "float32")).drop("tf", "_u")


Encoder = Callable[[list[str]], "list[list[float]]"]


def model_embed(
    df: DataFrame,
    make_encoder: Callable[[], Encoder],
    text: str = "clean",
    batch: int = fv.EMBEDDING_BATCH,
) -> DataFrame:
    """Adds ``embedding`` from any sentence encoder.

    ``make_encoder`` runs once per task and returns a function from texts to vectors; it gets at most
    ``batch`` texts at a time.
    """
    schema = T.StructType([*df.schema.fields, schemas.VECTOR["embedding"]])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = make_encoder()
        for records in batches:
            for start in range(0, records.num_rows, batch):
                part = records.slice(start, batch)
                texts = [t or "" for t in part.column(text).to_pylist()]
                vectors = pa.array([list(v) for v in encoder(texts)], pa.list_(pa.float32()))
                yield pa.RecordBatch.from_arrays([*part.columns, vectors], [*part.schema.names, "embedding"])

    return df.mapInArrow(encode, schema)


def embed_reviews(
    reviews: DataFrame,
    record_id: str = "id",
    text: str = "text",
    model: tuple[str, str] = HASH_MODEL,
    make_encoder: Callable[[], Encoder] | None = None,
    dim: int = fv.EMBEDDING_DIM,
    clean: bool = True,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Rows of the vector table: clean, encode, stamp with model name and version.

    A missing text is embedded as the empty text. ``keep`` names columns of the reviews that stay beside the vectors.
    """
    body = tx.clean_text(F.col(text)) if clean else F.coalesce(F.col(text), F.lit(""))
    ready = reviews.select(F.col(record_id).cast("string").alias("record_id"), body.alias("clean"), *keep)
    vectors = model_embed(ready, make_encoder) if make_encoder else hash_embed(ready, "clean", dim)
    return vectors.select(
        "record_id",
        "embedding",
        F.lit(model[0]).alias("model_name"),
        F.lit(model[1]).alias("model_version"),
        F.current_timestamp().alias("created_at"),
        *keep,
    )


def of_model(vectors: DataFrame, model: tuple[str, str] = HASH_MODEL) -> DataFrame:
    """The vectors of one model version."""
    return vectors.where((F.col("model_name") == model[0]) & (F.col("model_version") == model[1]))


def not_embedded(reviews: DataFrame, vectors: DataFrame, record_id: str = "id", model: tuple[str, str] = HASH_MODEL) -> DataFrame:
    """Reviews without a vector of this model version. The vector table itself is the ledger."""
    done = of_model(vectors, model).select(F.col("record_id").cast(reviews.schema[record_id].dataType).alias(record_id))
    return reviews.join(done, record_id, "left_anti")


def append_vectors(vectors: DataFrame, path: str, dim: int = fv.EMBEDDING_DIM) -> None:
    """Normalises and appends; repeats of an id are allowed. A wrong dimension fails the write."""
    checked = vectors.withColumn(
        "embedding",
        F.when(F.size("embedding") == dim, F.col("embedding")).otherwise(
            F.raise_error(F.lit(f"vector is not of dimension {dim}"))
        ),
    )
    tables.append(l2_normalize(checked), path)


def first_records(reviews: DataFrame, record_id: str, order: str | None = None) -> DataFrame:
    """The first row of every record by ``order``, or by the place in the input where no order is given."""
    place = F.col(order) if order else F.monotonically_increasing_id()
    return tables.first_per_key(reviews.withColumn("_place", place), record_id, "_place").drop("_place")


def embed_new(
    spark: SparkSession,
    reviews: DataFrame,
    path: str,
    record_id: str = "id",
    model: tuple[str, str] = HASH_MODEL,
    text: str = "text",
    order: str | None = None,
    **options,
) -> None:
    """Embeds only what the table lacks, so a repeated or resumed run does no work twice.

    Known and repeated records are removed before the encoder runs: both steps shuffle by record, and
    no vector is made that would not be stored. Vectors of several model versions live side by side. Of a
    repeated record the first row counts (``first_records``).
    """
    reviews = first_records(reviews, record_id, order)
    # The filter knows a record by its id and model version. A table without one from its first load on is read instead.
    stamp = F.concat_ws("\n", F.col(record_id).cast("string"), F.lit(model[0]), F.lit(model[1]))
    stamped, begun = reviews.withColumn("_stamp", F.when(F.col(record_id).isNotNull(), stamp)), tables.exists(spark, path)
    filtered = not begun or filters.exists(spark, path)
    if begun and filtered:
        known = tables.read_keyed(spark, path)
        known = known.select(F.concat_ws("\n", "record_id", "model_name", "model_version").alias("_stamp"))
        stamped = stored(filters.not_stored(stamped, path, "_stamp", known))
    elif begun:
        stamped = not_embedded(stamped, tables.read_keyed(spark, path), record_id, model)
    else:
        stamped = stored(stamped)
    if filtered:
        filters.add(stamped, path, "_stamp")
    tables.append_keyed(embed_reviews(stamped.drop("_stamp"), record_id, text, model, **options), path, "record_id")
