"""Review files: scan, column mapping, required fields, type normalisation, batches, new input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from segmentry import fixed_values as fv
from segmentry import schemas
from segmentry.functions import text as tx
from segmentry.functions.ordering import global_row_number


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """One object per line for ``.jsonl``, one array per file otherwise. A missing path raises.

    An array file is one indivisible document and is parsed by one task; large inputs belong in JSON
    lines, which Spark splits.
    """
    reader = spark.read.schema(schemas.REVIEW_RAW)
    if not path.rstrip("/").endswith(".jsonl"):
        reader = reader.option("multiLine", True)
    return reader.json(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def with_canonical_columns(raw: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    """Renames source columns to the canonical ones; where both exist the source value wins if not null."""
    names = names or fv.REVIEW_COLUMN_NAMES
    columns: dict[str, Column] = {}
    for source, target in names.items():
        present = [c for c in dict.fromkeys((source, target)) if c in raw.columns]
        if present:
            columns[target] = F.coalesce(*map(F.col, present))
    others = [c for c in raw.columns if c not in names and c not in columns]
    return raw.select(*others, *[value.alias(name) for name, value in columns.items()])


def required_fields(min_chars: int = fv.MIN_REVIEW_CHARS) -> Column:
    """Id and text present and non-empty, text long enough before it is stripped."""
    return (
        F.col("id").isNotNull()
        & (F.col("id").cast("string") != "")
        & F.col("text").isNotNull()
        & (F.length("text") >= min_chars)
        & (F.length("text") > 0)
    )


def integer_rating(rating: Column) -> Column:
    """Whole rating; decimals are cut, missing and unreadable ones become 0."""
    return F.coalesce(
        rating.try_cast("int"), rating.try_cast("double").try_cast("int"), F.lit(0)
    )


def normalize(raw: DataFrame, min_chars: int = fv.MIN_REVIEW_CHARS, names: dict[str, str] | None = None) -> DataFrame:
    """Canonical, valid and typed reviews."""
    mapped = with_canonical_columns(raw, names).where(required_fields(min_chars))
    rating = integer_rating(F.col("rating")) if "rating" in mapped.columns else F.lit(0)
    return mapped.withColumns(
        {
            "id": F.col("id").cast("string"),
            "text": tx.strip_space(F.col("text")),
            "rating": rating,
        }
    )


def bad_ratings(raw: DataFrame) -> DataFrame:
    """How many ratings are missing, and how many are present but not a number."""
    rating = with_canonical_columns(raw).select(F.col("rating").cast("string").alias("rating"))
    return rating.agg(
        F.count_if(F.col("rating").isNull()).alias("missing"),
        F.count_if(
            F.col("rating").isNotNull() & F.col("rating").try_cast("double").isNull()
        ).alias("unreadable"),
    )


def load_all(spark: SparkSession, path: str, min_chars: int = fv.MIN_REVIEW_CHARS) -> DataFrame:
    """Scan and normalise in one lazy DataFrame, with the file every row came from."""
    raw = read_json(spark, path).withColumn("source_file", F.col("_metadata.file_path"))
    return normalize(raw, min_chars)


def with_batches(df: DataFrame, order: str, batch_size: int) -> DataFrame:
    """Adds ``batch_index`` from 0 and ``total_records``, the number of rows up to the end of the batch."""
    numbered = global_row_number(df, order, "_row")
    last = df.count()
    batch = F.floor((F.col("_row") - 1) / batch_size)
    return numbered.withColumns(
        {
            "batch_index": batch,
            "total_records": F.least((batch + 1) * batch_size, F.lit(last)),
        }
    ).drop("_row")


def unseen_paths(found: DataFrame, ledger: DataFrame) -> DataFrame:
    """Input files that no earlier run recorded, both sides as a ``path`` column."""
    return found.select("path").distinct().join(ledger.select("path"), "path", "left_anti")
