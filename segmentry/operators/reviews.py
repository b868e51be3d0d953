"""Review features and text cleaning over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmentry import fixed_values as fv
from segmentry.functions import text as tx
from segmentry.functions.numeric import flag
from segmentry.session import checkpointed
from segmentry.sources.tables import first_per_key


def with_review_features(reviews: DataFrame, text: str = "text") -> DataFrame:
    """Adds length, words, punctuation, polarity and lexicon score; without a rating column it counts as 3."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rating = F.col("rating") if "rating" in reviews.columns else F.lit(fv.DEFAULT_RATING)
    return reviews.withColumns(
        {
            "text_length": F.length(body),
            "word_count": tx.word_count(body),
            "has_exclamation": flag(F.contains(body, F.lit("!"))),
            "has_question": flag(F.contains(body, F.lit("?"))),
            "is_positive": flag(rating >= fv.POSITIVE_RATING),
            "is_negative": flag(rating <= fv.NEGATIVE_RATING),
            "sentiment_proxy": tx.sentiment_proxy(body),
        }
    )


def with_clean_text(df: DataFrame, text: str = "text", name: str = "clean", **options) -> DataFrame:
    return df.withColumn(name, tx.clean_text(F.col(text), **options))


def deduplicate(df: DataFrame, clean: str, order: str) -> DataFrame:
    """One row per cleaned text: the first in the given order."""
    hashed = df.withColumn("fingerprint", tx.fingerprint(F.col(clean)))
    return first_per_key(hashed, "fingerprint", order)


def batch_clean(
    df: DataFrame,
    row_id: str,
    text: str = "text",
    drop_duplicates: bool = False,
    filter_invalid: bool = True,
    min_length: int = fv.MIN_CLEAN_CHARS,
    **options,
) -> DataFrame:
    """Cleaned texts with the id of the row they came from; validity is checked first, then repeats."""
    out = with_clean_text(df, text, **options).select(row_id, "clean")
    if filter_invalid:
        # As in the cleaner itself, length is judged on the text cleaned once more.
        out = out.where(tx.is_long_enough(tx.clean_text(F.col("clean"), **options), min_length))
    return deduplicate(out, "clean", row_id).drop("fingerprint") if drop_duplicates else out


def tagged(
    df: DataFrame,
    row_id: str,
    text: str = "text",
    min_length: int = fv.MIN_CLEAN_CHARS,
    **options,
) -> DataFrame:
    """``reason`` of every row: valid, filtered (too short) or duplicate; with its fingerprint.

    Texts are cleaned once, into a narrow table of fingerprints. The first row of each fingerprint is
    a minimum that is combined on the map side, and it is attached by the unique row id. Copies of one
    text, however many, never meet in one task.
    """
    clean = with_clean_text(df, text, **options)
    narrow = checkpointed(
        clean.select(
            row_id,
            F.when(tx.is_long_enough(F.col("clean"), min_length), tx.fingerprint(F.col("clean"))).alias("fingerprint"),
        )
    )
    first = (
        narrow.where(F.col("fingerprint").isNotNull())
        .groupBy("fingerprint")
        .agg(F.min(row_id).alias(row_id))
        .select(row_id, F.lit(True).alias("_first"))
    )
    reason = (
        F.when(F.col("fingerprint").isNull(), F.lit("filtered"))
        .when(F.col("_first"), F.lit("valid"))
        .otherwise(F.lit("duplicate"))
    )
    return narrow.join(first, row_id, "left").withColumn("reason", reason).drop("_first")


def preprocess_counts(df: DataFrame, text: str = "text", min_length: int = fv.MIN_CLEAN_CHARS, **options) -> DataFrame:
    """One row: total, filtered, duplicates, valid. Two aggregations, no row keeps its text past the first."""
    hashed = with_clean_text(df, text, **options).select(
        F.when(tx.is_long_enough(F.col("clean"), min_length), tx.fingerprint(F.col("clean"))).alias("fp")
    )
    per_text = hashed.groupBy("fp").agg(F.count(F.lit(1)).alias("n"))
    return per_text.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        F.coalesce(F.sum(F.when(F.col("fp").isNull(), F.col("n"))), F.lit(0)).alias("filtered"),
        F.coalesce(F.sum(F.when(F.col("fp").isNotNull(), F.col("n") - 1)), F.lit(0)).alias("duplicates"),
        F.count("fp").alias("valid"),
    )


def in_language(df: DataFrame, language: str = "en", column: str = "lang") -> DataFrame:
    return df.where(F.col(column) == language)


def validate_requests(df: DataFrame, record_id: str = "record_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected with ``reason``). Batches have no size limit here; that was the transport's."""
    low, high = fv.REQUEST_TEXT_RANGE
    length = F.coalesce(F.length(text), F.lit(0))
    reason = (
        F.when(F.col(record_id).isNull(), F.lit("missing record_id"))
        .when(length < low, F.lit("empty text"))
        .when(length > high, F.lit("text too long"))
    )
    checked = df.withColumn("reason", reason)
    return checked.where(F.col("reason").isNull()).drop("reason"), checked.where(F.col("reason").isNotNull())
