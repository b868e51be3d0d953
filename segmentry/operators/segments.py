"""Segment names, lookup, enrichment, summaries and profiles."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from segmentry import fixed_values as fv
from segmentry.functions import text as tx
from segmentry.functions.numeric import round_away, round_even


def segment_name(segment_id: Column, names: dict[int, str] | None = None) -> Column:
    """The name of a segment; ids without one are called ``segment_<id>``."""
    names = fv.SEGMENT_NAMES if names is None else names
    known = F.create_map(*[F.lit(x) for x in chain.from_iterable(names.items())])
    fallback = F.concat(F.lit("segment_"), segment_id.cast("string"))
    return F.coalesce(F.try_element_at(known, segment_id.cast("int")), fallback)


def lookup(ids: DataFrame, labels: DataFrame, key: str = "record_id") -> DataFrame:
    """Every requested id, repeats included, with its segment; unknown ids get -1 / "unknown" / 0.

    ``labels`` holds one row per id. Spark broadcasts it when it is small; otherwise adaptive skew
    joins split an id that is requested very often.
    """
    known = labels.select(F.col(key), F.col("segment_id").alias("_s"))
    found = F.col("_s").isNotNull()
    return ids.join(known, key, "left").select(
        *ids.columns,
        F.coalesce("_s", F.lit(fv.NOISE)).alias("segment_id"),
        F.when(found, segment_name(F.col("_s"))).otherwise("unknown").alias("segment_label"),
        found.cast("int").alias("found"),
    )


def lookup_counts(looked_up: DataFrame) -> DataFrame:
    return looked_up.agg(
        F.count_if(F.col("found") == 1).alias("found_count"),
        F.count_if(F.col("found") == 0).alias("not_found_count"),
    )


def align(vectors: DataFrame, labels: DataFrame, key: str = "record_id") -> DataFrame:
    """Vectors with their label, -1 where there is none."""
    known = labels.select(key, F.col("segment_id").alias("_s"))
    return (
        vectors.join(known, key, "left")
        .withColumn("segment_id", F.coalesce("_s", F.lit(fv.NOISE)))
        .drop("_s")
    )


def assignments(labels: DataFrame, reviews: DataFrame, run_timestamp: Column | None = None) -> DataFrame:
    """Labels with name and the review's rating, customer and product; missing values become 0 or ""."""
    facts = reviews.select(F.col("id").alias("record_id"), "rating", "customer_id", "product_id")
    out = labels.join(facts, "record_id", "left").select(
        "record_id",
        F.col("segment_id").cast("int").alias("segment_id"),
        segment_name(F.col("segment_id")).alias("segment_label"),
        F.coalesce("rating", F.lit(0)).alias("rating"),
        F.coalesce("customer_id", F.lit("")).alias("customer_id"),
        F.coalesce("product_id", F.lit("")).alias("product_id"),
    )
    return out if run_timestamp is None else out.withColumn("run_timestamp", run_timestamp)


def breakdown(assigned: DataFrame) -> DataFrame:
    """Size and mean rating of each named segment, largest first."""
    return (
        assigned.groupBy("segment_label")
        .agg(F.count(F.lit(1)).alias("size"), round_away(F.avg("rating"), 2).alias("avg_rating"))
        .orderBy(F.col("size").desc(), "segment_label")
    )


def summary(sizes: DataFrame) -> DataFrame:
    """Size, name and share of the total, per segment (``sizes`` has one row per segment)."""
    total = sizes.agg(F.sum("size").alias("_total"))
    # The total is one row; a scalar subquery carries it without a join or a one-task window.
    share = F.coalesce(F.try_divide(F.col("size"), total.scalar()), F.lit(0.0))
    return sizes.select(
        "segment_id",
        segment_name(F.col("segment_id")).alias("segment_label"),
        "size",
        round_even(share, 4).alias("fraction"),
    )


def profile(assigned: DataFrame, text: str = "text", terms: int = 10) -> DataFrame:
    """Size, mean rating and top terms of each segment (input: segment_id, rating, text)."""
    base = assigned.groupBy("segment_id").agg(
        F.count(F.lit(1)).alias("size"), round_away(F.avg("rating"), 2).alias("avg_rating")
    )
    ranked = top_terms(assigned, text, terms)
    listed = ranked.groupBy("segment_id").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", "term"))), lambda t: t["term"]), ",").alias(
            "top_terms"
        )
    )
    return base.join(listed, "segment_id", "left").withColumn("top_terms", F.coalesce("top_terms", F.lit("")))


def top_terms(assigned: DataFrame, text: str = "text", terms: int = 10) -> DataFrame:
    """Best terms per segment: texts of the segment holding the term x ln((1 + texts) / (1 + texts holding it)).

    Counts of a term are combined on the map side, so a word that is everywhere adds one row per
    segment and task; ranks are cut to ``terms`` per task before they are shuffled.
    """
    total = assigned.agg(F.count(F.lit(1)).alias("_n"))
    per_segment = (
        assigned.select("segment_id", F.explode(F.array_distinct(tx.words(F.col(text)))).alias("term"))
        .groupBy("segment_id", "term")
        .agg(F.count(F.lit(1)).alias("texts"))
    )
    # One row per segment and term here, so a term's partition has at most as many rows as segments.
    everywhere = F.sum("texts").over(W.partitionBy("term"))
    idf = F.ln((F.lit(1.0) + total.scalar()) / (F.lit(1.0) + everywhere))
    scored = per_segment.withColumn("score", round_even(F.col("texts") * idf, 6))
    best = W.partitionBy("segment_id").orderBy(F.col("score").desc(), "term")
    return scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= terms)
