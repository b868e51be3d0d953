"""What changed between two runs or two data sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmentry import fixed_values as fv
from segmentry.functions import text as tx
from segmentry.functions.numeric import round_even
from segmentry.functions.ordering import exact_quantiles, running_sum
from segmentry.session import checkpointed

# Two runs --------------------------------------------------------------------------------


def _cosine_distance(a: Column, b: Column) -> Column:
    def norm(v: Column) -> Column:
        return F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x)) + F.lit(fv.DRIFT_EPSILON)

    product = F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    return 1.0 - product / (norm(a) * norm(b))


def centroid_drift(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Cosine distance per segment id present in both runs (columns: segment_id, centroid)."""
    old = previous.select("segment_id", F.col("centroid").alias("_old"))
    return current.join(old, "segment_id").select(
        "segment_id", _cosine_distance(F.col("centroid"), F.col("_old")).alias("distance")
    )


def size_divergence(current: DataFrame, previous: DataFrame) -> DataFrame:
    """One row ``js_divergence`` (natural logarithm, not rooted) of two segment size tables."""
    old = previous.select("segment_id", F.col("size").alias("_old"))
    sizes = current.join(old, "segment_id", "full").select(
        F.coalesce("size", F.lit(0)).cast("double").alias("now"),
        F.coalesce("_old", F.lit(0)).cast("double").alias("before"),
    )
    totals = sizes.agg(
        (F.sum("now") + fv.DRIFT_EPSILON).alias("now_total"), (F.sum("before") + fv.DRIFT_EPSILON).alias("before_total")
    )
    p = F.col("now") / totals.select("now_total").scalar()
    q = F.col("before") / totals.select("before_total").scalar()
    shares = sizes.select(p.alias("p"), q.alias("q")).withColumn("m", (F.col("p") + F.col("q")) / 2.0)
    return shares.agg(
        F.coalesce((F.sum(_relative("p", "m")) + F.sum(_relative("q", "m"))) / 2.0, F.lit(0.0)).alias("js_divergence")
    )


def _relative(share: str, mean: str) -> Column:
    # The mean is positive wherever the share is.
    return F.when(F.col(share) > 0, F.col(share) * F.ln(F.col(share) / F.col(mean))).otherwise(0.0)


def segment_changes(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Segments that exist in one run only: ``segment_id`` and ``change`` (new or disappeared)."""
    now, before = current.select("segment_id"), previous.select("segment_id")
    new = now.join(before, "segment_id", "left_anti").withColumn("change", F.lit("new"))
    gone = before.join(now, "segment_id", "left_anti").withColumn("change", F.lit("disappeared"))
    return new.unionByName(gone)


def matched_segments(current: DataFrame, previous: DataFrame) -> DataFrame:
    """The previous segment most similar to each current one. Run ids are arbitrary, so comparing by
    id can report a mere renumbering as drift; renaming by this table first avoids that."""
    from segmentry.operators.search import exact_top_k

    found = exact_top_k(
        current.select("segment_id", F.col("centroid").alias("embedding")),
        previous.select("segment_id", F.col("centroid").alias("embedding")),
        "segment_id",
        "segment_id",
        k=1,
    )
    return found.select(
        F.col("query_id").cast("int").alias("segment_id"),
        F.col("record_id").cast("int").alias("previous_id"),
        F.col("score").alias("similarity"),
    )


def drift_report(
    current: DataFrame,
    previous: DataFrame,
    threshold: float = fv.CENTROID_DRIFT_LIMIT,
    size_threshold: float = fv.SIZE_DIVERGENCE_LIMIT,
) -> DataFrame:
    """One row: the verdict and its reasons. Inputs have one row per segment (segment_id, centroid, size)."""
    distances = centroid_drift(current, previous)
    moved = distances.agg(
        F.coalesce(F.max("distance"), F.lit(0.0)).alias("max_drift"),
        F.coalesce(F.avg("distance"), F.lit(0.0)).alias("mean_drift"),
        F.sort_array(F.collect_list(F.when(F.col("distance") > threshold, F.col("segment_id")))).alias(
            "drifted_segments"
        ),
    )
    js = size_divergence(current, previous)
    changed = segment_changes(current, previous).agg(
        F.sort_array(F.collect_list(F.when(F.col("change") == "new", F.col("segment_id")))).alias("new_segments"),
        F.sort_array(F.collect_list(F.when(F.col("change") == "disappeared", F.col("segment_id")))).alias(
            "disappeared_segments"
        ),
    )
    gone = changed.select("disappeared_segments").scalar()
    new = changed.select("new_segments").scalar()
    full = moved.select(
        "*",
        js.scalar().alias("js"),
        new.alias("new_segments"),
        gone.alias("disappeared_segments"),
    )
    verdict = (
        (F.col("max_drift") > threshold)
        | (F.col("js") > size_threshold)
        | (F.size("new_segments") > 0)
        | (F.size("disappeared_segments") > 0)
    )
    return full.select(
        verdict.alias("has_drift"),
        round_even(F.col("max_drift"), 4).alias("max_centroid_drift"),
        round_even(F.col("mean_drift"), 4).alias("mean_centroid_drift"),
        round_even(F.col("js"), 4).alias("js_divergence"),
        "drifted_segments",
        "new_segments",
        "disappeared_segments",
        F.lit(threshold).alias("threshold"),
    )


# Two data sets ---------------------------------------------------------------------------


def report_input(reviews: DataFrame) -> DataFrame:
    """text_length, word_count and numeric rating (3 where it is missing or not a number)."""
    rating = (
        F.coalesce(F.col("rating").cast("string").try_cast("double"), F.lit(3.0))
        if "rating" in reviews.columns
        else F.lit(3.0)
    )
    return reviews.select(
        F.length("text").alias("text_length"),
        F.when(F.col("text").isNotNull(), tx.word_count(F.col("text"))).alias("word_count"),
        rating.alias("rating"),
    )


def stats_report(features: DataFrame) -> DataFrame:
    """One row: count, mean, deviation, median and 95th percentile of the text length, rating mean and deviation."""
    moments = features.agg(
        F.count(F.lit(1)).alias("record_count"),
        F.avg("text_length").alias("text_length_mean"),
        F.stddev("text_length").alias("text_length_std"),
        F.avg("rating").alias("rating_mean"),
        F.stddev("rating").alias("rating_std"),
    )
    lengths = checkpointed(
        exact_quantiles(features, "text_length", {"text_length_p50": 0.50, "text_length_p95": 0.95})
    )
    return moments.select(
        "*",
        lengths.select("text_length_p50").scalar().alias("text_length_p50"),
        lengths.select("text_length_p95").scalar().alias("text_length_p95"),
    )


# Least share of a bin in the stability index.
PSI_LEAST = 1e-4


def _value_counts(df: DataFrame, columns: list[str], **sides: Column) -> DataFrame:
    """Rows per column and value, for any number of weights, from one scan of ``df``."""
    long = df.select(
        *[w.alias(name) for name, w in sides.items()], *[F.col(c).cast("double").alias(c) for c in columns]
    )
    return (
        long.unpivot(list(sides), columns, "column_name", "v")
        .groupBy("column_name", "v")
        .agg(*[F.sum(name).alias(name) for name in sides])
    )


def two_sided_counts(current: DataFrame, reference: DataFrame, columns: list[str]) -> DataFrame:
    """``column_name``, ``v`` and how often the value occurs in the current (a) and reference (b) data."""
    now = _value_counts(current, columns, a=F.lit(1), b=F.lit(0))
    before = _value_counts(reference, columns, a=F.lit(0), b=F.lit(1))
    return (
        now.unionByName(before)
        .where(F.col("v").isNotNull())
        .groupBy("column_name", "v")
        .agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    )


def ks_statistics(counts: DataFrame) -> DataFrame:
    """Per column the largest gap between the two distribution functions (input: two_sided_counts)."""
    cdf = running_sum(counts, "v", ["a", "b"], by=["column_name"])

    def share(side: str) -> Column:
        return F.coalesce(F.try_divide(F.col(f"cum_{side}"), F.col(f"all_{side}")), F.lit(0.0))

    return cdf.groupBy("column_name").agg(F.max(F.abs(share("a") - share("b"))).alias("statistic"))


def _kolmogorov_tail(x: Column, terms: int = 100) -> Column:
    """Chance that the scaled gap of two samples of one distribution exceeds ``x``, by its alternating series."""
    j = F.sequence(F.lit(1), F.lit(terms))
    signed = lambda s, i: s + F.when(i % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * i * i * x * x)
    # Below 0.2 the chance is 1 to twelve places, while the series needs ever more terms.
    return F.when(x < 0.2, F.lit(1.0)).otherwise(F.greatest(F.least(F.aggregate(j, F.lit(0.0), signed), F.lit(1.0)), F.lit(0.0)))


def distribution_tests(counts: DataFrame, level: float = 0.05, psi_limit: float = 0.2, bins: int = 10) -> DataFrame:
    """Per column the two-sample KS test with its asymptotic p-value, and the population stability index (PSI).

    Input: ``two_sided_counts``. The PSI compares the shares in bins that each hold an equal part of the reference; a
    value's bin follows from the reference's distribution function at it, so both figures need one ordered pass. Empty
    shares count as ``PSI_LEAST``. Without rows on one side there is no test: the figures are null and nothing drifts.
    """
    cdf = running_sum(counts, "v", ["a", "b"], by=["column_name"])
    share = lambda side: F.try_divide(F.col(f"cum_{side}"), F.col(f"all_{side}"))
    at = F.greatest(F.least(F.ceil(share("b") * bins) - 1, F.lit(bins - 1)), F.lit(0))
    per_bin = cdf.groupBy("column_name", at.alias("bin")).agg(
        F.max(F.abs(share("a") - share("b"))).alias("gap"), F.sum("a").alias("a"), F.sum("b").alias("b"), F.first("all_a").alias("na"), F.first("all_b").alias("nb")
    )
    p, q = (F.greatest(F.try_divide(F.col(x), F.col(n)), F.lit(PSI_LEAST)) for x, n in (("a", "na"), ("b", "nb")))
    found = per_bin.groupBy("column_name").agg(
        F.first("na").alias("n_current"), F.first("nb").alias("n_reference"), F.max("gap").alias("statistic"),
        F.when((F.first("na") > 0) & (F.first("nb") > 0), F.sum((p - q) * F.ln(p / q))).alias("psi"),
    )
    root = F.sqrt(F.col("n_current") * F.col("n_reference") / (F.col("n_current") + F.col("n_reference")))
    scaled = (root + 0.12 + F.try_divide(F.lit(0.11), root)) * F.col("statistic")
    tested = found.withColumn("p_value", F.when(F.col("psi").isNotNull(), _kolmogorov_tail(scaled)))
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("int")
    return tested.withColumns({"drift_detected": flag(F.col("p_value") < level), "shifted": flag(F.col("psi") >= psi_limit)})


def category_divergences(counts: DataFrame) -> DataFrame:
    """Per column the Jensen-Shannon divergence of the value shares (input: two_sided_counts)."""
    totals = counts.groupBy("column_name").agg(F.sum("a").alias("_a"), F.sum("b").alias("_b"))
    shares = counts.join(totals, "column_name").select(
        "column_name",
        (F.col("a") / (F.col("_a") + fv.DRIFT_EPSILON)).alias("p"),
        (F.col("b") / (F.col("_b") + fv.DRIFT_EPSILON)).alias("q"),
    )
    shares = shares.withColumn("m", (F.col("p") + F.col("q")) / 2.0)
    return shares.groupBy("column_name").agg(
        ((F.sum(_relative("p", "m")) + F.sum(_relative("q", "m"))) / 2.0).alias("statistic")
    )


def column_drift(
    current: DataFrame,
    reference: DataFrame | None = None,
    ks_threshold: float = 0.1,
    js_threshold: float = 0.1,
) -> DataFrame:
    """Per column: statistic, test and verdict. Rows with a missing value are left out on both sides.

    Both sides are scanned once, into counts per column and value; every test reads those counts.
    Without a reference the data is compared with itself, which never drifts.
    """
    numbers, categories = ["text_length", "word_count"], ["rating"]
    current = current.select(*numbers, *categories).na.drop()
    reference = current if reference is None else reference.select(*numbers, *categories).na.drop()
    counts = checkpointed(two_sided_counts(current, reference, numbers + categories))
    tests = ks_statistics(counts.where(F.col("column_name").isin(numbers))).select(
        "column_name", F.lit("ks").alias("test"), "statistic", F.lit(ks_threshold).alias("threshold")
    )
    tests = tests.unionByName(
        category_divergences(counts.where(F.col("column_name").isin(categories))).select(
            "column_name", F.lit("js").alias("test"), "statistic", F.lit(js_threshold).alias("threshold")
        )
    )
    return tests.withColumn("drift_detected", (F.col("statistic") >= F.col("threshold")).cast("int"))


def column_quality(df: DataFrame, columns: list[str]) -> DataFrame:
    """Missing, distinct, minimum, maximum, mean and deviation per numeric column, long form.

    One scan counts every column by value; a frequent value is one row per task. The mean is
    subtracted before squaring.
    """
    counts = checkpointed(_value_counts(df, columns, n=F.lit(1)))
    v, n = F.col("v"), F.col("n")
    means = (
        counts.where(v.isNotNull())
        .groupBy("column_name")
        .agg((F.sum(v * n) / F.sum(n)).alias("mean"))
    )
    present = F.sum(F.when(v.isNotNull(), n).otherwise(0))
    centred = v - F.col("mean")
    return (
        counts.join(means, "column_name", "left")
        .groupBy("column_name")
        .agg(
            F.coalesce(F.sum(F.when(v.isNull(), n)), F.lit(0)).alias("missing"),
            F.count("v").alias("distinct_values"),
            F.min("v").alias("min"),
            F.max("v").alias("max"),
            F.first("mean").alias("mean"),
            F.sqrt(F.try_divide(F.sum(n * centred * centred), F.nullif(present - 1, F.lit(0)))).alias("std"),
        )
    )


def column_quality_approximate(df: DataFrame, columns: list[str]) -> DataFrame:
    """The same figures in one pass without a shuffle of values; the distinct count is an estimate."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], columns, "column_name", "v")
    return long.groupBy("column_name").agg(
        F.count_if(F.col("v").isNull()).alias("missing"),
        F.approx_count_distinct("v").alias("distinct_values"),
        F.min("v").alias("min"),
        F.max("v").alias("max"),
        F.avg("v").alias("mean"),
        F.stddev("v").alias("std"),
    )
