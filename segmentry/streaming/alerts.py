"""Request alerts over sliding windows, as a stream and over stored requests.

Input columns: ts, status, latency_s.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmentry import fixed_values as fv
from segmentry.functions.ordering import exact_quantiles
from segmentry.operators import sketches

SERVER_ERROR = (500, 599)


def _is_error() -> Column:
    return F.col("status").between(*SERVER_ERROR)


def stream_windows(
    requests: DataFrame,
    delay: str = "10 minutes",
    length: str = f"{fv.ALERT_WINDOW_MINUTES} minutes",
    slide: str = "1 minute",
) -> DataFrame:
    """Closed windows with requests, error rate, p99 and the sketch it is read from. Requests later than the delay are dropped.

    The sketches of stored windows can be merged into those of longer ones (``sketches.merged``).

    A watermark needs instants, so times without a zone are read in the session's zone: use one without
    clock changes, as ``build_session`` does.
    """
    stamped = requests.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    return (
        stamped.groupBy(F.window("ts", length, slide).alias("w"))
        .agg(
            F.count(F.lit(1)).alias("requests"),
            (F.count_if(_is_error()) / F.count(F.lit(1))).alias("error_rate"),
            F.kll_sketch_agg_double(F.col("latency_s").cast("double"), sketches.SKETCH_K).alias("sketch"),
        )
        .select(
            F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "requests", "error_rate",
            F.when(sketches.rows_in() > 0, sketches.quantile(0.99)).alias("p99"), "sketch",
        )
    )


def _per_slide(requests: DataFrame, slide_minutes: int, keys: list[str], *aggregates: Column) -> DataFrame:
    """Requests reduced to one row per slide (and key) before they are copied into windows."""
    start = F.window("ts", f"{slide_minutes} minutes").getField("start")
    return requests.withColumn("_slide", start).groupBy("_slide", *keys).agg(*aggregates)


def _in_windows(slides: DataFrame, length_minutes: int, slide_minutes: int) -> DataFrame:
    """Copies each slide into the windows that cover it."""
    steps = length_minutes // slide_minutes
    back = F.explode(F.sequence(F.lit(0), F.lit(steps - 1))).alias("_back")
    start = F.timestamp_add("MINUTE", -F.col("_back") * slide_minutes, F.col("_slide"))
    return slides.select("*", back).withColumn("window_start", start)


def error_rates(
    requests: DataFrame,
    length_minutes: int = fv.ALERT_WINDOW_MINUTES,
    slide_minutes: int = 1,
    limit: float = fv.ERROR_RATE_LIMIT,
) -> DataFrame:
    """Requests, errors and rate of every non-empty window, and whether the rate is over the limit."""
    slides = _per_slide(
        requests, slide_minutes, [], F.count(F.lit(1)).alias("n"), F.count_if(_is_error()).alias("bad")
    )
    return (
        _in_windows(slides, length_minutes, slide_minutes)
        .groupBy("window_start")
        .agg(F.sum("n").alias("requests"), F.sum("bad").alias("errors"))
        .withColumn("error_rate", F.col("errors") / F.col("requests"))
        .withColumn("breach", (F.col("error_rate") > limit).cast("int"))
    )


def p99_latencies(
    requests: DataFrame,
    length_minutes: int = fv.ALERT_WINDOW_MINUTES,
    slide_minutes: int = 1,
    limit: float = fv.P99_LIMIT_SECONDS,
) -> DataFrame:
    """Exact 99th percentile of every non-empty window. Latencies are counted per slide first."""
    slides = _per_slide(requests.where(F.col("latency_s").isNotNull()), slide_minutes, ["latency_s"], F.count(F.lit(1)).alias("n"))
    windows = _in_windows(slides, length_minutes, slide_minutes)
    return exact_quantiles(windows, "latency_s", {"p99": 0.99}, by=["window_start"], weight="n").withColumn(
        "breach", (F.col("p99") > limit).cast("int")
    )


def sketched_p99(slides: DataFrame, length_minutes: int = fv.ALERT_WINDOW_MINUTES, slide_minutes: int = 1, limit: float = fv.P99_LIMIT_SECONDS) -> DataFrame:
    """p99 of every non-empty window from stored sketches of its slides (``_slide``, ``sketch``)."""
    windows = sketches.merged(_in_windows(slides, length_minutes, slide_minutes), ["window_start"])
    out = windows.select("window_start", sketches.rows_in().alias("requests"), sketches.quantile(0.99).alias("p99"))
    return out.withColumn("breach", (F.col("p99") > limit).cast("int"))


def slide_sketches(requests: DataFrame, slide_minutes: int = 1) -> DataFrame:
    """One sketch of the latencies of every slide, to be stored."""
    start = F.window("ts", f"{slide_minutes} minutes").getField("start")
    return sketches.quantile_sketches(requests.withColumn("_slide", start), ["_slide"], "latency_s")


def held(windows: DataFrame, hold_minutes: int = fv.ALERT_HOLD_MINUTES, slide_minutes: int = 1) -> DataFrame:
    """Windows at which the condition has held: this one and all of the last ``hold_minutes`` breach.

    A window without requests breaks the hold. Each breach is announced to the windows it counts for,
    so no ordered scan over all time is needed.
    """
    steps = hold_minutes // slide_minutes
    ahead = F.explode(F.sequence(F.lit(0), F.lit(steps))).alias("_ahead")
    breaches = windows.where("breach = 1").select("window_start", ahead)
    at = F.timestamp_add("MINUTE", F.col("_ahead") * slide_minutes, F.col("window_start"))
    return (
        breaches.groupBy(at.alias("window_start"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") == steps + 1)
        .select("window_start")
    )
