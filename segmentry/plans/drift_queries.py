"""Drift between runs and data sets, statistics reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from segmentry.functions.numeric import round_even
from segmentry.operators import clustering, drift
from segmentry.plans.inputs import CURRENT_SQL, PREVIOUS_SQL, current_run, mean_sql, previous_run, table, texts
from segmentry.plans.registry import query
from segmentry.plans.text_queries import NOT_SPACE, count_sql
from segmentry.session import checkpointed

RUNS_SQL = f"{CURRENT_SQL}, {PREVIOUS_SQL}, {mean_sql('cur', 'c')}, {mean_sql('prev', 'p')}"
DISTANCE_SQL = f"""{RUNS_SQL}, dist AS (SELECT c.segment_id, 1 - list_inner_product(c.centroid, p.centroid) /
  ((sqrt(list_inner_product(c.centroid, c.centroid)) + 1e-9) * (sqrt(list_inner_product(p.centroid, p.centroid)) + 1e-9)) AS distance
  FROM c JOIN p USING (segment_id))"""
JS_SQL = """shares AS (SELECT coalesce(c.size, 0) / ((SELECT sum(size) FROM c) + 1e-9) AS a, coalesce(p.size, 0) / ((SELECT sum(size) FROM p) + 1e-9) AS b
  FROM c FULL JOIN p USING (segment_id)),
js AS (SELECT (sum(CASE WHEN a > 0 THEN a * ln(a / ((a + b) / 2)) ELSE 0 END) + sum(CASE WHEN b > 0 THEN b * ln(b / ((a + b) / 2)) ELSE 0 END)) / 2 AS js FROM shares)"""


def _runs(spark, sf):
    """Centroids and sizes of both runs; one row per segment, written once and read by every measure."""
    return (
        checkpointed(clustering.centroids(current_run(spark, sf))),
        checkpointed(clustering.centroids(previous_run(spark, sf))),
    )


@query(f"WITH {DISTANCE_SQL} SELECT segment_id, round_even(distance * 1e6, 0) / 1e6 AS distance FROM dist")
def centroid_drift(spark, sf):
    out = drift.centroid_drift(*_runs(spark, sf))
    return out.select("segment_id", round_even(F.col("distance"), 6).alias("distance"))


@query(f"WITH {RUNS_SQL}, {JS_SQL} SELECT round_even(js * 1e6, 0) / 1e6 AS js_divergence FROM js")
def js_divergence(spark, sf):
    out = drift.size_divergence(*_runs(spark, sf))
    return out.select(round_even(F.col("js_divergence"), 6).alias("js_divergence"))


@query(
    f"""WITH {RUNS_SQL} SELECT segment_id, 'new' AS change FROM c WHERE segment_id NOT IN (SELECT segment_id FROM p)
    UNION ALL SELECT segment_id, 'disappeared' FROM p WHERE segment_id NOT IN (SELECT segment_id FROM c)"""
)
def segment_changes(spark, sf):
    return drift.segment_changes(*_runs(spark, sf))


@query(
    f"""WITH {DISTANCE_SQL}, {JS_SQL},
    new AS (SELECT coalesce(string_agg(segment_id, ',' ORDER BY segment_id), '') AS v, count(*) AS n FROM c WHERE segment_id NOT IN (SELECT segment_id FROM p)),
    gone AS (SELECT coalesce(string_agg(segment_id, ',' ORDER BY segment_id), '') AS v, count(*) AS n FROM p WHERE segment_id NOT IN (SELECT segment_id FROM c))
    SELECT max(distance) > 0.15 OR (SELECT js FROM js) > 0.1 OR (SELECT n FROM new) > 0 OR (SELECT n FROM gone) > 0 AS has_drift,
      round_even(max(distance) * 1e4, 0) / 1e4 AS max_centroid_drift, round_even(avg(distance) * 1e4, 0) / 1e4 AS mean_centroid_drift,
      (SELECT round_even(js * 1e4, 0) / 1e4 FROM js) AS js_divergence,
      coalesce(string_agg(segment_id, ',' ORDER BY segment_id) FILTER (distance > 0.15), '') AS drifted_segments,
      (SELECT v FROM new) AS new_segments, (SELECT v FROM gone) AS disappeared_segments, CAST(0.15 AS DOUBLE) AS threshold FROM dist"""
)
def drift_verdict(spark, sf):
    report = drift.drift_report(*_runs(spark, sf))
    lists = ["drifted_segments", "new_segments", "disappeared_segments"]
    return report.withColumns({c: F.array_join(F.col(c).cast("array<string>"), ",") for c in lists})


@query(
    f"""WITH {RUNS_SQL}, s AS (SELECT c.segment_id, p.segment_id AS previous_id, list_inner_product(c.centroid, p.centroid) AS sim FROM c, p),
    r AS (SELECT *, row_number() OVER (PARTITION BY segment_id ORDER BY sim DESC) AS rank FROM s)
    SELECT segment_id, previous_id, round_even(sim * 1e6, 0) / 1e6 AS similarity FROM r WHERE rank = 1"""
)
def matched_segments(spark, sf):
    out = drift.matched_segments(*_runs(spark, sf))
    return out.withColumn("similarity", round_even(F.col("similarity"), 6))


# Documents as two data sets: English against the rest. Every eleventh rating is not a number.
INPUT_SQL = f"""rated AS (SELECT lang, text, CASE WHEN doc_id % 11 = 0 THEN 'x' ELSE CAST(1 + doc_id % 5 AS VARCHAR) END AS rating FROM documents),
measured AS (SELECT lang, CAST(length(text) AS DOUBLE) AS text_length, CAST({count_sql('text', NOT_SPACE + '+')} AS DOUBLE) AS word_count,
  coalesce(TRY_CAST(rating AS DOUBLE), 3.0) AS rating FROM rated)"""


def _documents(spark, sf, condition="true"):
    rating = F.when(F.col("doc_id") % 11 == 0, "x").otherwise((1 + F.col("doc_id") % 5).cast("string"))
    return texts(spark, sf, "documents", "doc_id").where(condition).select("text", rating.alias("rating"))


@query(
    f"""WITH {INPUT_SQL} SELECT count(*) AS record_count, round_even(avg(text_length) * 1e4, 0) / 1e4 AS text_length_mean,
    round_even(stddev(text_length) * 1e4, 0) / 1e4 AS text_length_std, round_even(avg(rating) * 1e4, 0) / 1e4 AS rating_mean,
    round_even(stddev(rating) * 1e4, 0) / 1e4 AS rating_std, round_even(quantile_cont(text_length, 0.5) * 1e4, 0) / 1e4 AS text_length_p50,
    round_even(quantile_cont(text_length, 0.95) * 1e4, 0) / 1e4 AS text_length_p95 FROM measured"""
)
def stats_report(spark, sf):
    out = drift.stats_report(drift.report_input(_documents(spark, sf)))
    return out.select(*[c if c == "record_count" else round_even(F.col(c), 4).alias(c) for c in out.columns])


KS_SQL = """long AS (SELECT lang, unnest(['text_length', 'word_count']) AS column_name, unnest([text_length, word_count]) AS v FROM measured),
n AS (SELECT column_name, count(*) FILTER (lang = 'en') AS na, count(*) FILTER (lang <> 'en') AS nb FROM long GROUP BY 1),
cdf AS (SELECT DISTINCT column_name, v, sum(CASE WHEN lang = 'en' THEN 1 ELSE 0 END) OVER w AS a, sum(CASE WHEN lang <> 'en' THEN 1 ELSE 0 END) OVER w AS b
  FROM long WINDOW w AS (PARTITION BY column_name ORDER BY v RANGE UNBOUNDED PRECEDING)),
ks AS (SELECT column_name, max(abs(a / na - b / nb)) AS statistic FROM cdf JOIN n USING (column_name) GROUP BY 1),
cat AS (SELECT rating, count(*) FILTER (lang = 'en') / ((SELECT count(*) FROM measured WHERE lang = 'en') + 1e-9) AS a,
  count(*) FILTER (lang <> 'en') / ((SELECT count(*) FROM measured WHERE lang <> 'en') + 1e-9) AS b FROM measured GROUP BY 1),
js AS (SELECT (sum(CASE WHEN a > 0 THEN a * ln(a / ((a + b) / 2)) ELSE 0 END) + sum(CASE WHEN b > 0 THEN b * ln(b / ((a + b) / 2)) ELSE 0 END)) / 2 AS statistic FROM cat)"""


@query(
    f"""WITH {INPUT_SQL}, {KS_SQL} SELECT column_name, 'ks' AS test, round_even(statistic * 1e6, 0) / 1e6 AS statistic, CAST(0.1 AS DOUBLE) AS threshold, CAST(statistic >= 0.1 AS INT) AS drift_detected FROM ks
    UNION ALL SELECT 'rating', 'js', round_even(statistic * 1e6, 0) / 1e6, CAST(0.1 AS DOUBLE), CAST(statistic >= 0.1 AS INT) FROM js"""
)
def column_drift(spark, sf):
    english = drift.report_input(_documents(spark, sf, "lang = 'en'"))
    others = drift.report_input(_documents(spark, sf, "lang <> 'en'"))
    return drift.column_drift(english, others).withColumn("statistic", round_even(F.col("statistic"), 6))


LEVELS_SQL = """placed AS (SELECT column_name, v, a, b, least(greatest(ceil(b / nb * 10) - 1, 0), 9) AS bin FROM cdf JOIN n USING (column_name)),
rows_of AS (SELECT l.column_name, bin, lang FROM long l JOIN placed p ON p.column_name = l.column_name AND p.v = l.v),
shares AS (SELECT column_name, greatest(count(*) FILTER (lang = 'en') / na, 1e-4) AS p, greatest(count(*) FILTER (lang <> 'en') / nb, 1e-4) AS q
  FROM rows_of JOIN n USING (column_name) GROUP BY column_name, bin, na, nb),
psi AS (SELECT column_name, sum((p - q) * ln(p / q)) AS psi FROM shares GROUP BY 1),
scaled AS (SELECT *, (sqrt(na * nb / (na + nb)) + 0.12 + 0.11 / sqrt(na * nb / (na + nb))) * statistic AS x FROM ks JOIN n USING (column_name) JOIN psi USING (column_name)),
tested AS (SELECT *, CASE WHEN x < 0.2 THEN 1.0 ELSE greatest(least(list_sum(list_transform(range(1, 101), lambda j: CASE WHEN j % 2 = 1 THEN 2.0 ELSE -2.0 END * exp(-2.0 * j * j * x * x))), 1.0), 0.0) END AS p FROM scaled)"""


@query(
    f"""WITH {INPUT_SQL}, {KS_SQL}, {LEVELS_SQL} SELECT column_name, na AS n_current, nb AS n_reference, round_even(statistic * 1e6, 0) / 1e6 AS statistic,
    round_even(p * 1e6, 0) / 1e6 AS p_value, round_even(psi * 1e6, 0) / 1e6 AS psi, CAST(p < 0.05 AS INT) AS drift_detected, CAST(psi >= 0.2 AS INT) AS shifted FROM tested"""
)
def column_drift_levels(spark, sf):
    """English texts against the rest: p-value of the KS test and stability index of both lengths."""
    english = drift.report_input(_documents(spark, sf, "lang = 'en'"))
    others = drift.report_input(_documents(spark, sf, "lang <> 'en'"))
    counts = checkpointed(drift.two_sided_counts(english, others, ["text_length", "word_count"]))
    out = drift.distribution_tests(counts)
    return out.withColumns({c: round_even(F.col(c), 6) for c in ("statistic", "p_value", "psi")})


QUALITY_COLUMNS = ["o_orderkey", "o_custkey", "o_totalprice"]


def _quality_sql(distinct: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) FILTER (v IS NULL) AS missing, {distinct} min(v) AS min, max(v) AS max,
        round_even(avg(v) * 1e4, 0) / 1e4 AS mean, round_even(stddev(v) * 1e4, 0) / 1e4 AS std
        FROM (SELECT CASE WHEN o_orderkey % 9 <> 0 THEN CAST({c} AS DOUBLE) END AS v FROM orders)"""
        for c in QUALITY_COLUMNS
    )


def _orders_with_gaps(spark, sf):
    present = F.col("o_orderkey") % 9 != 0
    return table(spark, sf, "orders").select(*[F.when(present, F.col(c)).alias(c) for c in QUALITY_COLUMNS])


@query(_quality_sql("count(DISTINCT v) AS distinct_values,"))
def column_quality(spark, sf):
    out = drift.column_quality(_orders_with_gaps(spark, sf), QUALITY_COLUMNS)
    return out.withColumns({c: round_even(F.col(c), 4) for c in ("mean", "std")})


@query(_quality_sql(""))
def column_quality_approximate(spark, sf):
    """The distinct counts are estimates and left out of the comparison."""
    out = drift.column_quality_approximate(_orders_with_gaps(spark, sf), QUALITY_COLUMNS).drop("distinct_values")
    return out.withColumns({c: round_even(F.col(c), 4) for c in ("mean", "std")})


ESTIMATE_ERROR = 0.15  # three standard errors of the estimate


@query(
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(DISTINCT v) AS distinct_values, true AS estimate_within_bound
        FROM (SELECT CASE WHEN o_orderkey % 9 <> 0 THEN CAST({c} AS DOUBLE) END AS v FROM orders)"""
        for c in QUALITY_COLUMNS
    )
)
def column_distinct_estimates(spark, sf):
    """The exact distinct counts, and whether the approximate operator's estimates are within 15 % of them."""
    df = _orders_with_gaps(spark, sf)
    estimate = drift.column_quality_approximate(df, QUALITY_COLUMNS).select("column_name", F.col("distinct_values").alias("_estimate"))
    exact = drift.column_quality(df, QUALITY_COLUMNS).select("column_name", "distinct_values")
    near = F.abs(F.col("_estimate") - F.col("distinct_values")) <= ESTIMATE_ERROR * F.col("distinct_values")
    return exact.join(estimate, "column_name").select("column_name", "distinct_values", near.alias("estimate_within_bound"))
