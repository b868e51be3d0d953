"""Segment lookup, names, enrichment, summaries, profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from segmentry import fixed_values as fv
from segmentry.operators import clustering, segments
from segmentry.plans.inputs import CURRENT_SQL, REVIEWS_SQL, current_run, reviews, table
from segmentry.plans.registry import query
from segmentry.plans.text_queries import WORDS
from segmentry.session import scratch_path
from segmentry.sources import tables

NAME_SQL = "CASE segment_id " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in fv.SEGMENT_NAMES.items()) + " ELSE concat('segment_', segment_id) END"

# Requested ids: one per event, most of them unknown, a few asked for very often.
LOOKUP_SQL = f"""{CURRENT_SQL}, looked AS (
  SELECT e.event_id, CAST(e.user_id AS VARCHAR) AS record_id, coalesce(c.segment_id, -1) AS segment_id, c.record_id IS NOT NULL AS hit
  FROM events e LEFT JOIN cur c ON CAST(e.user_id AS VARCHAR) = c.record_id)"""


def _looked_up(spark, sf):
    ids = table(spark, sf, "events").select("event_id", F.col("user_id").cast("string").alias("record_id"))
    return segments.lookup(ids, current_run(spark, sf).select("record_id", "segment_id"))


@query(
    f"""WITH {LOOKUP_SQL} SELECT event_id, record_id, segment_id, CASE WHEN hit THEN {NAME_SQL} ELSE 'unknown' END AS segment_label,
    CAST(hit AS INT) AS found FROM looked"""
)
def segment_lookup(spark, sf):
    return _looked_up(spark, sf)


@query(f"WITH {LOOKUP_SQL} SELECT count(*) FILTER (hit) AS found_count, count(*) FILTER (NOT hit) AS not_found_count FROM looked")
def lookup_counts(spark, sf):
    return segments.lookup_counts(_looked_up(spark, sf))


@query(f"WITH {CURRENT_SQL} SELECT record_id, {NAME_SQL} AS segment_label FROM cur")
def segment_names(spark, sf):
    return current_run(spark, sf).select("record_id", segments.segment_name(F.col("segment_id")).alias("segment_label"))


@query(
    """SELECT CAST(e.vec_id AS VARCHAR) AS record_id, coalesce(l.quality, -1) AS segment_id
    FROM embeddings e LEFT JOIN labels l ON e.vec_id = l.doc_id"""
)
def align_vectors(spark, sf):
    store = table(spark, sf, "embeddings").select(F.col("vec_id").cast("string").alias("record_id"), "embedding")
    labels = table(spark, sf, "labels").select(
        F.col("doc_id").cast("string").alias("record_id"), F.col("quality").alias("segment_id")
    )
    return segments.align(store, labels).select("record_id", "segment_id")


ASSIGNED_SQL = f"""{CURRENT_SQL}, {REVIEWS_SQL}, labelled AS (SELECT concat('note-', lpad(record_id, 9, '0')) AS record_id, segment_id FROM cur),
assigned AS (SELECT l.record_id, segment_id, {NAME_SQL} AS segment_label, coalesce(rating, 0) AS rating,
    coalesce(customer_id, '') AS customer_id, coalesce(product_id, '') AS product_id
  FROM labelled l LEFT JOIN (SELECT * FROM reviews WHERE lang = 'en') r ON l.record_id = r.id)"""


def _assigned(spark, sf):
    """Vectors labelled as reviews; only English reviews have facts, so some stay without."""
    labels = current_run(spark, sf).select(
        F.concat(F.lit("note-"), F.lpad("record_id", 9, "0")).alias("record_id"), "segment_id"
    )
    return segments.assignments(labels, reviews(spark, sf).where("lang = 'en'"))


@query(f"WITH {ASSIGNED_SQL} SELECT * FROM assigned")
def enrich_assignments(spark, sf):
    return _assigned(spark, sf)


@query(f"WITH {ASSIGNED_SQL} SELECT * FROM assigned")
def assignment_write(spark, sf):
    """Written by key twice; the table holds one row per record."""
    path = scratch_path(spark, "assignments")
    for _ in range(2):
        tables.replace_by_key(_assigned(spark, sf), path, "record_id")
    return tables.read_keyed(spark, path)


@query(
    f"""WITH {ASSIGNED_SQL} SELECT segment_label, count(*) AS size, round(avg(rating), 2) AS avg_rating FROM assigned GROUP BY 1 ORDER BY size DESC, 1"""
)
def segment_breakdown(spark, sf):
    return segments.breakdown(_assigned(spark, sf))


@query(
    f"""WITH {CURRENT_SQL}, sizes AS (SELECT segment_id, count(*) AS size FROM cur WHERE segment_id <> -1 GROUP BY 1)
    SELECT segment_id, {NAME_SQL} AS segment_label, size, round_even(size / sum(size) OVER () * 1e4, 0) / 1e4 AS fraction FROM sizes"""
)
def segment_summary(spark, sf):
    return segments.summary(clustering.segment_sizes(current_run(spark, sf)))


# Reviews grouped by rating and language stand for segments of texts.
TERMS_SQL = f"""{REVIEWS_SQL}, seg AS (SELECT id, CAST(rating - 1 AS INT) AS segment_id, rating, text FROM reviews),
terms AS (SELECT segment_id, term, count(*) AS texts FROM (
  SELECT segment_id, unnest(list_distinct(regexp_extract_all(lower(text), '{WORDS}'))) AS term FROM seg) GROUP BY 1, 2),
scored AS (SELECT *, round_even(texts * ln((1.0 + (SELECT count(*) FROM seg)) / (1.0 + sum(texts) OVER (PARTITION BY term))) * 1e6, 0) / 1e6 AS score FROM terms),
ranked AS (SELECT *, row_number() OVER (PARTITION BY segment_id ORDER BY score DESC, term) AS rank FROM scored)"""


def _segmented_reviews(spark, sf):
    return reviews(spark, sf).select("id", (F.col("rating") - 1).alias("segment_id"), "rating", "text")


@query(f"WITH {TERMS_SQL} SELECT segment_id, term, CAST(rank AS INT) AS rank, texts, score FROM ranked WHERE rank <= 10")
def segment_terms(spark, sf):
    return segments.top_terms(_segmented_reviews(spark, sf)).select("segment_id", "term", "rank", "texts", "score")


@query(
    f"""WITH {TERMS_SQL} SELECT s.segment_id, s.size, s.avg_rating, t.top_terms FROM
    (SELECT segment_id, count(*) AS size, round(avg(rating), 2) AS avg_rating FROM seg GROUP BY 1) s
    JOIN (SELECT segment_id, string_agg(term, ',' ORDER BY rank) AS top_terms FROM ranked WHERE rank <= 10 GROUP BY 1) t USING (segment_id)"""
)
def segment_profile(spark, sf):
    return segments.profile(_segmented_reviews(spark, sf))
