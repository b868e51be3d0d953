from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from segmentry.operators import drift, segments
from segmentry.plans import review_segments
from segmentry.sources import tables


def test_lookup_keeps_order_of_magnitude_and_repeats(spark):
    ids = spark.createDataFrame([("a",), ("a",), ("x",), ("b",)], "record_id string")
    labels = spark.createDataFrame([("a", 3), ("b", 42)], "record_id string, segment_id int")
    out = segments.lookup(ids, labels)
    rows = sorted((r["record_id"], r["segment_id"], r["segment_label"], r["found"]) for r in out.collect())
    assert rows == [
        ("a", 3, "occasional_reviewers", 1),
        ("a", 3, "occasional_reviewers", 1),
        ("b", 42, "segment_42", 1),
        ("x", -1, "unknown", 0),
    ]
    counts = segments.lookup_counts(out).first()
    assert (counts["found_count"], counts["not_found_count"]) == (3, 1)


def test_assignment_defaults(spark):
    labels = spark.createDataFrame([("a", 0), ("b", 1)], "record_id string, segment_id int")
    reviews = spark.createDataFrame([("a", 5, "c1", None)], "id string, rating int, customer_id string, product_id string")
    a, b = segments.assignments(labels, reviews).orderBy("record_id").collect()
    assert (a["rating"], a["customer_id"], a["product_id"]) == (5, "c1", "")
    assert (b["rating"], b["customer_id"], b["product_id"]) == (0, "", "")


def test_breakdown_rounds_like_sql(spark):
    df = spark.createDataFrame([("s", x) for x in (1, 1, 1, 1, 1, 1, 1, 2)], "segment_label string, rating int")
    assert segments.breakdown(df).first()["avg_rating"] == 1.13  # 1.125, half away from zero


def test_summary(spark):
    sizes = spark.createDataFrame([(0, 1), (1, 2)], "segment_id int, size long")
    got = {r["segment_id"]: r["fraction"] for r in segments.summary(sizes).collect()}
    assert got == {0: 0.3333, 1: 0.6667}
    empty = spark.createDataFrame([(0, 0)], "segment_id int, size long")
    assert segments.summary(empty).first()["fraction"] == 0.0


def test_profile_terms(spark):
    rows = [(0, 5, "red red apple and"), (0, 4, "red pear and"), (1, 1, "blue sea and"), (1, 2, "blue sky and")]
    df = spark.createDataFrame(rows, "segment_id int, rating int, text string")
    got = {r["segment_id"]: r for r in segments.profile(df, terms=2).collect()}
    assert got[0]["top_terms"] == "red,apple"
    assert (got[0]["size"], got[0]["avg_rating"]) == (2, 4.5)
    assert got[1]["top_terms"].startswith("blue,")


# Drift -------------------------------------------------------------------------------------


def run(spark, rows):
    return spark.createDataFrame(rows, "segment_id int, centroid array<double>, size long")


BASE = [(0, [1.0, 0.0], 50), (1, [0.0, 1.0], 50)]


def test_no_drift_against_itself(spark):
    row = drift.drift_report(run(spark, BASE), run(spark, BASE)).first()
    assert row["has_drift"] is False
    assert (row["max_centroid_drift"], row["js_divergence"]) == (0.0, 0.0)
    assert row["drifted_segments"] == row["new_segments"] == row["disappeared_segments"] == []


@pytest.mark.parametrize(
    "changed, reason",
    [
        ([(0, [0.6, 0.8], 50), (1, [0.0, 1.0], 50)], "drifted_segments"),
        ([*BASE, (2, [0.7, 0.7], 1)], "new_segments"),
        (BASE[:1], "disappeared_segments"),
    ],
)
def test_each_reason_alone_is_drift(spark, changed, reason):
    row = drift.drift_report(run(spark, changed), run(spark, BASE)).first()
    assert row["has_drift"] is True
    assert len(row[reason]) == 1


def test_size_divergence(spark):
    def js(p, q):
        p, q = np.array(p, float), np.array(q, float)
        p, q = p / (p.sum() + 1e-9), q / (q.sum() + 1e-9)
        m = (p + q) / 2
        kl = lambda a: sum(x * np.log(x / y) for x, y in zip(a, m) if x > 0)
        return (kl(p) + kl(q)) / 2

    a = run(spark, [(0, [1.0], 90), (1, [1.0], 10)])
    b = run(spark, [(0, [1.0], 20), (2, [1.0], 80)])
    forward = drift.size_divergence(a, b).first()[0]
    assert forward == pytest.approx(js([90, 10, 0], [20, 0, 80]), abs=1e-12)
    assert drift.size_divergence(b, a).first()[0] == pytest.approx(forward, abs=1e-12)


def test_renumbering_is_found(spark):
    swapped = run(spark, [(0, [0.0, 1.0], 50), (1, [1.0, 0.0], 50)])
    got = {r["segment_id"]: r["previous_id"] for r in drift.matched_segments(run(spark, BASE), swapped).collect()}
    assert got == {0: 1, 1: 0}


def test_report_input_and_statistics(spark):
    df = spark.createDataFrame([("a b", "4.5"), (None, "x"), ("c", None)], "text string, rating string")
    rows = drift.report_input(df).collect()
    assert [(r["text_length"], r["word_count"], r["rating"]) for r in rows] == [(3, 2, 4.5), (None, None, 3.0), (1, 1, 3.0)]
    stats = drift.stats_report(drift.report_input(df)).first()
    assert (stats["record_count"], stats["text_length_mean"], stats["text_length_p50"]) == (3, 2.0, 2.0)
    assert stats["rating_std"] == pytest.approx(np.std([4.5, 3, 3], ddof=1))
    assert drift.report_input(df.drop("rating")).first()["rating"] == 3.0


def test_column_drift(spark):
    rng = np.random.default_rng(5)

    def data(shift, ratings):
        rows = [(int(x), int(x // 5), float(r)) for x, r in zip(rng.normal(100 + shift, 20, 400), rng.choice(ratings, 400))]
        return spark.createDataFrame([*rows, (None, 1, 1.0)], "text_length int, word_count int, rating double")

    a, b = data(0, [1, 2, 3]), data(40, [3, 4, 5])
    got = {r["column_name"]: r for r in drift.column_drift(a, b).collect()}
    x, y = ([r[0] for r in d.na.drop().collect()] for d in (a, b))
    grid = sorted(set(x) | set(y))
    ks = max(abs(np.mean(np.array(x) <= g) - np.mean(np.array(y) <= g)) for g in grid)
    assert got["text_length"]["statistic"] == pytest.approx(ks)
    assert {c: r["drift_detected"] for c, r in got.items()} == {"text_length": 1, "word_count": 1, "rating": 1}
    assert all(r["statistic"] == 0 and r["drift_detected"] == 0 for r in drift.column_drift(a).collect())


def test_column_quality(spark):
    values = [1e9 + 1, 1e9 + 2, 1e9 + 2, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    row = drift.column_quality(df, ["v"]).first()
    assert (row["missing"], row["distinct_values"], row["min"], row["max"]) == (1, 2, 1e9 + 1, 1e9 + 2)
    assert row["std"] == pytest.approx(np.std([1, 2, 2], ddof=1))


# The whole job -----------------------------------------------------------------------------


def test_reviews_to_segments(spark, tmp_path, sample_reviews):
    raw = spark.createDataFrame(sample_reviews, "id string, text string, rating string, product_id string, customer_id string")
    raw = raw.unionByName(raw.limit(5).withColumn("id", F.concat(F.lit("copy_"), "id")))
    base = str(tmp_path)
    first = review_segments.run(raw, base, k=2, run_id="one", starts=2)
    assert first.assignments.count() == 100
    assert {r["segment_label"] for r in first.assignments.select("segment_label").distinct().collect()} <= {
        "price_sensitive_shoppers", "brand_loyal_customers",
    }
    assert sum(r["size"] for r in first.breakdown.collect()) == 100
    made = tables.read_keyed(spark, f"{base}/embeddings").agg(F.max("created_at")).first()[0]
    again = review_segments.run(raw, base, k=2, run_id="two", starts=2)
    assert again.assignments.count() == 100
    assert tables.read_keyed(spark, f"{base}/embeddings").agg(F.max("created_at")).first()[0] == made
    assert spark.read.parquet(f"{base}/run_metrics").groupBy("run_id").count().count() == 2


def test_a_later_run_keeps_the_facts_of_earlier_records(spark, tmp_path, sample_reviews):
    kind = "id string, text string, rating string, product_id string, customer_id string"
    base = str(tmp_path)
    review_segments.run(spark.createDataFrame(sample_reviews[:50], kind), base, k=2, run_id="one", starts=1)
    done = review_segments.run(spark.createDataFrame(sample_reviews[50:], kind), base, k=2, run_id="two", starts=1)
    facts = {r["record_id"]: (r["rating"], r["customer_id"]) for r in done.assignments.collect()}
    assert facts == {r["id"]: (int(r["rating"]), r["customer_id"]) for r in sample_reviews}


def test_density_run(spark, vectors):
    result = review_segments.cluster(vectors, "density", core_share=0.8, min_cluster_size=20)
    row = result.summary.first()
    assert row["algorithm"] == "density" and row["n_segments"] == 3
    assert 0 < row["noise_fraction"] < 0.5
