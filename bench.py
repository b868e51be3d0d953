"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.

Each query runs once, in one session and in the order below, so later queries find code compiled by
earlier ones. ``train_run`` precedes ``kmeans_summary``: ``clustering_seconds`` is a warm figure (about
19.5 s instead of 11.7 s when it was the first to use this code).
"""

from __future__ import annotations

import json
import os
import time

from segmentry.plans import registry
from segmentry.plans.inputs import table
from segmentry.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = [
    "trip_features", "trip_mart", "month_load", "month_replace", "landing_partitions", "layered_models",
    "review_normalize", "review_features", "text_clean", "text_dedup", "preprocess_tags",
    "keyed_replace", "insert_if_absent", "copy_parquet", "dq_expectations", "null_rates", "orphan_check",
    "l2_normalize", "vector_topk", "nearest_centroid", "centroids", "silhouette_cosine", "davies_bouldin",
    "embed_hash", "predict_segment", "train_run", "kmeans_summary", "density_segments", "ann_topk",
    "segment_lookup", "enrich_assignments", "segment_breakdown", "segment_summary", "segment_profile",
    "drift_verdict", "stats_report", "column_drift", "column_quality",
    "batch_fingerprint", "error_rate_windows", "latency_p99_windows", "stream_dedup", "stream_alerts",
]


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        spark__sql__shuffle__partitions=CPUS,
        spark__driver__memory="16g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.all_queries()
    queries["trip_valid_summary"](spark, SF_DIR).collect()  # start-up of the session is not a query

    seconds = {}
    for name in HEADLINE:
        seconds[name] = timed(lambda n=name: queries[n](spark, SF_DIR).write.format("noop").mode("overwrite").save())

    documents = table(spark, SF_DIR, "documents").count()
    trips = table(spark, SF_DIR, "lineitem").count()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {name: round(s, 3) for name, s in seconds.items()},
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "embedded_records_per_min": round(documents / seconds["embed_hash"] * 60),
                "clustering_seconds": round(seconds["kmeans_summary"], 3),
                "loaded_rows_per_min": round(trips / seconds["landing_partitions"] * 60),
            }
        )
    )


if __name__ == "__main__":
    main()
