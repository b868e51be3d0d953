"""Alerts held in a stream, quantile sketches, and the two-sample test, against plain computations."""

from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from segmentry.operators import drift, sketches
from segmentry.streaming import held

BASE = dt.datetime(2024, 3, 1)
SCHEMA = "ts timestamp, status int, latency_s double"


def minute(m):
    return BASE + dt.timedelta(minutes=m)


def run(spark, path, drops, hold):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, held.STATE_STORE)
    try:
        for drop in drops:
            spark.createDataFrame([(minute(m), s, 0.1) for m, s in drop], SCHEMA).write.mode("append").parquet(f"{path}/in")
            source = spark.readStream.schema(SCHEMA).parquet(f"{path}/in")
            out = held.held_alerts(source, {"errors": F.col("errors") * 10 > F.col("requests")}, "1 minute", 5, 1, hold)
            writer = out.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/state")
            writer.trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
    rows = spark.read.parquet(f"{path}/out").collect()
    return sorted((int((r["at"] - BASE).total_seconds() // 60), r["transition"]) for r in rows)


def plain(drops, hold, length=5):
    """Transitions by walking over every closed window."""
    all_rows = [r for drop in drops for r in drop]
    mark = max(m for m, _ in all_rows) - 1
    windows = {}
    for m, s in all_rows:
        for start in range(m - length + 1, m + 1):
            n, bad = windows.get(start, (0, 0))
            windows[start] = (n + 1, bad + (s >= 500))
    out, since, last, fired = [], None, None, False
    for start in range(min(windows), mark - length + 1):
        n, bad = windows.get(start, (0, 0))
        if n and bad * 10 > n:
            if since is None:
                since = start
                out.append((start, "pending"))
            if start - since >= hold and not fired:
                fired = True
                out.append((start, "firing"))
            last = start
        elif since is not None:
            if fired:
                out.append((last + 1, "resolved"))
            since, fired = None, False
    return sorted(out)


def test_alerts_fire_and_resolve_over_gaps(spark, path):
    """Errors that hold, errors that do not, a gap without any request, and an end that only a timer can see."""
    quiet = [(m, 200) for m in range(0, 30)]
    short = [(m, 500) for m in range(30, 31)] + [(m, 200) for m in range(31, 50)]
    long = [(m, 500) for m in range(50, 62)]  # then nothing for hours
    later = [(m, 200) for m in range(300, 320)] + [(m, 503) for m in range(320, 330)]
    far = [(900, 200)]
    drops = [quiet + short, long, later, far]
    got = run(spark, path, drops, 6)
    assert got == plain(drops, 6)
    assert [t for _, t in got].count("resolved") == 2 and [t for _, t in got].count("firing") == 2


@pytest.mark.parametrize("k", [32, 400])
def test_merged_sketches_keep_their_rank_bound(spark, k):
    rng = np.random.default_rng(3)
    values = rng.exponential(1, 20_000)
    rows = [(int(i % 40), float(v)) for i, v in enumerate(values)] + [(0, None), (1, float("nan"))]
    parts = sketches.quantile_sketches(spark.createDataFrame(rows, "slide int, v double"), ["slide"], "v", k)
    whole = sketches.merged(parts.withColumn("g", F.lit(1)), ["g"], k)
    ps = (0.01, 0.5, 0.9, 0.99)
    got = whole.select(sketches.rows_in().alias("n"), *[sketches.quantile(p).alias(f"p{i}") for i, p in enumerate(ps)]).first()
    assert got["n"] == 20_000
    for i, p in enumerate(ps):
        rank = (values <= got[f"p{i}"]).mean()
        assert abs(rank - p) <= sketches.rank_error(k) + 1e-4


def test_two_sample_levels(spark):
    rng = np.random.default_rng(6)
    a, b = np.round(rng.normal(0, 1, 400), 2), np.round(rng.normal(0.3, 1.2, 700), 2)
    counts = [("moved", float(v), int((a == v).sum()), int((b == v).sum())) for v in np.union1d(a, b)]
    counts += [("same", float(v), int((a == v).sum()), int((a == v).sum())) for v in np.unique(a)]
    counts += [("alone", 1.0, 5, 0)]
    df = spark.createDataFrame(counts, "column_name string, v double, a long, b long")
    got = {r["column_name"]: r for r in drift.distribution_tests(df).collect()}
    grid = np.union1d(a, b)
    gap = max(abs((a <= v).mean() - (b <= v).mean()) for v in grid)
    ne = math.sqrt(400 * 700 / 1100)
    x = (ne + 0.12 + 0.11 / ne) * gap
    p = 2 * sum((-1) ** (j - 1) * math.exp(-2 * j * j * x * x) for j in range(1, 101))
    assert got["moved"]["statistic"] == pytest.approx(gap) and got["moved"]["p_value"] == pytest.approx(p, abs=1e-12)
    assert got["moved"]["drift_detected"] == 1 and got["same"]["drift_detected"] == 0
    assert got["same"]["p_value"] == 1.0 and got["same"]["psi"] == pytest.approx(0.0)
    at = np.clip(np.ceil(np.array([(b <= v).mean() for v in grid]) * 10) - 1, 0, 9)
    share = lambda x: np.array([max(sum((x == v).sum() for v in grid[at == i]) / len(x), drift.PSI_LEAST) for i in range(10)])
    assert got["moved"]["psi"] == pytest.approx(((share(a) - share(b)) * np.log(share(a) / share(b))).sum())
    assert got["alone"]["p_value"] is None and got["alone"]["drift_detected"] == 0
