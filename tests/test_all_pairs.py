"""Searches over all pairs of blocks against plain computations."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from segmentry.functions import kernels
from segmentry.operators import clustering, density, hierarchy, neighbours

POINTS = "p bigint, v array<double>"


def frame(spark, x):
    return spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], POINTS)


def distances(x, y):
    return np.sqrt(((x[:, None] - y[None]) ** 2).sum(axis=2))


def test_nearest_of_two_sides(monkeypatch):
    monkeypatch.setattr(kernels, "TILE", (7, 11))
    rng = np.random.default_rng(1)
    x, y = rng.normal(0, 1, (60, 5)), rng.normal(0, 1, (45, 5))
    y[:20] = y[0]  # a group of copies
    d = distances(x, y)
    for found, want in zip(kernels.nearest_of_sides(x, y, 4), (d, d.T)):
        assert np.sqrt(np.maximum(np.sort(found.d, axis=1), 0)) == pytest.approx(np.sort(want, axis=1)[:, :4], abs=1e-7)
    own = distances(y, y)
    np.fill_diagonal(own, np.inf)
    (found,) = kernels.nearest_of_sides(y, None, 50)  # more than there are
    assert found.pairs()[2].tolist() == [44] * 45
    assert np.sqrt(np.maximum(np.sort(found.d, axis=1)[:, :44], 0)) == pytest.approx(np.sort(own, axis=1)[:, :44], abs=1e-7)


def test_lists_are_exact_beyond_one_block(spark):
    """Lists without structure in many dimensions; a search by cells misses some of them."""
    x = np.random.default_rng(3).normal(0, 1, (1500, 40))
    points = frame(spark, x)
    d = distances(x, x)
    np.fill_diagonal(d, np.inf)
    want = np.argsort(d, axis=1, kind="stable")[:, :6]
    for lists in (neighbours.nearest_neighbours(points, 6, block_rows=64, width=8), neighbours.exact_neighbours(points, 1500, 6, pair_rows=300, one_block=1)):
        rows = {r["p"]: r["near"] for r in lists.collect()}
        assert [[n["q"] for n in rows[i]] for i in range(1500)] == want.tolist()
        assert rows[5][0]["d"] == pytest.approx(d[5].min(), rel=1e-14)


def test_core_distances_of_points_close_together(spark):
    """Distances of a millionth, repeated rows and repeated ids."""
    x = np.concatenate([np.full((40, 8), 0.3) + np.arange(40)[:, None] * 1e-6, np.full((5, 8), 2.0)])
    rows = [(f"r{i // 2}", [float(c) for c in v]) for i, v in enumerate(x)]
    got = density.core_distances(spark.createDataFrame(rows, "record_id string, embedding array<double>"), "record_id", min_samples=4).collect()
    assert len(got) == 45
    want = np.sort(distances(x, x), axis=1)[:, 4]
    assert np.sort([r["core_distance"] for r in got]) == pytest.approx(np.sort(want), rel=1e-6, abs=1e-12)


def test_lightest_edges_outwards(spark, monkeypatch):
    """Few rows are sent for a search, and each component gets its lightest edge, whether it knows a bound or not."""
    rng = np.random.default_rng(8)
    x, core, c = rng.normal(0, 1, (300, 6)), rng.uniform(0, 1.5, 300), np.arange(300) % 9
    w = np.maximum(np.maximum(distances(x, x), core[:, None]), core[None, :])
    w[c[:, None] == c[None, :]] = np.inf
    rows = [(i, [float(z) for z in v], float(core[i]), int(c[i]), 0.0) for i, v in enumerate(x)]
    points = spark.createDataFrame(rows, "p bigint, v array<double>, core double, c bigint, reached double")
    least = [w[c == k].min() for k in range(9)]
    bound = F.element_at(F.array(*[F.lit(float(z) * 1.5) for z in least]), (F.col("c") + 1).cast("int"))
    for reach, block in ((F.when(F.col("c") < 4, bound), 400), (bound, 70), (F.lit(None).cast("double"), 50)):
        asking = points.where("c < 8").withColumn("reach", reach)
        found = {r["c"]: r["best"] for r in hierarchy._search_outwards(points, asking, block).collect()}
        assert {k: b["w"] for k, b in found.items()} == pytest.approx({k: least[k] for k in range(8)})
        assert all(w[b["a"], b["b"]] == pytest.approx(b["w"]) and b["o"] in c[[b["a"], b["b"]]] and b["o"] != k for k, b in found.items())


def test_blocks_follow_rows_and_cores():
    assert neighbours.blocks_for(500, 1000, 48) == 1
    assert neighbours.blocks_for(600_000, 65_536, 48) == 10 and neighbours.blocks_for(10_000_000, 65_536, 48) == 153
    empty = pa.table({"p": pa.array([], pa.int64())})
    assert hierarchy._lightest_outwards(empty, empty).num_rows == 0


def test_groups_joined_within(monkeypatch):
    monkeypatch.setattr(kernels, "TILE", (5, 7))
    x = np.concatenate([np.arange(40)[:, None] * 1.0, 100 + np.arange(30)[:, None] * 1.0])[np.random.default_rng(2).permutation(70)]
    names, roots = kernels.joined_within(x, x, np.arange(70), np.arange(70), 1.5)
    want = [min(i for i in range(70) if (x[i, 0] < 100) == (x[k, 0] < 100)) for k in range(70)]
    assert names.tolist() == list(range(70)) and roots.tolist() == want
    weight = np.arange(70)
    near = distances(x, x) <= 1.5
    assert kernels.counts_within(x, None, weight, weight, 1.5)[0].tolist() == (near @ weight).tolist()
    a, b = kernels.counts_within(x[:50], x[50:], weight[:50], weight[50:], 1.5)
    assert a.tolist() == (near[:50, 50:] @ weight[50:]).tolist() and b.tolist() == (near[50:, :50] @ weight[:50]).tolist()


def test_wide_distance_takes_pairs_of_blocks(spark, monkeypatch):
    """Where every point would visit every cell, no cells are used, and the segments are the same."""
    rng = np.random.default_rng(6)
    x = np.concatenate([c * np.eye(1, 12)[0] + rng.normal(0, 0.3, (50, 12)) for c in (0, 3, 6)] + [rng.uniform(-9, 9, (20, 12))])
    df = spark.createDataFrame([(f"r{i:03d}", [float(c) for c in v]) for i, v in enumerate(x)], "record_id string, embedding array<double>")
    run = lambda **o: {r["record_id"]: r["segment_id"] for r in density.density_segments(df, "record_id", 1.7, 5, 10, block_rows=16, **o).collect()}
    monkeypatch.setattr(density, "_groups_by_cells", None)
    whole = run(pivots=2)
    assert len(set(whole.values())) == 4
    assert run(pair_rows=40, one_block=1, most_visits=0) == whole


def test_a_pass_of_kmeans_needs_no_exchange(spark, monkeypatch):
    """Sums of all starts over many partitions: at most one row for each core, added up without a shuffle."""
    rng = np.random.default_rng(4)
    x, centres = rng.normal(0, 1, (500, 6)), rng.normal(0, 1, (3, 4, 6))
    df = spark.createDataFrame([([float(c) for c in v],) for v in x], "v array<double>").repartition(37)
    step = clustering._sums_in_tasks(df, "v")
    monkeypatch.setattr(type(df), "groupBy", None)
    n, sums, cost = step(centres)
    squared = ((x[:, None, None] - centres[None]) ** 2).sum(axis=3)
    at = squared.argmin(axis=2)
    for s in range(3):
        for k in range(4):
            mine = at[:, s] == k
            assert n[4 * s + k] == mine.sum() and sums[4 * s + k] == pytest.approx(x[mine].sum(axis=0))
            assert cost[4 * s + k] == pytest.approx(squared[mine, s, k].sum())
