"""The neighbour graph, the spanning tree and the stable segments against plain computations on all pairs."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from segmentry.operators import hierarchy, neighbours

POINTS = "p bigint, v array<double>"


def frame(spark, x):
    return spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], POINTS)


def unequal(seed=5):
    """Four groups whose densities differ by far, one of them in two halves, and stray points."""
    rng = np.random.default_rng(seed)
    sizes = ((60, 0.02), (70, 0.15), (80, 0.8))
    centres = np.array([[0, 0, 0], [4, 0, 0], [0, 9, 0]])
    parts = [c + rng.normal(0, s, (n, 3)) for c, (n, s) in zip(centres, sizes)]
    parts += [np.array([20, 20, 0]) + rng.normal(0, 0.1, (40, 3)), np.array([20.9, 20, 0]) + rng.normal(0, 0.1, (40, 3))]
    return np.concatenate([*parts, rng.uniform(-10, 30, (30, 3))])


def distances(x):
    return np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))


def reachability(x, min_samples):
    d = distances(x)
    core = np.sort(d, axis=1)[:, min_samples] if len(x) > min_samples else np.full(len(x), d.max(initial=0))
    w = np.maximum(np.maximum(d, core[:, None]), core[None, :])
    np.fill_diagonal(w, 0.0)
    return w


def tree_weights(w):
    """Weights of a minimum spanning tree, one point at a time."""
    best, out, inside = w[0].copy(), [], {0}
    for _ in range(len(w) - 1):
        at = min((b, i) for i, b in enumerate(best) if i not in inside)[1]
        out.append(best[at])
        inside.add(at)
        best = np.minimum(best, w[at])
    return np.sort(out)


def parts_below(w, members, height):
    left, out = set(members), []
    while left:
        queue = [left.pop()]
        part = list(queue)
        while queue:
            a = queue.pop()
            near = [b for b in left if w[a, b] < height]
            left.difference_update(near)
            queue += near
            part += near
        out.append(part)
    return out


def plain_segments(x, min_samples, least):
    """Stable segments by taking the table apart from the top."""
    w = reachability(x, min_samples)
    inverse = lambda v: 1 / max(v, hierarchy.LEAST_DISTANCE)

    def explore(members, born):
        """Stability of the segment that begins here, and the best choice within it."""
        stability, whole = 0.0, list(members)
        while True:
            height = tree_weights(w[np.ix_(members, members)])[-1] if len(members) > 1 else 0.0
            if height == 0.0:
                return stability + len(members) * (inverse(0.0) - born), [], whole
            parts = parts_below(w, members, height)
            large = [p for p in parts if len(p) >= least]
            if len(large) == 1:
                stability += (len(members) - len(large[0])) * (inverse(height) - born)
                members = large[0]
                continue
            stability += len(members) * (inverse(height) - born)
            return stability, [explore(p, inverse(height)) for p in large], whole

    def choose(node, may):
        stability, inner, members = node
        value, picked = 0.0, []
        for child in inner:
            v, got = choose(child, True)
            value += v
            picked += got
        return (stability, [members]) if may and stability >= value else (value, picked)

    chosen = choose(explore(list(range(len(x))), 0.0), False)[1]
    return {frozenset(m) for m in chosen}


def found(labels):
    groups = {}
    for r in labels.collect():
        groups.setdefault(r["segment_id"], set()).add(int(r["record_id"]))
    noise = groups.pop(-1, set())
    assert sorted(groups) == list(range(len(groups)))
    return {frozenset(g) for g in groups.values()}, noise


@pytest.fixture(scope="module")
def spread(spark):
    x = unequal()
    return x, spark.createDataFrame([(str(i), [float(c) for c in v]) for i, v in enumerate(x)], "record_id string, embedding array<double>")


@pytest.mark.parametrize("options", [{}, {"task_points": 0}, {"task_points": 0, "task_edges": 60, "task_segments": 1, "block_rows": 64}])
def test_segments_of_unequal_density(spread, options):
    x, df = spread
    got, noise = found(hierarchy.stability_segments(df, "record_id", 5, 20, **options))
    assert got == plain_segments(x, 5, 20)
    assert len(got) >= 4 and len(noise) >= 10


def test_segments_of_one_cloud_equal_points_and_ties(spark):
    rng = np.random.default_rng(9)
    grid = np.array([[i, j, 0.0] for i in range(8) for j in range(8)], dtype=float)  # one distance everywhere
    copies = np.concatenate([np.repeat([[50.0, 0, 0]], 25, axis=0), rng.normal(80, 1, (40, 3)), np.repeat([[90.0, 90, 0]], 3, axis=0)])
    rounds = {"task_points": 0, "task_edges": 30}
    for x, options in ((grid, rounds), (copies, rounds), (rng.normal(0, 1, (120, 3)), {})):
        df = spark.createDataFrame([(str(i), [float(c) for c in v]) for i, v in enumerate(x)], "record_id string, embedding array<double>")
        assert found(hierarchy.stability_segments(df, "record_id", 4, 10, **options))[0] == plain_segments(x, 4, 10)


def test_few_points(spark):
    empty = spark.createDataFrame([], "record_id string, embedding array<double>")
    assert hierarchy.stability_segments(empty, "record_id").count() == 0
    two = spark.createDataFrame([("a", [1.0]), ("b", [2.0]), ("b", [2.0])], "record_id string, embedding array<double>")
    assert {r["segment_id"] for r in hierarchy.stability_segments(two, "record_id").collect()} == {-1}


@pytest.mark.parametrize("options", [{"task_points": 0, "cell_rows": 40}, {"task_points": 0, "cell_rows": 8, "task_edges": 0}, {}])
def test_spanning_tree_weights(spark, options):
    """The same weights as over all pairs, though lists of seven leave most of the ways between groups out."""
    x = unequal(6)
    points = frame(spark, x).withColumn("weight", F.lit(1).cast("bigint"))
    lists = neighbours.nearest_neighbours(points.select("p", "v"), 7)
    cored = points.join(hierarchy.core_from_lists(points, lists, 5), "p").select("p", "v", "core")
    tree = hierarchy.spanning_tree(cored, lists, **options)
    got = np.sort([r["w"] for r in tree.collect()])
    assert got == pytest.approx(tree_weights(reachability(x, 5)), abs=1e-9)


def test_neighbour_graph_is_exact_in_one_block_and_close_in_many(spark):
    x = np.random.default_rng(2).normal(0, 1, (1500, 8))
    points = frame(spark, x)
    d = distances(x)
    np.fill_diagonal(d, np.inf)
    want = {i: set(np.argsort(d[i], kind="stable")[:10].tolist()) for i in range(len(x))}
    for block_rows, least in ((2000, 1.0), (128, 0.95)):
        lists = neighbours.nearest_neighbours(points, 10, block_rows=block_rows)
        rows = {r["p"]: r["near"] for r in lists.collect()}
        assert len(rows) == len(x) and all(len(r) == 10 for r in rows.values())
        hits = np.mean([len(want[i] & {n["q"] for n in rows[i]}) / 10 for i in rows])
        assert hits >= least
        assert neighbours.recall(points, lists, F.col("p") % 50 == 0, 10) == pytest.approx(hits, abs=0.05)
        near = rows[7]
        assert [n["d"] for n in near] == sorted(n["d"] for n in near) and near[0]["d"] == pytest.approx(d[7].min())


def test_comparisons_do_not_grow_with_the_points(spark):
    """A third of the points lie on one spot: blocks still bound what a point is compared with."""
    most = {}
    for n in (2000, 8000):
        x = np.random.default_rng(4).normal(0, 1, (n, 4))
        x[: n // 3] *= 1e-4
        placed = neighbours.in_blocks(frame(spark, x), n, 128, 3)
        sizes = placed.groupBy("cell", "block").agg(F.count("p").alias("n"))
        per_point = placed.join(sizes, ["cell", "block"]).groupBy("p").agg(F.sum("n").alias("met"))
        most[n] = per_point.agg(F.avg("met")).first()[0]
    assert most[8000] <= 3 * 128 * 1.2 and most[8000] < 1.5 * most[2000]
