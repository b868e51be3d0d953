"""Density segments of any density: the hierarchy over all distances, and its most stable parts.

Two points are joined at their mutual reachability, the largest of their distance and their core distances. The
steps, each a few Spark jobs over tables of one row per point or neighbour:

1. Boruvka rounds grow a minimum spanning tree: every component takes its lightest edge outwards, components joined
   that way become one. Edges come from the nearest-neighbour graph where its lists prove that there is no lighter
   one. The other components search: those of their points whose lists end within the weight found so far are
   compared with all points whose lists end within it too, in pairs of blocks of bounded size.
2. The spanning tree becomes the merge tree. Its edges are split at a middle weight, the light ones fall into
   components that are problems of their own, the heavy ones are a problem over those components; once a problem
   fits one task it is solved there. Edges of one weight merge all their parts at once, so ties leave no choice.
3. Parts below the least size are points that leave their segment. What splits into two large parts or more makes
   new segments. The stability of a segment adds up, over the points that leave it, the inverse distance at which
   they leave less that at which it began; of a segment and those within it, the more stable choice is kept.

The whole table is never a segment by itself; points of no chosen segment are noise.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segmentry import fixed_values as fv
from segmentry.functions.kernels import apart, tiles, to_matrix
from segmentry.functions.ordering import row_numbers
from segmentry.operators.components import connected_components
from segmentry.operators.neighbours import nearest_neighbours
from segmentry.session import stored

# Distances below this count as this, so that equal points are dense but not infinitely so.
LEAST_DISTANCE = 1e-9
# Edges solved in one task; segments of the whole tree chosen among in one task.
TASK_EDGES = 200_000
# So many points at most have their spanning tree made in one task, from all their pairs.
TASK_POINTS = 2048
TASK_SEGMENTS = 500_000
# Points of a block when components search for their lightest edge.
BLOCK_ROWS = 32_768
EDGE = "struct<w:double,a:bigint,b:bigint,o:bigint>"


def core_from_lists(points: DataFrame, lists: DataFrame, min_samples: int) -> DataFrame:
    """``p`` and ``core``: the distance within which ``min_samples`` other records lie, copies of the point counted."""
    weights = points.select(F.col("p").alias("q"), F.col("weight").alias("w"))
    near = lists.select("p", F.explode("near").alias("n")).select("p", F.col("n.d").alias("d"), F.col("n.q").alias("q"))
    around = near.join(weights, "q").groupBy("p").agg(F.array_sort(F.collect_list(F.struct("d", "w"))).alias("l"))
    start = F.struct((F.col("weight") - 1).alias("n"), F.lit(0.0).cast("double").alias("d"))
    reach = F.aggregate(
        F.coalesce("l", F.array().cast("array<struct<d:double,w:bigint>>")),
        start,
        lambda s, x: F.when(s["n"] >= min_samples, s).otherwise(F.struct((s["n"] + x["w"]).alias("n"), x["d"].alias("d"))),
    )
    return points.select("p", "weight").join(around, "p", "left").select("p", reach["d"].alias("core"))


# Spanning tree ------------------------------------------------------------------------------


def _lightest_outwards(visitors: pa.Table, owners: pa.Table) -> pa.Table:
    """For each component among the visitors its lightest edge to an owner of another component, ties by ids.

    ``reach`` of a visitor is a weight that no edge of interest exceeds. Rough distances of a tile at a time leave out
    what is farther than that or than the lightest edge so far; what remains is measured again.
    """
    found = []
    if visitors.num_rows and owners.num_rows:
        p, c, core, x = _columns(visitors)
        q, o, core_q, y = _columns(owners)
        slack = 1e-7 * max(1.0, float(np.abs(x).max()), float(np.abs(y).max()))
        names, group = np.unique(c, return_inverse=True)
        least = np.full(len(names), np.inf)
        np.minimum.at(least, group, np.asarray(visitors.column("reach").combine_chunks().fill_null(np.inf)))
        useful = core_q <= least.max() + slack
        q, o, core_q, y = q[useful], o[useful], core_q[useful], y[useful]
        for row, column, tile in tiles(x, y):
            at, to = slice(row, row + tile.shape[0]), slice(column, column + tile.shape[1])
            tile = np.maximum(tile, 0.0, out=tile)
            lost = np.flatnonzero(~np.isfinite(least[group[at]]))
            if len(lost):
                w = np.maximum(np.maximum(np.sqrt(tile[lost]), core[at][lost, None]), core_q[None, to])
                w[c[at][lost, None] == o[None, to]] = np.inf
                np.minimum.at(least, group[at][lost], w.min(axis=1))
            limit = least[group[at]]
            limit = np.where(np.isfinite(limit), limit * (1 + 1e-7) + slack, -1.0)
            hits = np.flatnonzero(tile <= np.where(limit < 0, -1.0, limit**2)[:, None])
            i, j = np.divmod(hits, tile.shape[1])
            w = np.sqrt(tile.ravel()[hits])
            i, j = i + row, j + column
            w = np.maximum(np.maximum(w, core[i]), core_q[j])
            kept = np.flatnonzero((c[i] != o[j]) & (w <= limit[i - row]))
            i, j, w = i[kept], j[kept], w[kept]
            np.minimum.at(least, group[i], w)
            kept = np.flatnonzero(w <= least[group[i]] * (1 + 1e-7) + slack)
            if not len(kept):
                continue
            i, j = i[kept], j[kept]
            exact = np.maximum(np.maximum(apart(x[i], y[j]), core[i]), core_q[j])
            a, b = np.minimum(p[i], q[j]), np.maximum(p[i], q[j])
            order = np.lexsort((b, a, exact, c[i]))
            first = order[np.concatenate([[True], c[i][order][1:] != c[i][order][:-1]])]
            found.append((c[i][first], exact[first], a[first], b[first], o[j][first]))
    kinds = (pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64())
    columns = [pa.array(np.concatenate(z), k) for z, k in zip(zip(*found), kinds)] if found else [pa.array([], k) for k in kinds]
    return pa.table(columns, names=["c", "w", "a", "b", "o"])


def _columns(t: pa.Table) -> tuple[np.ndarray, ...]:
    return np.asarray(t.column("p")), np.asarray(t.column("c")), np.asarray(t.column("core")), to_matrix(t.column("v"))


def _search_outwards(points: DataFrame, asking: DataFrame, block_rows: int) -> DataFrame:
    """``c`` and ``best``: for each component its lightest edge from an asking point to a point of another component.

    ``points``: p, v, core, c, reached of all points. ``asking``: p, v, core, c and ``reach``, a weight that no edge of
    interest exceeds, null where none is known. Both sides are cut into blocks, and every pair of blocks is one task.
    """
    asking = stored(asking.select("p", "v", "core", "c", "reach"))
    n_asking, lost, farthest = asking.agg(F.count(F.lit(1)), F.count_if(F.col("reach").isNull()), F.max("reach")).first()
    # An edge in no list is no lighter than the lists of its ends reach.
    owners = points if lost or farthest is None else points.where((F.col("reached") <= farthest) & (F.col("core") <= farthest))
    tasks = 2 * points.sparkSession.sparkContext.defaultParallelism
    asked = max(1, math.ceil(n_asking / block_rows))
    owned = max(math.ceil(owners.count() / block_rows), math.ceil(tasks / asked))
    own = lambda n: F.pmod(F.xxhash64("p"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = asking.select("*", own(asked).alias("_v"), every(owned).alias("_o"))
    right = owners.select(*[F.col(x).alias(x) for x in ("p", "v", "core", "c")], own(owned).alias("_o"), every(asked).alias("_v"))
    keys = ["_v", "_o"]
    met = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_lightest_outwards, "c bigint, w double, a bigint, b bigint, o bigint")
    return met.groupBy("c").agg(F.min(F.struct("w", "a", "b", "o")).cast(EDGE).alias("best"))


def _renamed(df: DataFrame, c: str, groups: DataFrame) -> DataFrame:
    """Components replaced by what they have become part of."""
    now = groups.select(F.col("node").alias(c), F.col("root").alias("_r"))
    return df.join(now, c, "left").withColumn(c, F.coalesce("_r", c)).drop("_r")


def _tree_of_all_pairs(table: pa.Table) -> pa.Table:
    """The spanning tree of a few points, one point at a time."""
    ids, core, x = np.asarray(table.column("p")), np.asarray(table.column("core")), to_matrix(table.column("v"))
    best, other = np.full(len(ids), np.inf), np.zeros(len(ids), np.int64)
    outside, at, edges = np.ones(len(ids), dtype=bool), 0, []
    for _ in range(len(ids) - 1):
        outside[at] = False
        w = np.maximum(np.maximum(np.sqrt(((x - x[at]) ** 2).sum(axis=1)), core), core[at])
        nearer = w < best
        best[nearer], other[nearer] = w[nearer], at
        left = np.flatnonzero(outside)
        at = int(left[best[left].argmin()])
        edges.append((ids[at], ids[other[at]], best[at]))
    a, b, w = (np.array(z) for z in zip(*edges)) if edges else (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
    return pa.table({"a": pa.array(np.minimum(a, b)), "b": pa.array(np.maximum(a, b)), "w": pa.array(w)})


def spanning_tree(points: DataFrame, lists: DataFrame, cell_rows: int = BLOCK_ROWS, task_points: int = TASK_POINTS, task_edges: int = TASK_EDGES) -> DataFrame:
    """Edges (a, b, w) of a minimum spanning tree of mutual reachability over all pairs of points.

    ``points``: p, v, core. ``lists``: p, near. An edge that is in no list is at least as long as the lists of both its
    ends reach. So a component's lightest listed edge outwards is its lightest of all unless some of its lists end
    nearer than that; only the points of such lists are searched for, within the weight found so far. The largest
    component never has to search, as all others join something. A search compares blocks of ``cell_rows`` points.
    """
    spark = points.sparkSession
    total = points.count()
    if total <= task_points:
        return points.groupBy(F.lit("all")).applyInArrow(_tree_of_all_pairs, "a bigint, b bigint, w double")
    near = lists.select("p", F.explode("near").alias("n"))
    pairs = near.select(F.least("p", "n.q").alias("a"), F.greatest("p", "n.q").alias("b"), F.col("n.d").alias("d"))
    core = points.select("p", "core")
    edges = pairs.groupBy("a", "b").agg(F.min("d").alias("d")).join(core.select(F.col("p").alias("a"), F.col("core").alias("x")), "a")
    edges = edges.join(core.select(F.col("p").alias("b"), F.col("core").alias("y")), "b")
    crossing = stored(edges.select("a", "b", F.greatest("d", "x", "y").alias("w"), F.col("a").alias("ca"), F.col("b").alias("cb")))
    reached = lists.select("p", F.coalesce(F.element_at("near", -1)["d"], F.lit(0.0)).alias("reached"))
    placed = stored(points.join(reached, "p").select("p", "v", "core", "reached", F.col("p").alias("c")))
    taken = []
    while True:
        parts = stored(placed.groupBy("c").agg(F.count(F.lit(1)).alias("n"), F.min("reached").alias("reached")))
        n_parts, largest = parts.agg(F.count(F.lit(1)), F.max_by("c", "n")).first()
        if n_parts <= 1:
            break
        both = crossing.select(F.col("ca").alias("c"), F.struct("w", "a", "b", F.col("cb").alias("o")).alias("e")).unionByName(
            crossing.select(F.col("cb").alias("c"), F.struct("w", "a", "b", F.col("ca").alias("o")).alias("e"))
        )
        listed = both.groupBy("c").agg(F.min("e").cast(EDGE).alias("best"))
        best = stored(parts.join(listed, "c", "left"))
        unsure = (F.col("c") != largest) & (F.col("best").isNull() | (F.col("best.w") > F.col("reached")))
        chosen = best.where(F.col("best").isNotNull() & ~(unsure | ((F.col("c") == largest) & (F.col("best.w") > F.col("reached"))))).select("c", "best")
        open_parts = stored(best.where(unsure).select("c", "best"))
        if open_parts.take(1):
            bounds = open_parts.select("c", F.col("best.w").alias("reach"))
            # Lists that reach farther than the bound hold all edges of interest already.
            within = placed.join(bounds, "c").where(F.col("reach").isNull() | (F.col("reached") <= F.col("reach")))
            found = _search_outwards(placed, within, cell_rows)
            better = open_parts.unionByName(found.select("c", "best")).where(F.col("best").isNotNull())
            chosen = chosen.unionByName(better.groupBy("c").agg(F.min("best").alias("best")))
        chosen = stored(chosen.select("c", "best.*"))
        taken.append(chosen.select("a", "b", "w").distinct())
        groups = stored(connected_components(chosen, "c", "o", task_edges))
        placed = stored(_renamed(placed, "c", groups))
        moved = _renamed(_renamed(crossing, "ca", groups), "cb", groups).where(F.col("ca") != F.col("cb"))
        # Between two components only the lightest edge can ever be taken.
        pair = [F.least("ca", "cb").alias("ca"), F.greatest("ca", "cb").alias("cb")]
        lightest = moved.groupBy(*pair).agg(F.min(F.struct("w", "a", "b")).alias("e"))
        crossing = stored(lightest.select("e.a", "e.b", "e.w", "ca", "cb"))
    tree = spark.createDataFrame([], "a bigint, b bigint, w double")
    for part in taken:
        tree = tree.unionByName(part)
    return tree


# Merge tree -----------------------------------------------------------------------------------


def _solve(base: int) -> Callable:
    """The merges of one problem: child, parent, the parent's weight and the child's size."""

    def solve(table: pa.Table) -> pa.Table:
        order = np.asarray(table.column("i")).argsort(kind="stable")
        i, w = np.asarray(table.column("i"))[order], np.asarray(table.column("w"))[order]
        a, b = np.asarray(table.column("a"))[order], np.asarray(table.column("b"))[order]
        size = dict(zip(a.tolist(), np.asarray(table.column("sa"))[order].tolist()))
        size.update(zip(b.tolist(), np.asarray(table.column("sb"))[order].tolist()))
        up: dict[int, int] = {}  # union-find over vertices
        top: dict[int, int] = {}  # the node of a root, if any
        weight: dict[int, float] = {}
        inside: dict[int, list[int]] = {}

        def root(x: int) -> int:
            while up.get(x, x) != x:
                up[x] = up.get(up[x], up[x])
                x = up[x]
            return x

        for k, x, y, d in zip(i.tolist(), a.tolist(), b.tolist(), w.tolist()):
            rx, ry = root(x), root(y)
            node, members, total = base + k, [], 0
            for r in (rx, ry):
                at = top.get(r, r)
                total += size[at]
                # A node of the same weight is the same merge.
                members += inside.pop(at) if weight.get(at) == d and at in inside else [at]
            up[rx] = ry
            top[ry], weight[node], inside[node], size[node] = node, d, members, total
        rows = [(c, node, weight[node], size[c]) for node, members in inside.items() for c in members]
        columns = list(zip(*rows))
        kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64())
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=["child", "parent", "w", "size"])

    return solve


MERGES = "child bigint, parent bigint, w double, size bigint"


def merge_tree(tree: DataFrame, sizes: DataFrame, base: int, task_edges: int = TASK_EDGES) -> DataFrame:
    """``child``, ``parent``, ``w`` (of the parent), ``size`` (of the child). Nodes are numbered from ``base``, points below.

    A node bears the number of its last edge in order of weight, so a part's topmost node is known before it is solved.
    """
    numbered = row_numbers(stored(tree), ["w", "a", "b"], "_i").withColumn("i", F.col("_i") - 1)
    sized = lambda df, c, s: df.join(sizes.select(F.col("p").alias(c), F.col("weight").alias(s)), c)
    todo = sized(sized(numbered, "a", "sa"), "b", "sb").select(F.lit(-1).cast("bigint").alias("g"), "i", "a", "b", "w", "sa", "sb")
    todo = stored(todo)
    done = []
    while True:
        shape = [F.count(F.lit(1)).alias("n"), F.min("w").alias("lo"), F.max("w").alias("hi"), F.percentile_approx("w", 0.5).alias("m"), F.max("i").alias("last")]
        problems = stored(todo.groupBy("g").agg(*shape))
        small, flat = F.col("n") <= task_edges, F.col("lo") == F.col("hi")
        of = lambda cond: todo.join(problems.where(cond), "g")
        done.append(of(small).select(*todo.columns).groupBy("g").applyInArrow(_solve(base), MERGES))
        if not problems.where(~small).take(1):
            break
        # One weight only: all vertices merge at once.
        ends = of(~small & flat).select("last", "w", F.explode(F.array(F.struct(F.col("a").alias("v"), F.col("sa").alias("s")), F.struct(F.col("b").alias("v"), F.col("sb").alias("s")))).alias("e"))
        done.append(ends.select(F.col("e.v").alias("child"), (F.col("last") + base).alias("parent"), "w", F.col("e.s").alias("size")).distinct())
        cut = of(~small & ~flat).withColumn("light", F.when(F.col("m") < F.col("hi"), F.col("w") <= F.col("m")).otherwise(F.col("w") < F.col("m")))
        cut = stored(cut.select(*todo.columns, "light"))
        light, heavy = cut.where("light").drop("light"), cut.where(~F.col("light")).drop("light")
        parts = stored(connected_components(light, "a", "b", task_edges))
        placed = light.join(parts.withColumnRenamed("node", "a"), "a")
        vertices = light.select(F.col("a").alias("node"), F.col("sa").alias("s")).unionByName(light.select(F.col("b").alias("node"), F.col("sb").alias("s"))).distinct()
        weight = vertices.join(parts, "node").groupBy("root").agg(F.sum("s").alias("s"))
        tops = stored(placed.groupBy("root").agg((F.max("i") + base).alias("top")).join(weight, "root"))
        inner = placed.join(tops.select("root", "top"), "root").select(F.col("top").alias("g"), *[c for c in todo.columns if c != "g"])
        by_vertex = parts.join(tops, "root").select("node", "top", "s")

        def contracted(df: DataFrame, c: str, s: str) -> DataFrame:
            named = df.join(by_vertex.select(F.col("node").alias(c), F.col("top").alias("_t"), F.col("s").alias("_s")), c, "left")
            return named.withColumns({c: F.coalesce("_t", c), s: F.coalesce("_s", s)}).drop("_t", "_s")

        outer = contracted(contracted(heavy, "a", "sa"), "b", "sb")
        todo = stored(inner.unionByName(outer.select(*todo.columns)))
    merges = tree.sparkSession.createDataFrame([], MERGES)
    for part in done:
        merges = merges.unionByName(part)
    return merges


# Segments -----------------------------------------------------------------------------------


def _follow(table: pa.Table) -> pa.Table:
    x, up = np.asarray(table.column("x")), np.asarray(table.column("up"))
    order = np.argsort(x)
    at = order[np.searchsorted(x[order], up)]
    while (at[at] != at).any():
        at = at[at]
    return pa.table({"x": pa.array(x), "top": pa.array(x[at])})


def _tops(links: DataFrame, task_edges: int) -> DataFrame:
    """``x`` and ``top``: where following ``up`` ends (at an x with up = x). Each round doubles the steps made."""
    if links.count() <= task_edges:
        return links.groupBy(F.lit("all")).applyInArrow(_follow, "x bigint, top bigint")
    while True:
        further = links.select(F.col("x").alias("up"), F.col("up").alias("_next"))
        jumped = stored(links.join(further, "up").select("x", "_next", F.col("up").alias("_old")))
        moved = jumped.where(F.col("_next") != F.col("_old")).take(1)
        links = jumped.select("x", F.col("_next").alias("up"))
        if not moved:
            return links.withColumnRenamed("up", "top")


def _choose(table: pa.Table) -> pa.Table:
    """Excess of mass over the whole tree of segments: each segment's chosen ancestor or itself, null for none."""
    ids, parents = table.column("c").to_pylist(), table.column("parent").to_pylist()
    stability, born = table.column("stability").to_pylist(), np.asarray(table.column("born"))
    at = {c: i for i, c in enumerate(ids)}
    below, keep = [0.0] * len(ids), [False] * len(ids)
    for i in np.argsort(-born, kind="stable"):  # a segment begins after the one around it
        if parents[i] is None:
            continue
        keep[i] = stability[i] >= below[i]
        below[at[parents[i]]] += stability[i] if keep[i] else below[i]
    chosen: list[int | None] = [None] * len(ids)
    for i in np.argsort(born, kind="stable"):
        around = chosen[at[parents[i]]] if parents[i] is not None else None
        chosen[i] = around if around is not None else ids[i] if keep[i] else None
    return pa.table({"c": pa.array(ids, pa.int64()), "chosen": pa.array(chosen, pa.int64())})


def _choose_by_rounds(segments: DataFrame) -> DataFrame:
    """The same for any number of segments: from the innermost outwards, then back, a level of the tree at a time."""
    waiting = segments.where("parent IS NOT NULL").select("c", "parent", "stability")
    decided: DataFrame | None = None
    while waiting.take(1):
        # Innermost: no segment that still waits lies within.
        inner = waiting.join(waiting.select(F.col("parent").alias("c")).distinct(), "c", "left_anti")
        if decided is None:
            level = inner.withColumn("below", F.lit(0.0))
        else:
            below = decided.groupBy(F.col("parent").alias("c")).agg(F.sum("value").alias("below"))
            level = inner.join(below, "c", "left").withColumn("below", F.coalesce("below", F.lit(0.0)))
        keep = F.col("stability") >= F.col("below")
        level = stored(level.select("c", "parent", keep.alias("keep"), F.when(keep, F.col("stability")).otherwise(F.col("below")).alias("value")))
        decided = level if decided is None else stored(decided.unionByName(level))
        waiting = stored(waiting.join(level.select("c"), "c", "left_anti"))
    if decided is None:
        return segments.select("c", F.lit(None).cast("bigint").alias("chosen"))
    # Outermost kept: follow the way up, remembering the last kept segment on it.
    way = segments.select("c", F.col("parent").alias("up")).join(decided.select("c", "keep"), "c", "left")
    way = stored(way.select("c", "up", F.when(F.col("keep"), F.col("c")).alias("chosen")))
    while way.where("up IS NOT NULL").take(1):
        above = way.select(F.col("c").alias("up"), F.col("up").alias("_up"), F.col("chosen").alias("_chosen"))
        way = stored(way.join(above, "up", "left").select("c", F.col("_up").alias("up"), F.coalesce("_chosen", "chosen").alias("chosen")))
    return way.select("c", "chosen")


def stable_segments(merges: DataFrame, points: DataFrame, min_cluster_size: int, task_edges: int = TASK_EDGES, task_segments: int = TASK_SEGMENTS) -> DataFrame:
    """``p`` and ``top``, the chosen segment of each point (any number), null for noise."""
    merges = stored(merges)
    points = stored(points)
    inverse = lambda w: 1.0 / F.greatest(w, F.lit(LEAST_DISTANCE))
    big = F.col("size") >= min_cluster_size
    shape = merges.groupBy("parent").agg(
        F.first("w").alias("w"), F.sum("size").alias("total"), F.count_if(big).alias("n_big"),
        F.sum(F.when(big, F.col("size")).otherwise(0)).alias("in_big"),
    )
    nodes = stored(shape)
    # A node that goes on as part of the same segment is linked to its parent; one that begins a segment to itself.
    by_parent = merges.join(nodes.select("parent", "n_big"), "parent")
    begins = big & (F.col("n_big") >= 2)
    links = by_parent.select(F.col("child").alias("x"), F.when(begins, F.col("child")).otherwise(F.col("parent")).alias("up"))
    root = nodes.join(merges.select(F.col("child").alias("parent")), "parent", "left_anti").select("parent")
    links = stored(links.unionByName(root.select(F.col("parent").alias("x"), F.col("parent").alias("up"))))
    tops = stored(_tops(links, task_edges))

    born = by_parent.where(begins).select(F.col("child").alias("c"), F.col("parent").alias("_around"), inverse(F.col("w")).alias("born"))
    around = tops.select(F.col("x").alias("_around"), F.col("top").alias("parent"))
    segments = born.join(around, "_around").select("c", "parent", "born").unionByName(
        root.select(F.col("parent").alias("c"), F.lit(None).cast("bigint").alias("parent"), F.lit(0.0).alias("born"))
    )
    segments = stored(segments)
    # Points that leave at a node: all where it splits or ends, else all but those of the part that goes on.
    leaving = nodes.where(F.col("total") >= min_cluster_size).select(
        F.col("parent").alias("x"), inverse(F.col("w")).alias("at"),
        F.when(F.col("n_big") == 1, F.col("total") - F.col("in_big")).otherwise(F.col("total")).alias("n"),
    )
    # Copies of one point that are a segment by themselves leave it at distance 0.
    copies = merges.where(big).join(points.select(F.col("p").alias("child")), "child").select(
        F.col("child").alias("x"), F.lit(1.0 / LEAST_DISTANCE).alias("at"), F.col("size").alias("n")
    )
    left = leaving.unionByName(copies).join(tops, "x").groupBy(F.col("top").alias("c")).agg(F.sum(F.col("n") * F.col("at")).alias("_s"), F.sum("n").alias("_n"))
    valued = segments.join(left, "c", "left").withColumn(
        "stability", F.coalesce(F.col("_s") - F.col("_n") * F.col("born"), F.lit(0.0))
    )
    valued = stored(valued.select("c", "parent", "born", "stability"))
    if valued.count() <= task_segments:
        chosen = valued.groupBy(F.lit("all")).applyInArrow(_choose, "c bigint, chosen bigint")
    else:
        chosen = _choose_by_rounds(valued)
    found = points.select(F.col("p").alias("x")).join(tops, "x", "left").select(F.col("x").alias("p"), F.col("top").alias("c"))
    return found.join(chosen, "c", "left").select("p", F.col("chosen").alias("top"))


def stability_segments(
    vectors: DataFrame,
    record_id: str,
    min_samples: int = fv.MIN_SAMPLES,
    min_cluster_size: int = fv.MIN_CLUSTER_SIZE,
    vector: str = "embedding",
    neighbours: int | None = None,
    task_points: int = TASK_POINTS,
    task_edges: int = TASK_EDGES,
    task_segments: int = TASK_SEGMENTS,
    **graph,
) -> DataFrame:
    """``record_id``, ``segment_id`` for every row; -1 is noise, segments count from 0 in order of their smallest id.

    ``neighbours``: length of the lists of the graph, by default half as many again as ``min_samples``; longer lists
    leave less to search for. The lists come from all pairs, so the result is that over all pairs. Equal vectors are one
    point of more weight. The ``task_`` limits and ``graph`` decide what is done at once, not the result.
    """
    named = vectors.select(F.col(record_id).cast("string").alias("record_id"), F.col(vector).cast("array<double>").alias("v"))
    by_vector = stored(named.groupBy("v").agg(F.min("record_id").alias("id"), F.count(F.lit(1)).alias("weight")))
    numbered = row_numbers(by_vector, ["id"], "_p")
    points = stored(numbered.select((F.col("_p") - 1).alias("p"), "v", "id", "weight"))
    total = points.count()
    if total < 2:
        return named.select("record_id", F.lit(fv.NOISE).alias("segment_id"))
    lists = nearest_neighbours(points.select("p", "v"), neighbours or min_samples + min_samples // 2, **graph)
    cored = stored(points.join(core_from_lists(points, lists, min_samples), "p").select("p", "v", "core"))
    tree = stored(spanning_tree(cored, lists, task_points=task_points, task_edges=task_edges))
    merges = merge_tree(tree, points.select("p", "weight"), total, task_edges)
    placed = stored(stable_segments(merges, points.select("p"), min_cluster_size, task_edges, task_segments))
    first = placed.where("top IS NOT NULL").groupBy("top").agg(F.min("p").alias("_first"))
    names = row_numbers(stored(first), ["_first"], "_s").select("top", (F.col("_s") - 1).cast("int").alias("segment_id"))
    labels = placed.join(names, "top", "left").join(points.select("p", "v"), "p").select("v", F.coalesce("segment_id", F.lit(fv.NOISE)).alias("segment_id"))
    return named.join(labels, "v", "left").select("record_id", F.coalesce("segment_id", F.lit(fv.NOISE)).alias("segment_id"))
