"""Small numpy helpers that run inside Arrow tasks.

They travel to the Python workers inside the pickled function that uses them, so the package need not
be installed on the executors.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Scores are compared at this many places, so that the order of additions cannot decide a tie.
SCORE_PLACES = 9
# Intermediate score and distance blocks hold about this many numbers.
BLOCK_CELLS = 4_000_000


def to_matrix(vectors: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A list column as an (n, dim) double matrix. Rows must be non-null and of one length."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    n = len(vectors)
    if n == 0:
        return np.empty((0, 0))
    if vectors.null_count:
        raise ValueError("null vector")
    lengths = np.diff(np.asarray(vectors.offsets))
    if (lengths != lengths[0]).any():
        raise ValueError("vectors of different dimensions")
    return np.asarray(vectors.flatten(), dtype=np.float64).reshape(n, int(lengths[0]))


def texts(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.array(column.to_pylist(), dtype=object)


def chunks(rows: int, other: int) -> list[slice]:
    """Row ranges whose product with ``other`` stays within a block."""
    step = max(1, BLOCK_CELLS // max(other, 1))
    return [slice(s, min(s + step, rows)) for s in range(0, rows, step)]


def slices(batches: Iterator[pa.RecordBatch], key: str, other: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and vectors of a stream of batches, cut so that scores against the other side stay in a block."""
    for batch in batches:
        for part in chunks(batch.num_rows, other):
            piece = batch.slice(part.start, part.stop - part.start)
            yield texts(piece.column(key)), to_matrix(piece.column("v"))


# Search ------------------------------------------------------------------------------------


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best scores of one query: highest first, ties by lowest id."""
    if len(scores) > k:
        floor = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = np.flatnonzero(scores >= floor)  # all ties of the k-th stay in until ids decide
    else:
        keep = np.arange(len(scores))
    order = np.lexsort((ids[keep], -scores[keep]))
    return keep[order[:k]]


def result_rows(query_ids: np.ndarray, found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """One row per query and found record."""
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.repeat(query_ids, [len(ids) for ids, _ in found]), pa.string()),
            pa.array(np.concatenate([ids for ids, _ in found]) if found else [], pa.string()),
            pa.array(np.concatenate([s for _, s in found]) if found else [], pa.float64()),
        ],
        names=["query_id", "record_id", "score"],
    )


class RunningBest:
    """The k best records per query over a stream of score blocks."""

    def __init__(self, queries: int, k: int) -> None:
        self.k = k
        self.kept: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0, object), np.empty(0))] * queries
        self.floor = np.full(queries, -np.inf)  # a score below its query's k-th best cannot enter

    def add(self, members: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """``scores[i, j]`` is the score of query ``members[i]`` and record ``ids[j]``."""
        hit = (scores >= self.floor[members][:, None]).any(axis=1)
        for row in np.flatnonzero(hit):
            q = members[row]
            merged_ids = np.concatenate([self.kept[q][0], ids])
            merged = np.concatenate([self.kept[q][1], scores[row]])
            at = best(merged, merged_ids, self.k)
            self.kept[q] = (merged_ids[at], merged[at])
            if len(at) == self.k:
                self.floor[q] = merged[at[-1]]


def scores_of(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    return np.round(queries @ vectors.T, SCORE_PLACES)


# Quality -----------------------------------------------------------------------------------


def worst_ratios(
    ids: np.ndarray,
    places: np.ndarray,
    spread: np.ndarray,
    other_ids: np.ndarray,
    others: np.ndarray,
    other_spread: np.ndarray,
) -> np.ndarray:
    """Per segment the largest (s_i + s_j) / d_ij over the other segments; two on one spot count as 0."""
    worst = np.zeros(len(ids))
    if len(ids) == 0 or len(other_ids) == 0:
        return worst
    for part in chunks(len(ids), others.size):
        distance = np.sqrt(((places[part][:, None, :] - others[None, :, :]) ** 2).sum(axis=2))
        apart = (ids[part][:, None] != other_ids[None, :]) & (distance > 0)
        ratio = (spread[part][:, None] + other_spread[None, :]) / np.where(apart, distance, 1.0)
        worst[part] = np.where(apart, ratio, 0.0).max(axis=1)
    return worst


# Density -----------------------------------------------------------------------------------


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a**2).sum(axis=1)[:, None] + (b**2).sum(axis=1)[None, :] - 2 * a @ b.T


def apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of rows of equal places; no cancellation for close points."""
    return np.sqrt(((a - b) ** 2).sum(axis=1))


def within(a: np.ndarray, b: np.ndarray, eps: float) -> np.ndarray:
    return squared_distances(a, b) <= eps * eps


def local_roots(names: np.ndarray, owners: np.ndarray, members: np.ndarray, eps: float) -> tuple[np.ndarray, np.ndarray]:
    """Names that have a neighbour on the other side, and the smallest name each is connected to.

    ``names`` lists the owners, then the members; only owner-member distances are looked at.
    """
    n = len(owners)
    rank = np.argsort(np.argsort(names, kind="stable"), kind="stable").astype(np.int64)
    by_rank = np.empty(len(names), dtype=object)
    by_rank[rank] = names
    near = [(part, within(owners[part], members, eps)) for part in chunks(n, len(members))]
    label, high = rank.copy(), np.iinfo(np.int64).max
    while True:
        before = label.copy()
        reach = np.full(len(members), high)
        for part, close in near:
            up = np.where(close, label[n:][None, :], high).min(axis=1)
            label[part] = np.minimum(label[part], up)
            reach = np.minimum(reach, np.where(close, label[part][:, None], high).min(axis=0))
        label[n:] = np.minimum(label[n:], reach)
        if (label == before).all():
            break
    touched = np.concatenate(
        [*[close.any(axis=1) for _, close in near], np.any([close.any(axis=0) for _, close in near], axis=0)]
    )
    return names[touched], by_rank[label][touched]


# All pairs ---------------------------------------------------------------------------------

# Rows and columns of one tile of squared distances.
TILE = (512, 2048)
# What rounding can put into a squared distance that is made as a product, as a share of the largest squared length.
ROUNDING = 1e-12


def tiles(a: np.ndarray, b: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """Squared distances of all rows of ``a`` and ``b``, a tile at a time, with the first row and column of each."""
    # Lengths are part of the product, so a tile is made in one step.
    left = np.column_stack([-2 * a, (a**2).sum(axis=1), np.ones(len(a))])
    right = np.column_stack([b, np.ones(len(b)), (b**2).sum(axis=1)]).T
    for r in range(0, len(a), TILE[0]):
        for c in range(0, len(b), TILE[1]):
            yield r, c, left[r : r + TILE[0]] @ right[:, c : c + TILE[1]]


class NearestSoFar:
    """The k nearest of each row over a stream of tiles of squared distances; ``far``: below which they are asked for."""

    def __init__(self, rows: int, k: int, far: np.ndarray | None = None) -> None:
        self.k = k
        self.d, self.at = np.full((rows, k), np.inf), np.full((rows, k), -1, np.int64)
        self.far = np.full(rows, np.inf) if far is None else far.copy()  # only a smaller distance can enter a row

    def add(self, row: int, column: int, tile: np.ndarray) -> None:
        """``tile[i, j]`` belongs to the row ``row + i`` and to number ``column + j`` of the others."""
        self._take(row, column, tile, np.flatnonzero(tile < self.far[row : row + len(tile), None]), False)

    def add_flipped(self, row: int, column: int, tile: np.ndarray) -> None:
        """The same where the tile's columns are the rows here."""
        self._take(row, column, tile.T, np.flatnonzero(tile < self.far[None, row : row + tile.shape[1]]), True)

    def _take(self, row: int, column: int, tile: np.ndarray, hits: np.ndarray, flipped: bool) -> None:
        if not len(hits):
            return
        if len(hits) > 4 * self.k * len(tile):
            tile = np.ascontiguousarray(tile)
            width = tile.shape[1]
            touched, take = np.arange(len(tile)), min(self.k, width)
            at = np.argpartition(tile, take - 1, axis=1)[:, :take]
            d = np.take_along_axis(tile, at, axis=1)
        else:
            r, c = np.divmod(hits, tile.shape[0] if flipped else tile.shape[1])
            if flipped:
                order = np.argsort(c, kind="stable")
                r, c = c[order], r[order]
            touched, group, n = np.unique(r, return_inverse=True, return_counts=True)
            place = np.arange(len(r)) - np.repeat(np.cumsum(n) - n, n)
            d, at = np.full((len(touched), n.max()), np.inf), np.zeros((len(touched), n.max()), np.int64)
            d[group, place], at[group, place] = tile[r, c], c
        touched = touched + row
        d, at = np.concatenate([self.d[touched], d], axis=1), np.concatenate([self.at[touched], at + column], axis=1)
        kept = np.argpartition(d, self.k - 1, axis=1)[:, : self.k]
        self.d[touched], self.at[touched] = np.take_along_axis(d, kept, axis=1), np.take_along_axis(at, kept, axis=1)
        self.far[touched] = np.minimum(self.far[touched], self.d[touched].max(axis=1))

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows, columns, and how many each row has."""
        there = np.isfinite(self.d)
        return np.nonzero(there)[0], self.at[there], there.sum(axis=1)


def nearest_of_sides(
    a: np.ndarray, b: np.ndarray | None, k: int, far_a: np.ndarray | None = None, far_b: np.ndarray | None = None
) -> list[NearestSoFar]:
    """The k nearest of every row of ``a`` in ``b`` and the other way round; without ``b`` those in ``a`` but the row itself."""
    if b is None:
        own = NearestSoFar(len(a), k, far_a)
        for r, c, tile in tiles(a, a):
            same = np.arange(max(r, c), min(r + tile.shape[0], c + tile.shape[1]))
            tile[same - r, same - c] = np.inf
            own.add(r, c, tile)
        return [own]
    sides = [NearestSoFar(len(a), k, far_a), NearestSoFar(len(b), k, far_b)]
    for r, c, tile in tiles(a, b):
        sides[0].add(r, c, tile)
        sides[1].add_flipped(c, r, tile)
    return sides


def counts_within(a: np.ndarray, b: np.ndarray | None, weight_a: np.ndarray, weight_b: np.ndarray, eps: float) -> list[np.ndarray]:
    """The weight within ``eps`` of every row of ``a`` in ``b`` and the other way round; without ``b`` in ``a`` itself."""
    if b is None:
        own = np.zeros(len(a), np.int64)
        for r, c, tile in tiles(a, a):
            own[r : r + tile.shape[0]] += (tile <= eps * eps) @ weight_a[c : c + tile.shape[1]]
        return [own]
    near = [np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)]
    for r, c, tile in tiles(a, b):
        rows, cols, close = slice(r, r + tile.shape[0]), slice(c, c + tile.shape[1]), tile <= eps * eps
        near[0][rows] += close @ weight_b[cols]
        near[1][cols] += weight_a[rows] @ close
    return near


def joined_within(a: np.ndarray, b: np.ndarray, of_a: np.ndarray, of_b: np.ndarray, eps: float) -> tuple[np.ndarray, np.ndarray]:
    """Groups joined where rows of the two sides lie within ``eps``: the different groups, and the smallest each is joined to.

    Rows are taken in order of their groups, and a tile whose rows are all joined already is not looked at.
    """
    names, at = np.unique(np.concatenate([of_a, of_b]), return_inverse=True)
    root, sides = list(range(len(names))), []
    for x, mine in ((a, at[: len(a)]), (b, at[len(a) :])):
        order = np.argsort(mine, kind="stable")
        sides.append((x[order], mine[order]))
    (x, of_x), (y, of_y) = sides

    def top(g: int) -> int:
        while root[g] != g:
            root[g] = root[root[g]]
            g = root[g]
        return g

    for r in range(0, len(x), TILE[0]):
        for c in range(0, len(y), TILE[1]):
            rows, cols = slice(r, r + TILE[0]), slice(c, c + TILE[1])
            gx, gy = of_x[rows], of_y[cols]
            if min(gx.min(), gy.min()) == max(gx.max(), gy.max()):
                continue
            i, j = np.nonzero((squared_distances(x[rows], y[cols]) <= eps * eps) & (gx[:, None] != gy[None, :]))
            if not len(i):
                continue
            for pair in np.unique(gx[i] * len(names) + gy[j]).tolist():
                g, h = top(pair // len(names)), top(pair % len(names))
                root[max(g, h)] = min(g, h)
            # Groups joined by now count as one.
            tops = np.array(root)
            while (tops[tops] != tops).any():
                tops = tops[tops]
            of_x, of_y = tops[of_x], tops[of_y]
    return names, names[np.array([top(g) for g in range(len(names))], dtype=np.int64)]
