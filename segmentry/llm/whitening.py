"""Whitening of embeddings by QR, bidiagonal reduction, the differential qd algorithm and twisted factorisations.

* Every task reduces its rows, block by block, to a triangle R with R'R = the sum of squares about the task's own
  mean. Two triangles are merged by a QR of both and one row for the distance of their means. Triangles meet sixteen
  at a time until one is left, so no covariance matrix is ever formed and its errors are not squared.
* The last triangle, of the size of the dimension, is brought to bidiagonal form by Householder reflections.
* Its singular values come from dqds sweeps, which find small ones as accurately as large ones.
* For each of them the twisted factorisation of the shifted tridiagonal B'B with the smallest middle entry gives the
  singular vector; vectors of nearly equal values are made orthogonal to each other. Householder reflections carry
  them back to the space of the rows.

Entries c are read as the whole numbers floor(1024 c) + 100000, so that sums, means and deviations are exact.

Defined results: rows whose vector is null, empty, or holds null or non-finite entries, or entries beyond 2^38, are
dropped; where vectors differ in length, those of the length stay that most of them have (the longer one on ties);
repeated rows each count; null ids stay; components beyond the rank (eigenvalue below the rounding of the largest) are not given,
so a single vector, or equal ones, give no rows; an empty table gives none; a deviation beyond 64 bits is null; other
columns are not read.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segmentry.session import checkpointed

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCALE, OFFSET = 1024, 100_000
LARGEST_ENTRY = 2.0**48
COMPONENTS = 8
# Triangles merged in one task.
FAN_IN = 16
BLOCK_ROWS = 4096
EPS = np.finfo(np.float64).eps
# Eigenvalues closer than this, relative to their size, may need their vectors made orthogonal.
CLUSTER_GAP = 1e-3


# Blocks of rows -------------------------------------------------------------------------------


def whole_rows(column: pa.Array, dimension: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Which rows stay, and the whole numbers of their entries."""
    n = len(column)
    size = np.asarray(pc.fill_null(pc.list_value_length(column), 0))
    values = column.flatten() if n else pa.array([], pa.float64())
    bad = pc.is_null(values)
    entries = np.asarray(pc.fill_null(values, 0)).astype(np.float64)
    wrong = np.asarray(bad) | ~(np.abs(entries) * SCALE < LARGEST_ENTRY)
    ends = np.cumsum(size)
    broken = np.concatenate([[0], np.cumsum(wrong)])
    keep = (size > 0) & (broken[ends] == broken[ends - size])
    if dimension is not None:
        keep &= size == dimension
    inside = np.repeat(keep, size)
    x = np.floor(entries[inside] * SCALE).astype(np.int64) + OFFSET
    return keep, x.reshape(-1, dimension) if dimension else x


@dataclass
class Block:
    """Rows seen so far: how many, their exact sums, and the triangle of their deviations from their mean."""

    n: int
    sums: list[int]
    r: np.ndarray

    def mean(self, base: list[int]) -> np.ndarray:
        """The mean, less ``base``; the difference is taken before rounding."""
        return np.array([(s - self.n * b) / self.n for s, b in zip(self.sums, base)])


def triangle(rows: np.ndarray) -> np.ndarray:
    """R of a QR of the rows, square."""
    d = rows.shape[1]
    r = np.linalg.qr(rows, mode="r")
    return r if len(r) == d else np.vstack([r, np.zeros((d - len(r), d))])


def block_of(x: np.ndarray) -> Block:
    sums = x.sum(axis=0)
    # n x - S is exact here; only the division rounds.
    return Block(len(x), [int(s) for s in sums], triangle((len(x) * x - sums) / len(x)))


def merged(a: Block, b: Block) -> Block:
    base = [s // a.n for s in a.sums]
    apart = math.sqrt(a.n / (a.n + b.n) * b.n) * (a.mean(base) - b.mean(base))
    return Block(a.n + b.n, [s + t for s, t in zip(a.sums, b.sums)], triangle(np.vstack([a.r, b.r, apart])))


def _encoded(block: Block, part: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {"part": [part], "n": [block.n], "sums": [[str(s) for s in block.sums]], "r": [block.r.ravel().tolist()]},
        pa.schema([("part", pa.int64()), ("n", pa.int64()), ("sums", pa.list_(pa.string())), ("r", pa.list_(pa.float64()))]),
    )


BLOCK_SCHEMA = "part long, n long, sums array<string>, r array<double>"


def _decoded(row: dict) -> Block:
    d = len(row["sums"])
    return Block(row["n"], [int(s) for s in row["sums"]], np.array(row["r"]).reshape(d, d))


def _blocks(dimension: int) -> Callable:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        seen = None
        for batch in batches:
            _, x = whole_rows(batch.column("_v"), dimension)
            for start in range(0, len(x), BLOCK_ROWS):
                found = block_of(x[start : start + BLOCK_ROWS])
                seen = found if seen is None else merged(seen, found)
        if seen is not None:
            yield _encoded(seen, TaskContext.get().partitionId())

    return scan


def _merge_group(table: pa.Table) -> pa.Table:
    rows = sorted(table.to_pylist(), key=lambda r: r["part"])
    out = _decoded(rows[0])
    for row in rows[1:]:
        out = merged(out, _decoded(row))
    return pa.Table.from_batches([_encoded(out, rows[0]["part"] // FAN_IN)])


def fit_block(vectors: DataFrame, dimension: int) -> Block | None:
    """One block of all rows. Triangles are merged in tasks; only the last, of the dimension's size, is collected."""
    tops = checkpointed(vectors.mapInArrow(_blocks(dimension), BLOCK_SCHEMA))
    while tops.count() > 1:
        # Numbers of the tasks shrink by the fan-in each time, so this ends after a few rounds.
        tops = checkpointed(tops.groupBy(F.floor(F.col("part") / FAN_IN).alias("_g")).applyInArrow(_merge_group, BLOCK_SCHEMA))
    last = tops.first()
    return _decoded(last.asDict()) if last else None


# The triangle's singular values and vectors -----------------------------------------------------


def bidiagonalised(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, np.ndarray, float]]]:
    """Diagonal and superdiagonal of U'RV, and the reflections that make up V."""
    a, d = r.copy(), len(r)
    right = []
    for k in range(d):
        v, beta = _reflector(a[k:, k])
        a[k:, k:] -= beta * np.outer(v, v @ a[k:, k:])
        if k < d - 2:
            v, beta = _reflector(a[k, k + 1 :])
            a[k:, k + 1 :] -= beta * np.outer(a[k:, k + 1 :] @ v, v)
            right.append((k + 1, v, beta))
    return np.diag(a).copy(), np.diag(a, 1).copy(), right


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """v and beta such that x - beta v (v'x) has zeros below its first entry."""
    size = np.abs(x).max() if len(x) else 0.0
    if size == 0.0 or len(x) == 1:
        return np.zeros_like(x), 0.0
    v = x / size
    v[0] += math.copysign(np.linalg.norm(v), v[0])
    return v, 2.0 / float(v @ v)


def _qd_step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float]:
    """One differential qd sweep. The last value is the least of the running differences; negative if the shift was too large."""
    d, qq, ee = q[0] - shift, [], []
    least = d
    for i in range(len(e)):
        if d < 0:
            return qq, ee, d
        top = d + e[i]
        t = q[i + 1] / top if top > 0 else 0.0
        qq.append(top)
        ee.append(e[i] * t)
        d = d * t - shift
        least = min(least, d)
    qq.append(d)
    return qq, ee, least


def singular_squares(diagonal: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """Squared singular values of a bidiagonal matrix by dqds, largest first."""
    q, e = [float(x) ** 2 for x in diagonal], [float(x) ** 2 for x in upper]
    out, waiting = [], [(q, e, 0.0)]
    while waiting:
        q, e, moved = waiting.pop()
        while q:
            m = len(q)
            if m == 1:
                out.append(q[0] + moved)
                break
            # An off-diagonal entry that no longer counts splits the matrix, or ends its last value.
            cut = next((i for i in range(m - 2, -1, -1) if e[i] <= EPS * EPS * (q[i + 1] + moved) or e[i] == 0.0), None)
            if cut is not None:
                waiting.append((q[: cut + 1], e[:cut], moved))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            if 1.5 * q[0] < q[-1]:  # the sweep finds the least value at the end
                q, e = _flipped(q, e)
            shift = _end_value(q, e)
            while True:
                qq, ee, least = _qd_step(q, e, shift)
                if least >= 0:
                    break
                # Too far. A failure at the very end tells how far; otherwise come closer, at last without a shift.
                late = len(qq) == m
                shift = max(shift + least, 0.0) * (1 - 4 * EPS) if late and shift + least > shift / 4 else shift / 4
                if shift <= EPS * moved or shift < sys.float_info.min:
                    shift = 0.0
            q, e, moved = qq, ee, moved + shift
    return np.array(sorted(out, reverse=True))


def _flipped(q: list[float], e: list[float]) -> tuple[list[float], list[float]]:
    """The bidiagonal factor of the same tridiagonal matrix read from the other end."""
    return q[::-1], e[::-1]


def _end_value(q: list[float], e: list[float]) -> float:
    """The lesser eigenvalue of the last two rows of BB', never below the least value; a failed sweep corrects it."""
    half, product = (q[-2] + e[-1] + q[-1]) / 2, q[-2] * q[-1]
    root = math.sqrt(max(half * half - product, 0.0))
    return product / (half + root) if half > 0 else 0.0


def twisted_vector(diagonal: np.ndarray, upper: np.ndarray, value: float) -> np.ndarray:
    """Unit eigenvector of B'B for ``value`` from its twisted factorisation."""
    size = max(np.abs(diagonal).max(), np.abs(upper).max() if len(upper) else 0.0)
    a = np.where(np.abs(diagonal) < EPS * EPS * size, EPS * EPS * size, diagonal)
    n, tiny = len(a), sys.float_info.min / EPS
    big, low = a * a, upper / a[:-1]
    # From the top: L D L' - value = L+ D+ L+'.
    s, plus, stationary = -value, np.zeros(n - 1), np.zeros(n)
    for i in range(n - 1):
        stationary[i] = s
        pivot = big[i] + s or tiny
        plus[i] = big[i] * low[i] / pivot
        s = plus[i] * low[i] * s - value
    stationary[n - 1] = s
    # From the bottom: L D L' - value = U- D- U-'.
    p, minus, progressive = big[n - 1] - value, np.zeros(n - 1), np.zeros(n)
    for i in range(n - 2, -1, -1):
        progressive[i + 1] = p
        pivot = big[i] * low[i] ** 2 + p or tiny
        t = big[i] / pivot
        minus[i] = low[i] * t
        p = p * t - value
    progressive[0] = p
    middle = np.abs(stationary + progressive + value)
    middle[~np.isfinite(middle)] = np.inf
    k = int(middle.argmin())
    z = np.zeros(n)
    z[k] = 1.0
    for i in range(k - 1, -1, -1):
        z[i] = -plus[i] * z[i + 1]
    for i in range(k, n - 1):
        z[i + 1] = -minus[i] * z[i]
    z[~np.isfinite(z)] = 0.0
    return z / np.linalg.norm(z)


def _shifted_solve(diagonal: np.ndarray, upper: np.ndarray, value: float, b: np.ndarray) -> np.ndarray:
    """(B'B - value)^-1 b by elimination with row exchanges, for a vector that must be orthogonal to its neighbours."""
    n = len(diagonal)
    main = diagonal**2 - value
    main[1:] += upper**2
    side = diagonal[:-1] * upper
    band = np.zeros((n, 3))
    band[:, 0], band[:-1, 1] = main, side
    x, tiny = b.copy(), EPS * max((diagonal**2).max(), (upper**2).max(initial=0.0))
    for i in range(n - 1):
        below = np.array([side[i], main[i + 1], side[i + 1] if i + 1 < n - 1 else 0.0])
        below[1] = band[i + 1, 0]
        if abs(below[0]) > abs(band[i, 0]):
            band[i], below = below.copy(), band[i].copy()
            x[i], x[i + 1] = x[i + 1], x[i]
        f = below[0] / (band[i, 0] or tiny)
        band[i + 1, 0], band[i + 1, 1] = below[1] - f * band[i, 1], below[2] - f * band[i, 2]
        x[i + 1] -= f * x[i]
    for i in range(n - 1, -1, -1):
        rest = x[i] - (band[i, 1] * x[i + 1] if i + 1 < n else 0.0) - (band[i, 2] * x[i + 2] if i + 2 < n else 0.0)
        pivot = band[i, 0]
        x[i] = rest / (pivot if abs(pivot) > tiny else math.copysign(tiny, pivot))
    return x / np.abs(x).max()


def right_vectors(diagonal: np.ndarray, upper: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Orthonormal eigenvectors of B'B for its values (largest first), as rows."""
    out: list[np.ndarray] = []
    first = 0
    for k, value in enumerate(values):
        if k and values[k - 1] - value > CLUSTER_GAP * values[k - 1]:
            first = k
        z = twisted_vector(diagonal, upper, value) if len(diagonal) > 1 else np.ones(1)
        near = np.array(out[first:k])
        if len(near):
            left = _cleared(z, near)
            if np.linalg.norm(left) < 0.9:
                # The factorisation found a vector already taken: search again beside those.
                start = np.random.default_rng(k).normal(size=len(z))
                for _ in range(4):
                    start = _cleared(_shifted_solve(diagonal, upper, value, _cleared(start, near)), near)
                    start /= np.linalg.norm(start)
                left = start
            z = _cleared(left / np.linalg.norm(left), near)
            z /= np.linalg.norm(z)
        out.append(z)
    return np.array(out)


def _cleared(z: np.ndarray, others: np.ndarray) -> np.ndarray:
    for _ in range(2):
        z = z - (others @ z) @ others
    return z


@dataclass
class Whitening:
    """n, exact sums, the eigenvalues of the covariance (largest first), components as rows, and the trace."""

    n: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray
    trace: float


def whitening_of(block: Block, components: int = COMPONENTS) -> Whitening:
    diagonal, upper, right = bidiagonalised(block.r)
    squares = singular_squares(diagonal, upper)
    trace = float(squares.sum())
    kept = squares[:components]
    kept = kept[kept > len(squares) * EPS * squares[0]] if squares[0] > 0 else kept[:0]
    found = right_vectors(diagonal, upper, kept) if len(kept) else np.zeros((0, len(squares)))
    for start, v, beta in reversed(right):
        found[:, start:] -= beta * np.outer(found[:, start:] @ v, v)
    return Whitening(block.n, block.sums, kept / block.n, found, trace / block.n)


# Results --------------------------------------------------------------------------------------


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S/n; the whole part of the mean is taken off exactly."""
    base = np.array([s // n for s in sums])
    rest = np.array([(s % n) / n for s in sums])
    return (x - base) - rest


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum of (n x - S)^2 of each row; None beyond 64 bits."""
    low, high = x.min(initial=0), x.max(initial=0)
    widest = max(abs(n * int(v) - s) for v in (low, high) for s in (min(sums), max(sums)))
    if widest**2 * x.shape[1] < 2**63 and n * max(abs(int(low)), abs(int(high))) < 2**63:
        return ((n * x - np.array(sums, dtype=np.int64)) ** 2).sum(axis=1).tolist()
    exact = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x]
    return [v if v < 2**63 else None for v in exact]


def _project(model: Whitening) -> np.ndarray:
    return model.components / np.sqrt(model.values)[:, None]


def _second_moments(model: Whitening, dimension: int) -> Callable:
    """Per task: rows, sums and products of the whitened columns about the task's own mean."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.values)
        n, mean, products = 0, np.zeros(k), np.zeros((k, k))
        for batch in batches:
            _, x = whole_rows(batch.column("_v"), dimension)
            if not len(x):
                continue
            w = centred(x, model.n, model.sums) @ _project(model).T
            about = w.mean(axis=0)
            products += (w - about).T @ (w - about) + np.outer(mean - about, mean - about) * (n * len(w) / (n + len(w)))
            mean = (n * mean + len(w) * about) / (n + len(w))
            n += len(w)
        if n:
            yield pa.RecordBatch.from_pydict({"n": [n], "mean": [mean.tolist()], "products": [products.ravel().tolist()]})

    return scan


def identity_error(vectors: DataFrame, model: Whitening, dimension: int) -> float:
    """Largest entry of the whitened rows' covariance, measured on the rows, that differs from the identity."""
    k = len(model.values)
    parts = checkpointed(vectors.mapInArrow(_second_moments(model, dimension), "n long, mean array<double>, products array<double>"))
    total = lambda c, weight: {
        r["i"]: r["x"] for r in parts.select("n", F.posexplode(c).alias("i", "x")).groupBy("i").agg(F.sum(F.col("x") * weight).alias("x")).collect()
    }  # k or k * k rows
    sums, products = total("mean", F.col("n")), total("products", F.lit(1.0))
    mean = np.array([sums[i] for i in range(k)]) / model.n
    inside = np.array([products[i] for i in range(k * k)]).reshape(k, k)
    # Tasks' own means about the common one: a second small sum.
    spread = parts.select("n", F.transform("mean", lambda x, i: x - F.element_at(F.array(*[F.lit(float(m)) for m in mean]), i + 1)).alias("m"))
    cross = spread.select("n", F.posexplode("m").alias("i", "a"), "m").select("n", "i", "a", F.posexplode("m").alias("j", "b"))
    between = np.zeros((k, k))
    for r in cross.groupBy("i", "j").agg(F.sum(F.col("n") * F.col("a") * F.col("b")).alias("x")).collect():
        between[r["i"], r["j"]] = r["x"]
    return float(np.abs((inside + between) / model.n - np.eye(k)).max())


def _apply(model: Whitening, dimension: int, error: float, id_type: pa.DataType) -> Callable:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.values)
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                piece = batch.slice(start, BLOCK_ROWS)
                keep, x = whole_rows(piece.column("_v"), dimension)
                rows = len(x)
                ids = piece.column("_id").filter(pa.array(keep)).take(pa.array(np.repeat(np.arange(rows), k)))
                w = centred(x, model.n, model.sums) @ _project(model).T
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.cast(id_type),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                        pa.array(np.full(rows * k, model.n)),
                        pa.array(deviations(x, model.n, model.sums), pa.int64()).take(pa.array(np.repeat(np.arange(rows), k))),
                        pa.array(w.ravel()),
                        pa.array(np.tile(model.values / model.trace, rows)),
                        pa.array(np.full(rows * k, error)),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return scan


def fit(vectors: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS) -> tuple[Whitening | None, int]:
    """The whitening of all rows that stay, and their dimension."""
    sizes = vectors.select(F.size(vector_col).alias("d")).where("d > 0").groupBy("d").count()
    commonest = sizes.orderBy(F.col("count").desc(), F.col("d").desc()).first()
    if commonest is None:
        return None, 0
    block = fit_block(vectors.select(F.col(vector_col).cast("array<double>").alias("_v")), commonest["d"])
    return (whitening_of(block, components) if block else None), commonest["d"]


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row for each row that stays and each component: its place, the whitened value and how good the whitening is."""
    model, dimension = fit(vectors, vector_col, components)
    rows = vectors.select(F.col(id_col).alias("_id"), F.col(vector_col).cast("array<double>").alias("_v"))
    schema = T.StructType([T.StructField("vec_id", rows.schema["_id"].dataType)] + list(
        T._parse_datatype_string("component int, n long, deviation long, whitened double, explained double, identity_error double").fields
    ))
    if model is None or not len(model.values):
        return vectors.sparkSession.createDataFrame([], schema)
    error = identity_error(rows, model, dimension)
    from pyspark.sql.pandas.types import to_arrow_type

    return rows.mapInArrow(_apply(model, dimension, error, to_arrow_type(rows.schema["_id"].dataType)), schema)
