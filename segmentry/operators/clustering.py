"""Reduction, K-Means segments, centroids, sizes and quality figures."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segmentry import fixed_values as fv
from segmentry.session import checkpointed
from segmentry.functions.kernels import chunks, squared_distances, texts, to_matrix, worst_ratios
from segmentry.functions.matrix import MAX_MATRIX_BYTES, bounded_rows, dimension_of, euclidean, rows_within
from segmentry.operators.search import in_blocks
from segmentry.operators.vectors import l2_normalize


# Stop rule of the K-Means starts, relative to the spread of the data.
RELATIVE_TOLERANCE = 1e-4
# Rows among which the first centres are chosen.
START_ROWS = 4096
# All iterations run in one task up to so many numbers.
TASK_CELLS = 4_000_000
# Rows whose distances to all centres are held at once.
ROWS_AT_ONCE = 4096


def _features(df: DataFrame, vector: str) -> DataFrame:
    return df.withColumn("_f", array_to_vector(F.col(vector).cast("array<double>")))


def reduce_dimensions(vectors: DataFrame, vector: str = "embedding", k: int = fv.REDUCED_DIM, name: str = "reduced") -> DataFrame:
    """Principal components of the unit vectors, at most as many as there are dimensions.

    The covariance is summed in the tasks; only its dim x dim matrix reaches the driver.
    """
    unit = _features(l2_normalize(vectors, vector, "float64"), vector)
    dim = unit.select(F.size(vector)).first()[0]
    model = PCA(k=min(k, dim), inputCol="_f", outputCol="_p").fit(unit)
    return model.transform(unit).withColumn(name, vector_to_array("_p")).drop("_f", "_p")


def without_noise(labelled: DataFrame, label: str = "segment_id") -> DataFrame:
    return labelled.where(F.col(label) != fv.NOISE)


def mean_vectors(labelled: DataFrame, label: str = "segment_id", vector: str = "embedding") -> DataFrame:
    """Mean vector and size of each segment, noise left out. Sums are combined on the map side."""
    return (
        _features(without_noise(labelled, label), vector)
        .groupBy(label)
        .agg(Summarizer.mean(F.col("_f")).alias("_m"), F.count(F.lit(1)).alias("size"))
        .select(label, vector_to_array("_m").alias("centroid"), "size")
    )


def centroids(labelled: DataFrame, label: str = "segment_id", vector: str = "embedding") -> DataFrame:
    """Unit-length mean vector and size of each segment."""
    return l2_normalize(mean_vectors(labelled, label, vector), "centroid", "float64")


def segment_sizes(labelled: DataFrame, k: int | None = None, label: str = "segment_id") -> DataFrame:
    """Rows per segment; with ``k`` the empty segments 0..k-1 appear with size 0."""
    sizes = without_noise(labelled, label).groupBy(label).agg(F.count(F.lit(1)).alias("size"))
    if k is None:
        return sizes
    ids = labelled.sparkSession.range(k).select(F.col("id").cast("int").alias(label))
    return ids.join(sizes, label, "left").select(label, F.coalesce("size", F.lit(0)).alias("size"))


def noise_share(labelled: DataFrame, label: str = "segment_id") -> DataFrame:
    """Number of segments and share of noise. Labels are counted first, so no distinct set is shuffled."""
    is_noise = F.col(label) == fv.NOISE
    return (
        labelled.groupBy(label)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.count_if(~is_noise).alias("n_segments"),
            F.coalesce(F.try_divide(F.sum(F.when(is_noise, F.col("n")).otherwise(0)), F.sum("n")), F.lit(0.0)).alias(
                "noise_fraction"
            ),
        )
    )


def silhouette(labelled: DataFrame, label: str = "segment_id", vector: str = "embedding") -> float:
    """Mean cosine silhouette over all rows but noise; 0 below two segments. Linear in the rows."""
    kept = without_noise(labelled, label)
    if len(kept.select(label).distinct().take(2)) < 2:
        return 0.0
    ready = _features(kept, vector).select("_f", F.col(label).cast("double").alias("_l"))
    evaluator = ClusteringEvaluator(
        featuresCol="_f", predictionCol="_l", metricName="silhouette", distanceMeasure="cosine"
    )
    return float(evaluator.evaluate(ready))


def davies_bouldin(
    labelled: DataFrame,
    label: str = "segment_id",
    vector: str = "embedding",
    limit_bytes: int = MAX_MATRIX_BYTES,
) -> DataFrame:
    """One row ``davies_bouldin``: mean over segments of the worst (s_i + s_j) / d_ij; 0 below two segments."""
    spark = labelled.sparkSession
    kept = without_noise(labelled, label)
    means = mean_vectors(kept, label, vector).select(label, "centroid")
    known = bounded_rows(means, limit_bytes)
    if known is not None:
        # Measured small: as a local table its size is known to the planner, which then broadcasts it.
        means = spark.createDataFrame(known, means.schema)
    spread = (
        kept.join(means, label)
        .groupBy(label)
        .agg(F.avg(euclidean(F.col(vector).cast("array<double>"), F.col("centroid"))).alias("spread"))
    )
    if known is not None:
        # One row per segment, no more than were counted above.
        by_label = {r[label]: r["spread"] for r in spread.collect()}
        order = [r[label] for r in known]
        side = (
            np.array(order),
            np.array([r["centroid"] for r in known], dtype=np.float64),
            np.array([by_label[i] for i in order]),
        )
        found = worst_ratios(*side, *side)
        value = float(found.mean()) if len(found) else 0.0
        return spark.createDataFrame([(value,)], "davies_bouldin double")
    described = means.join(spread, label).select(F.col(label).cast("string").alias("segment"), "centroid", "spread")
    blocks = max(1, -(-means.count() // min(rows_within(limit_bytes, dimension_of(means)), 2048)))
    left = in_blocks(described, "segment", blocks, "_a", "_b", blocks).groupBy("_a", "_b")
    right = in_blocks(described, "segment", blocks, "_b", "_a", blocks).groupBy("_a", "_b")

    def worst(a: pa.Table, b: pa.Table) -> pa.Table:
        def side(t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            return texts(t.column("segment")), to_matrix(t.column("centroid")), np.asarray(t.column("spread"))

        ids, *_ = own = side(a)
        found = worst_ratios(*own, *side(b))
        return pa.table({"segment": pa.array(ids, pa.string()), "worst": pa.array(found)})

    ratios = left.cogroup(right).applyInArrow(worst, "segment string, worst double")
    return (
        ratios.groupBy("segment")
        .agg(F.max("worst").alias("worst"))
        .agg(F.coalesce(F.avg("worst"), F.lit(0.0)).alias("davies_bouldin"))
    )


@dataclass
class Clustering:
    """One finished run; every table but the summary is a lazy DataFrame."""

    labels: DataFrame  # record_id, segment_id
    centroids: DataFrame  # segment_id, centroid (original space), size
    summary: DataFrame  # one row
    profiles: DataFrame  # segment_id, size, silhouette_score


@dataclass
class KMeansFit:
    """The cheapest of several starts."""

    centres: np.ndarray  # k x dim
    cost: float  # summed squared distance to the nearest centre
    costs: list[float]  # of every start
    iterations: int


def _spread_centres(rows: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k rows, each drawn with a chance that grows with its squared distance to those before."""
    rng = np.random.default_rng(seed)
    centres = [rows[rng.integers(len(rows))]]
    nearest = np.full(len(rows), np.inf)
    for _ in range(1, k):
        nearest = np.minimum(nearest, ((rows - centres[-1]) ** 2).sum(axis=1))
        total = nearest.sum()
        at = rng.choice(len(rows), p=nearest / total) if total > 0 else rng.integers(len(rows))
        centres.append(rows[at])
    return np.array(centres)


def _nearest_of_each(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every row and start the nearest centre and the squared distance; all starts in one product."""
    starts, k, dim = centres.shape
    distance = squared_distances(x, centres.reshape(starts * k, dim)).reshape(len(x), starts, k)
    at = distance.argmin(axis=2)
    return at, np.maximum(np.take_along_axis(distance, at[:, :, None], axis=2)[:, :, 0], 0.0)


def _summed(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, sums and costs of every centre of every start."""
    starts, k, dim = centres.shape
    places = starts * k
    flat = centres.reshape(places, dim)
    length = (flat**2).sum(axis=1)[:, None]
    n, sums, cost = np.zeros(places, np.int64), np.zeros((places, dim)), np.zeros(places)
    first = k * np.arange(starts)[:, None]
    for start in range(0, len(x), ROWS_AT_ONCE):
        part = x[start : start + ROWS_AT_ONCE]
        # Less the row's own length, which no choice depends on; a start's centres are the middle axis.
        distance = (length - 2 * flat @ part.T).reshape(starts, k, len(part))
        at = distance.argmin(axis=1)
        least = np.take_along_axis(distance, at[:, None, :], axis=1)[:, 0] + (part**2).sum(axis=1)
        place = (first + at).ravel()
        n += np.bincount(place, minlength=places)
        cost += np.bincount(place, weights=np.maximum(least, 0.0).ravel(), minlength=places)
        hits = np.zeros((places, len(part)))
        hits[place, np.tile(np.arange(len(part)), starts)] = 1.0
        sums += hits @ part
    return n, sums, cost


def _lloyd(step, centres: np.ndarray, tolerance: float, max_iter: int) -> tuple[np.ndarray, list[float], int]:
    """Iterations of all starts until each has ended; ``step`` gives rows, sums and costs for the centres asked about."""
    starts, k, dim = centres.shape
    running, costs, rounds = list(range(starts)), [0.0] * starts, 0
    while running:
        n, sums, cost = step(centres[running])
        n, sums = n.reshape(-1, k, 1), sums.reshape(-1, k, dim)
        after = np.where(n > 0, sums / np.maximum(n, 1), centres[running])
        rounds += 1
        moved = ((after - centres[running]) ** 2).sum(axis=(1, 2))
        ended = (moved <= tolerance) | (rounds > max_iter)
        for i, s in enumerate(running):
            costs[s] = float(cost.reshape(-1, k)[i].sum())
            # The cost belongs to the centres of this pass; they are kept when a start ends.
            centres[s] = centres[s] if ended[i] else after[i]
        running = [s for i, s in enumerate(running) if not ended[i]]
    return centres, costs, rounds


SUMS = "n array<bigint>, sums array<double>, cost array<double>"


def _sums_in_tasks(x: DataFrame, vector: str):
    """A step over all tasks, at most one for each core: each gives one row with the sums of all starts and centres."""
    tasks = x.coalesce(x.sparkSession.sparkContext.defaultParallelism)

    def step(centres: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        places, dim = centres.shape[0] * centres.shape[1], centres.shape[2]

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n, sums, cost = np.zeros(places, np.int64), np.zeros((places, dim)), np.zeros(places)
            for batch in batches:
                if batch.num_rows:
                    more = _summed(to_matrix(batch.column(vector)), centres)
                    n, sums, cost = n + more[0], sums + more[1], cost + more[2]
            lists = [pa.ListArray.from_arrays(pa.array([0, z.size], pa.int32()), pa.array(z.ravel())) for z in (n, sums, cost)]
            yield pa.RecordBatch.from_arrays(lists, names=["n", "sums", "cost"])

        # starts x k rows for each core; an exchange to add them up would cost more than the pass.
        parts = tasks.mapInArrow(scan, SUMS).toArrow()
        n, sums, cost = (to_matrix(parts.column(c)).sum(axis=0) for c in ("n", "sums", "cost"))
        return n.astype(np.int64), sums.reshape(places, dim), cost

    return step


def fit_kmeans(
    rows: DataFrame,
    k: int,
    vector: str,
    seed: int = fv.SEED,
    starts: int = fv.KMEANS_STARTS,
    max_iter: int = fv.KMEANS_MAX_ITER,
    task_cells: int = TASK_CELLS,
) -> KMeansFit:
    """Lloyd's iterations of all starts together: one pass and one small aggregate per iteration.

    Each start begins with centres spread over the first ``START_ROWS`` rows in a fixed random order. A start ends when
    its centres together move by no more than a ten-thousandth of the mean variance of the features (squared), and
    leaves the passes that follow. A centre that loses all its rows stays where it is. ``rows`` is read once per
    iteration (pass a stored or persisted table), unless all its numbers, counted first, fit one task.
    """
    x = rows.select(vector)
    sample = x.orderBy(F.xxhash64(vector)).limit(START_ROWS).collect()
    first = np.array([r[0] for r in sample], dtype=np.float64)
    if not len(first):
        return KMeansFit(np.zeros((k, 0)), 0.0, [0.0] * starts, 0)
    total, variance = x.select(F.count(F.lit(1)), Summarizer.variance(array_to_vector(F.col(vector)))).first()
    tolerance = RELATIVE_TOLERANCE * float(np.mean(variance.toArray()))
    centres = np.array([_spread_centres(first, k, seed + s) for s in range(starts)])
    if total * first.shape[1] <= task_cells:

        def whole(table: pa.Table) -> pa.Table:
            data = to_matrix(table.column(vector))
            found, costs, rounds = _lloyd(lambda c: _summed(data, c), centres.copy(), tolerance, max_iter)
            flat = [c.ravel().tolist() for c in found]
            return pa.table({"start": pa.array(range(len(flat)), pa.int32()), "centres": pa.array(flat, pa.list_(pa.float64())), "cost": costs, "rounds": pa.array([rounds] * len(flat), pa.int32())})

        done = sorted(x.groupBy(F.lit("all")).applyInArrow(whole, "start int, centres array<double>, cost double, rounds int").collect())
        centres = np.array([r["centres"] for r in done]).reshape(centres.shape)
        costs, rounds = [r["cost"] for r in done], done[0]["rounds"]
    else:
        centres, costs, rounds = _lloyd(_sums_in_tasks(x, vector), centres, tolerance, max_iter)
    best = int(np.argmin(costs))
    return KMeansFit(centres[best], costs[best], costs, rounds)


def with_nearest_centre(rows: DataFrame, centres: np.ndarray, vector: str, name: str = "segment_id") -> DataFrame:
    """Adds the number of the nearest centre, the lowest on ties."""

    @F.arrow_udf(T.IntegerType())
    def nearest(vectors: pa.Array) -> pa.Array:
        x = to_matrix(vectors)
        at = [_nearest_of_each(x[part], centres[None])[0][:, 0] for part in chunks(len(x), len(centres))]
        return pa.array(np.concatenate(at).astype(np.int32) if at else [], pa.int32())

    return rows.withColumn(name, nearest(F.col(vector).cast("array<double>")))


def kmeans_labels(
    vectors: DataFrame,
    k: int = fv.N_SEGMENTS,
    vector: str = "reduced",
    seed: int = fv.SEED,
    starts: int = fv.KMEANS_STARTS,
    max_iter: int = fv.KMEANS_MAX_ITER,
) -> DataFrame:
    """Adds ``segment_id`` of the cheapest of several K-Means starts (``fit_kmeans``)."""
    ready = vectors.select(F.col(vector).cast("array<double>").alias(vector)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fit = fit_kmeans(ready, k, vector, seed, starts, max_iter)
    finally:
        ready.unpersist()
    return with_nearest_centre(vectors, fit.centres, vector)


def describe_run(
    labelled: DataFrame,
    algorithm: str,
    started: float,
    k: int | None = None,
    record_id: str = "record_id",
    vector: str = "embedding",
    space: str = "reduced",
) -> Clustering:
    """Centroids in the original space, quality in the clustered space, one profile per segment."""
    spark = labelled.sparkSession
    quality = silhouette(labelled, vector=space)
    separation = davies_bouldin(labelled, vector=space).first()[0]
    noise = noise_share(labelled).first()
    sizes = segment_sizes(labelled, k)
    summary = spark.createDataFrame(
        [
            (
                algorithm,
                int(k if k is not None else noise["n_segments"]),
                quality,
                separation,
                float(noise["noise_fraction"]),
                dt.datetime.now(dt.timezone.utc),
                time.perf_counter() - started,
            )
        ],
        "algorithm string, n_segments int, silhouette double, davies_bouldin double, "
        "noise_fraction double, run_timestamp timestamp, elapsed_seconds double",
    )
    return Clustering(
        labels=labelled.select(F.col(record_id).cast("string").alias("record_id"), "segment_id"),
        centroids=centroids(labelled, vector=vector),
        summary=summary,
        profiles=sizes.withColumn("silhouette_score", F.lit(quality)),
    )


def run_kmeans(vectors: DataFrame, k: int = fv.N_SEGMENTS, record_id: str = "record_id", vector: str = "embedding", **options) -> Clustering:
    """Reduce, cluster, describe."""
    started = time.perf_counter()
    # The finished run's tables are lazy and read this again, so it is stored rather than cached for good.
    reduced = checkpointed(reduce_dimensions(vectors, vector))
    labelled = kmeans_labels(reduced, k, **options)
    return describe_run(labelled, "kmeans", started, k, record_id, vector)


def save_run(run: Clustering, path: str, run_id: str) -> None:
    """Labels, centroids, profiles and summary of one run under its id."""
    for name in ("labels", "centroids", "profiles", "summary"):
        getattr(run, name).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{name}/run_id={run_id}")


def holdout_evaluation(
    vectors: DataFrame, k: int = fv.N_SEGMENTS, vector: str = "embedding", train_share: float = 0.8, seed: int = fv.SEED,
    starts: int = fv.KMEANS_STARTS,
) -> DataFrame:
    """Fits the cheapest of several starts on a random share of the rows; silhouette and Davies-Bouldin of the rest."""
    train, test = vectors.withColumn(vector, F.col(vector).cast("array<double>")).randomSplit([train_share, 1 - train_share], seed)
    fit = fit_kmeans(checkpointed(train.select(vector)), k, vector, seed, starts)
    placed = with_nearest_centre(test, fit.centres, vector)
    return davies_bouldin(placed, vector=vector).withColumn("silhouette", F.lit(silhouette(placed, vector=vector)))
