"""Nearest vectors by inner product of unit vectors.

Three ways to the same exact answer, chosen by measured sizes:

* few queries: they are broadcast, every task keeps its own best k per query, and only those meet;
* small store: it is broadcast, every query row is answered where it is;
* both large: both sides are cut into blocks and every block pair is one task (each side is copied
  once per block of the other), again keeping k per query and pair.

No way materialises all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segmentry import fixed_values as fv
from segmentry.functions.kernels import RunningBest, best, chunks, result_rows, scores_of, slices, texts, to_matrix
from segmentry.functions.matrix import MAX_MATRIX_BYTES, bounded_rows, dimension_of, rows_within
from segmentry.session import stored

BLOCK_BYTES = 64 * 1024 * 1024
# So many queries at most are answered by brute force to measure recall.
RECALL_QUERIES = 1000
RESULT = T.StructType(
    [
        T.StructField("query_id", T.StringType()),
        T.StructField("record_id", T.StringType()),
        T.StructField("score", T.DoubleType()),
    ]
)


def _as_side(df: DataFrame, key: str, vector: str, name: str) -> DataFrame:
    return df.select(F.col(key).cast("string").alias(name), F.col(vector).alias("v"))


def _final(partial: DataFrame, k: int) -> DataFrame:
    """Best k per query out of the tasks' own best; rank starts at 1."""
    w = W.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("record_id"))
    return partial.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _search_few_queries(queries: list, store: DataFrame, k: int) -> DataFrame:
    spark = store.sparkSession
    ids = np.array([r[0] for r in queries], dtype=object)
    matrix = np.array([r[1] for r in queries], dtype=np.float64)
    shared = spark.sparkContext.broadcast((ids, matrix))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, wanted = shared.value
        everyone, kept = np.arange(len(query_ids)), RunningBest(len(query_ids), k)
        for record_ids, vectors in slices(batches, "record_id", len(query_ids)):
            kept.add(everyone, scores_of(wanted, vectors), record_ids)
        yield result_rows(query_ids, kept.kept)

    return store.mapInArrow(scan, RESULT)


def _search_small_store(queries: DataFrame, store: list, k: int) -> DataFrame:
    spark = queries.sparkSession
    ids = np.array([r[0] for r in store], dtype=object)
    matrix = np.array([r[1] for r in store], dtype=np.float64)
    shared = spark.sparkContext.broadcast((ids, matrix))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        record_ids, known = shared.value
        for query_ids, vectors in slices(batches, "query_id", len(record_ids)):
            scores = scores_of(vectors, known)
            found = [best(row, record_ids, k) for row in scores]
            yield result_rows(query_ids, [(record_ids[at], row[at]) for row, at in zip(scores, found)])

    return queries.mapInArrow(scan, RESULT)


def in_blocks(df: DataFrame, key: str, blocks: int, mine: str, other: str, other_blocks: int) -> DataFrame:
    """Rows assigned to one of ``blocks`` by key, and copied once per block of the other side.

    The task number is added to the hash, so copies of one id are spread too.
    """
    block = F.pmod(F.xxhash64(key) + F.spark_partition_id(), F.lit(blocks)).cast("int")
    # Fresh column identities: both sides of a cogroup may come from one table.
    return df.select(
        *[F.col(c).alias(c) for c in df.columns],
        block.alias(mine),
        F.explode(F.sequence(F.lit(0), F.lit(other_blocks - 1))).alias(other),
    )


def _search_in_blocks(queries: DataFrame, store: DataFrame, k: int, q_blocks: int, s_blocks: int) -> DataFrame:
    left = in_blocks(queries, "query_id", q_blocks, "_q", "_s", s_blocks).groupBy("_q", "_s")
    right = in_blocks(store, "record_id", s_blocks, "_s", "_q", q_blocks).groupBy("_q", "_s")
    return left.cogroup(right).applyInArrow(_best_of_pair(k), RESULT)


def _best_of_pair(k: int):
    """The k best records of one block for each query of another."""

    def pair(a: pa.Table, b: pa.Table) -> pa.Table:
        query_ids, record_ids = texts(a.column("query_id")), texts(b.column("record_id"))
        wanted, known = to_matrix(a.column("v")), to_matrix(b.column("v"))
        found = []
        if len(record_ids):
            for part in chunks(len(query_ids), len(record_ids)):
                for row in scores_of(wanted[part], known):
                    at = best(row, record_ids, k)
                    found.append((record_ids[at], row[at]))
        return pa.Table.from_batches([result_rows(query_ids[: len(found)], found)])

    return pair


def exact_top_k(
    queries: DataFrame,
    store: DataFrame,
    query_id: str,
    record_id: str,
    k: int = fv.DEFAULT_TOP_K,
    vector: str = "embedding",
    limit_bytes: int = MAX_MATRIX_BYTES,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The k stored vectors of highest score per query (all of them if the store is smaller)."""
    q = _as_side(queries, query_id, vector, "query_id")
    s = _as_side(store, record_id, vector, "record_id")
    few = bounded_rows(q, limit_bytes)
    if few == []:
        return _final(q.sparkSession.createDataFrame([], RESULT), k)
    if few is not None:
        return _final(_search_few_queries(few, s, k), k)
    small = bounded_rows(s, limit_bytes)
    if small is not None:
        return _final(_search_small_store(q, small, k), k)
    rows = rows_within(block_bytes, dimension_of(s))
    q_blocks, s_blocks = (max(1, math.ceil(side.count() / rows)) for side in (q, s))
    return _final(_search_in_blocks(q, s, k, q_blocks, s_blocks), k)


# Approximate search ------------------------------------------------------------------------


def build_cells(store: DataFrame, path: str, cells: int = fv.ANN_CELLS, vector: str = "embedding", seed: int = fv.SEED) -> np.ndarray:
    """Writes the store partitioned by coarse K-Means cell; returns the cell centres."""
    features = store.withColumn("_f", array_to_vector(F.col(vector).cast("array<double>")))
    model = KMeans(k=cells, seed=seed, maxIter=20, featuresCol="_f", predictionCol="cell").fit(features)
    placed = model.transform(features).drop("_f")
    placed.hint("rebalance", "cell").write.mode("overwrite").partitionBy("cell").parquet(path)
    return np.array(model.clusterCenters())


def _nearest_cells(wanted: np.ndarray, centers: np.ndarray, probes: int) -> np.ndarray:
    distance = (centers**2).sum(axis=1) - 2 * wanted @ centers.T
    return np.argsort(distance, axis=1, kind="stable")[:, :probes]


def _with_cells(queries: DataFrame, centers: np.ndarray, choose) -> DataFrame:
    """One copy of each query for each of its cells; ``choose`` gives an array of cells per row of a batch."""
    shared = queries.sparkSession.sparkContext.broadcast(centers)
    kept = T.StructType([f for f in queries.schema.fields if f.name in ("query_id", "v")])
    asking = T.StructType([*kept.fields, T.StructField("cell", T.IntegerType())])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch.num_rows, len(shared.value)):
                piece = batch.slice(part.start, part.stop - part.start)
                cells = choose(piece, shared.value)
                rows = np.repeat(np.arange(piece.num_rows), [len(c) for c in cells])
                copies = piece.select(["query_id", "v"]).take(pa.array(rows))
                flat = np.concatenate(cells).astype(np.int32) if len(cells) else np.empty(0, np.int32)
                yield pa.RecordBatch.from_arrays([*copies.columns, pa.array(flat)], [*copies.schema.names, "cell"])

    return queries.mapInArrow(send, asking)


def _meet_in_cells(asked: DataFrame, store: DataFrame, dimension: int, k: int, block_bytes: int) -> DataFrame:
    """Queries and records of a cell are cut into blocks that meet in pairs."""
    rows = rows_within(block_bytes, dimension)
    # One row for each cell, as many as there are centres.
    blocks = lambda df, name: df.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / rows).cast("int").alias(name))
    sizes = F.broadcast(blocks(asked, "_nq").join(blocks(store, "_ns"), "cell"))
    own = lambda key, n: F.pmod(F.xxhash64(key) + F.spark_partition_id(), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = asked.join(sizes, "cell").select("query_id", "v", "cell", own("query_id", "_nq").alias("_q"), every("_ns").alias("_s"))
    right = store.join(sizes, "cell").select("record_id", "v", "cell", own("record_id", "_ns").alias("_s"), every("_nq").alias("_q"))
    groups = left.groupBy("cell", "_q", "_s").cogroup(right.groupBy("cell", "_q", "_s"))
    return groups.applyInArrow(_best_of_pair(k), RESULT)


def _probe_in_blocks(queries: DataFrame, store: DataFrame, centers: np.ndarray, k: int, probes: int, block_bytes: int) -> DataFrame:
    """Every query goes to its nearest cells."""
    near = lambda piece, at: list(_nearest_cells(to_matrix(piece.column("v")), at, probes))
    return _meet_in_cells(_with_cells(queries, centers, near), store, centers.shape[1], k, block_bytes)


@dataclass
class BoundedSearch:
    """The exact answer, and the share of all query-record pairs that were compared for it."""

    found: DataFrame
    compared: float


def bounded_top_k(
    queries: DataFrame,
    cell_table: DataFrame,
    centers: np.ndarray,
    query_id: str,
    record_id: str,
    k: int = fv.DEFAULT_TOP_K,
    probes: int = 2,
    vector: str = "embedding",
    block_bytes: int = BLOCK_BYTES,
) -> BoundedSearch:
    """The exact k best, without the cells that cannot hold one of them.

    A record of a cell scores at most the query's product with the centre plus the query's length times the cell's
    radius. The nearest cells give each query a k-th best score so far; then only cells whose bound reaches it are
    searched. Rows of an unlisted cell are never compared. Nothing but one row per cell is collected.
    """
    spark = queries.sparkSession
    q = stored(_as_side(queries, query_id, vector, "query_id").select("query_id", F.col("v").cast("array<double>").alias("v")))
    known = cell_table.select(F.col(record_id).cast("string").alias("record_id"), F.col(vector).cast("array<double>").alias("v"), "cell")
    radii, sizes = np.zeros(len(centers)), np.zeros(len(centers), np.int64)
    for r in _cell_sizes(known, centers).collect():  # one row per cell
        radii[r["cell"]], sizes[r["cell"]] = r["radius"], r["n"]

    near = lambda piece, at: list(_nearest_cells(to_matrix(piece.column("v")), at, probes))
    first = stored(_final(_meet_in_cells(_with_cells(q, centers, near), known, centers.shape[1], k, block_bytes), k).drop("rank"))
    # Fewer than k so far: every cell may hold one.
    floors = first.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("floor"))
    asking = stored(q.join(floors, "query_id", "left"))

    def reaching(piece: pa.RecordBatch, at: np.ndarray) -> list[np.ndarray]:
        x = to_matrix(piece.column("v"))
        bound = x @ at.T + np.linalg.norm(x, axis=1)[:, None] * radii[None, :]
        floor = np.asarray(piece.column("floor").fill_null(-np.inf))
        # Scores are rounded, so the bound gives a hair more.
        open_ = (bound >= floor[:, None] - 1e-8) & (sizes > 0)[None, :]
        np.put_along_axis(open_, _nearest_cells(x, at, probes), False, axis=1)
        return [np.flatnonzero(row) for row in open_]

    rest = stored(_with_cells(asking, centers, reaching))
    more = _meet_in_cells(rest, known, centers.shape[1], k, block_bytes)
    counts = spark.createDataFrame([(i, int(n)) for i, n in enumerate(sizes)], "cell int, n long")
    opened = rest.join(F.broadcast(counts), "cell").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    probed = _with_cells(q, centers, near).join(F.broadcast(counts), "cell").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    pairs = max(1, q.count() * int(sizes.sum()))
    return BoundedSearch(_final(first.unionByName(more), k), (opened + probed) / pairs)


def _cell_sizes(known: DataFrame, centers: np.ndarray) -> DataFrame:
    """Rows and radius of every cell."""
    shared = known.sparkSession.sparkContext.broadcast(centers)

    @F.arrow_udf(T.DoubleType())
    def off(vectors: pa.Array, cell: pa.Array) -> pa.Array:
        x, at = to_matrix(vectors), np.asarray(cell)
        return pa.array(np.sqrt(((x - shared.value[at]) ** 2).sum(axis=1)) if len(x) else np.empty(0))

    measured = known.select("cell", off("v", "cell").alias("off"))
    return measured.groupBy("cell").agg(F.max("off").alias("radius"), F.count(F.lit(1)).alias("n"))


def probes_for_recall(
    queries: DataFrame,
    cell_table: DataFrame,
    centers: np.ndarray,
    query_id: str,
    record_id: str,
    k: int = fv.DEFAULT_TOP_K,
    least_recall: float = fv.LEAST_RECALL,
    vector: str = "embedding",
    most_queries: int = RECALL_QUERIES,
) -> int:
    """The fewest cells to probe so that at least the given share of the true k nearest is found.

    Measured against brute force on all queries, or on ``most_queries`` of them in a fixed random order: the exact
    search gives the cells of the true nearest, and the place of each in its query's order of cells says how many
    probes reach it. One pass over the store, whatever the number of probes.
    """
    asked = queries.select(F.col(query_id).cast("string").alias("_id"), F.col(vector).cast("array<double>"))
    rows = [r[1] for r in asked.orderBy(F.xxhash64("_id"), "_id").limit(most_queries).collect()]
    if not rows:
        return 1
    sample = queries.sparkSession.createDataFrame(list(enumerate(rows)), f"_q int, {vector} array<double>")
    # The cell travels behind the record's id, so that equal scores still go by id and repeated ids keep their cells.
    placed = cell_table.select(F.concat_ws("\x00", F.col(record_id).cast("string"), "cell").alias("_at"), vector)
    found = exact_top_k(sample, placed, "_q", "_at", k=k, vector=vector)
    true = found.select(F.col("query_id").cast("int"), F.substring_index("record_id", "\x00", -1).cast("int")).collect()  # at most most_queries x k
    if not true:
        return 1
    place = np.argsort(_nearest_cells(np.array(rows, dtype=np.float64), centers, len(centers)), axis=1)
    needed = np.sort([place[q, cell] for q, cell in true])
    return int(needed[math.ceil(least_recall * len(needed)) - 1]) + 1


def approximate_top_k(
    queries: DataFrame,
    cell_table: DataFrame,
    centers: np.ndarray,
    query_id: str,
    record_id: str,
    k: int = fv.DEFAULT_TOP_K,
    probes: int = 10,
    vector: str = "embedding",
    limit_bytes: int = MAX_MATRIX_BYTES,
    block_bytes: int = BLOCK_BYTES,
    least_recall: float | None = None,
) -> DataFrame:
    """Top k among the ``probes`` cells closest to each query; all cells give the exact answer.

    A query whose cells together hold fewer than k records gets fewer. With queries up to the limit, only
    the folders of probed cells are read, and a hot cell is scored by as many tasks as it has file splits.
    With more, queries and records of a cell meet in blocks; the result is the same. With ``least_recall``,
    ``probes`` is where the search begins: it goes on to as many cells as ``probes_for_recall`` measures.
    """
    if least_recall is not None and probes < len(centers):
        probes = max(probes, probes_for_recall(queries, cell_table, centers, query_id, record_id, k, least_recall, vector))
    q = _as_side(queries, query_id, vector, "query_id")
    few = bounded_rows(q, limit_bytes)
    if few is None:
        known = cell_table.select(F.col(record_id).cast("string").alias("record_id"), F.col(vector).alias("v"), "cell")
        return _final(_probe_in_blocks(q, known, centers, k, probes, block_bytes), k)
    if not few:
        return _final(q.sparkSession.createDataFrame([], RESULT), k)
    ids = np.array([r[0] for r in few], dtype=object)
    matrix = np.array([r[1] for r in few], dtype=np.float64)
    near = _nearest_cells(matrix, centers, probes)
    by_cell = {int(c): np.flatnonzero((near == c).any(axis=1)) for c in np.unique(near)}
    shared = cell_table.sparkSession.sparkContext.broadcast((ids, matrix, by_cell))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, wanted, probing = shared.value
        kept = RunningBest(len(query_ids), k)
        for batch in batches:
            for part in chunks(batch.num_rows, len(query_ids)):
                piece = batch.slice(part.start, part.stop - part.start)
                cell, record_ids = np.asarray(piece.column("cell")), texts(piece.column("record_id"))
                vectors = to_matrix(piece.column("v"))
                for c in np.unique(cell):
                    inside, members = np.flatnonzero(cell == c), probing[int(c)]
                    kept.add(members, scores_of(wanted[members], vectors[inside]), record_ids[inside])
        yield result_rows(query_ids, kept.kept)

    store = cell_table.where(F.col("cell").isin(list(by_cell))).select(
        F.col(record_id).cast("string").alias("record_id"), F.col(vector).alias("v"), "cell"
    )
    return _final(store.mapInArrow(scan, RESULT), k)
