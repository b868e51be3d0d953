"""Vector columns as numpy matrices inside tasks.

Spark partitions the rows and ships Arrow batches; these helpers only turn one batch into one
matrix product. Sums run in double precision whatever the stored type is.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segmentry.functions.kernels import scores_of, to_matrix

# A matrix is copied to every executor only below this size; beyond it the callers use a shuffle.
MAX_MATRIX_BYTES = 128 * 1024 * 1024


def rows_within(limit_bytes: int, dimension: int) -> int:
    """How many vectors of a dimension fit into the limit, as double precision numbers."""
    return max(1, limit_bytes // (8 * max(1, dimension)))


def dimension_of(df: DataFrame) -> int:
    """The length of the vectors in the last column, which all have one length; 1 without vectors."""
    found = df.select(F.size(df.columns[-1]).alias("d")).where("d > 0").first()
    return found[0] if found else 1


def bounded_rows(df: DataFrame, limit_bytes: int = MAX_MATRIX_BYTES) -> list | None:
    """All rows of a table whose last column is a vector if they fit into the limit, else None."""
    rows = rows_within(limit_bytes, dimension_of(df))
    found = df.take(rows + 1)
    return found if len(found) <= rows else None


@F.arrow_udf(T.DoubleType())
def _euclidean(a: pa.Array, b: pa.Array) -> pa.Array:
    return pa.array(np.sqrt(((to_matrix(a) - to_matrix(b)) ** 2).sum(axis=1)))


@F.arrow_udf(T.DoubleType())
def _dot(a: pa.Array, b: pa.Array) -> pa.Array:
    return pa.array(np.einsum("ij,ij->i", to_matrix(a), to_matrix(b)))


def euclidean(a: Column, b: Column) -> Column:
    """Row-wise distance of two vector columns."""
    return _euclidean(a, b)


def dot(a: Column, b: Column) -> Column:
    """Row-wise inner product of two vector columns."""
    return _dot(a, b)


def nearest_row(spark: SparkSession, ids: list[int], matrix: np.ndarray):
    """A function of a vector column giving struct(id, score) of the row with the largest inner product.

    Ties go to the lowest id. The matrix is broadcast, so its size is checked here.
    """
    if matrix.nbytes > MAX_MATRIX_BYTES:
        raise ValueError("matrix too large to broadcast")
    order = np.argsort(ids)
    shared = spark.sparkContext.broadcast((np.asarray(ids)[order], matrix[order]))
    result = T.StructType(
        [T.StructField("id", T.IntegerType()), T.StructField("score", T.DoubleType())]
    )

    @F.arrow_udf(result)
    def nearest(vectors: pa.Array) -> pa.Array:
        known, rows = shared.value
        if len(vectors) == 0:
            best, score = np.empty(0, dtype=np.int32), np.empty(0)
        else:
            scores = scores_of(to_matrix(vectors), rows)
            at = scores.argmax(axis=1)
            best, score = known[at].astype(np.int32), scores[np.arange(len(at)), at]
        return pa.StructArray.from_arrays(
            [pa.array(best, pa.int32()), pa.array(score)], names=["id", "score"]
        )

    return nearest
