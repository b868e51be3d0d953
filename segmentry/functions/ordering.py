"""Running totals, row numbers and exact quantiles over a global order.

An unpartitioned window would pull every row into one task. Here the rows are dealt out by ranges of the
order, as many ranges as the number of rows asks for; every task sorts and sums its own range, and the
totals of the ranges before it, one row per range (and group), are added afterwards. Rows are shuffled
once, and the dealt rows are written to the shared folder, so that all later steps see the same ranges.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segmentry.session import checkpointed

# A task sorts about so many rows.
ROWS_PER_TASK = 500_000
# Offsets are copied to every task up to so many rows, and joined by a shuffle beyond.
BROADCAST_ROWS = 100_000
# monotonically_increasing_id() counts the rows of a task in its lower 33 bits, with the task's number above.
PLACE_BITS = 33


def tasks_for(df: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> int:
    """How many ranges a table is cut into: they grow with its rows, and occupy the cluster if it is small."""
    return max(math.ceil(df.count() / rows_per_task), df.sparkSession.sparkContext.defaultParallelism)


def _in_ranges(df: DataFrame, order: list[str], tasks: int | None) -> DataFrame:
    """Rows dealt out and sorted by ``order`` (nulls first), with ``_order_part`` and their ``_order_place`` in it from 0."""
    keys = [F.col(c).asc_nulls_first() for c in order]
    dealt = df.repartitionByRange(tasks or tasks_for(df), *keys).sortWithinPartitions(*keys)
    at = dealt.withColumn("_order_at", F.monotonically_increasing_id())
    place = F.col("_order_at").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    return at.withColumns({"_order_part": F.shiftright("_order_at", PLACE_BITS), "_order_place": place}).drop("_order_at")


def _with_offsets(rows: DataFrame, by: list[str], totals: list[Column], before: dict[str, str], whole: dict[str, str], keep: list[str] = []) -> DataFrame:
    """Joins to every row what the ranges before its own hold of its group, and what the whole group holds.

    ``before`` and ``whole`` name the sums to make from columns of ``totals``; ``keep`` lists columns of it to
    keep. The totals have one row per range and group: a group has as many as the ranges it reaches into.
    """
    keys = [*by, "_order_part"]
    sums = rows.groupBy(*keys).agg(*totals)
    group = W.partitionBy(*(by or [F.lit(1)]))
    earlier = group.orderBy("_order_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = checkpointed(
        sums.select(
            *[F.col(c).alias(f"_order_key{i}") for i, c in enumerate(keys)],
            *keep,
            *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(name) for name, c in before.items()],
            *[F.sum(c).over(group).alias(name) for name, c in whole.items()],
        )
    )
    if offsets.count() <= BROADCAST_ROWS:
        offsets = F.broadcast(offsets)
    same = [F.col(c).eqNullSafe(F.col(f"_order_key{i}")) for i, c in enumerate(keys)]
    return rows.join(offsets, same).drop(*[f"_order_key{i}" for i in range(len(keys))])


def row_numbers(df: DataFrame, order: list[str], name: str, by: list[str] | None = None, tasks: int | None = None) -> DataFrame:
    """Adds ``name``, the number of a row from 1 in ``order`` (any types, nulls first), within ``by`` if given.

    Rows that are equal in all of ``order`` are numbered in any order. A group may hold any share of the rows.
    """
    by = by or []
    rows = checkpointed(_in_ranges(df, [*by, *order], tasks))
    totals = [F.count(F.lit(1)).alias("_order_n"), F.min("_order_place").alias("_order_first")]
    placed = _with_offsets(rows, by, totals, {"_order_before": "_order_n"}, {}, keep=["_order_first"])
    number = F.col("_order_before") + F.col("_order_place") - F.col("_order_first") + F.lit(1)
    return placed.select(*df.columns, number.alias(name))


def _same_as_before(column: pa.ChunkedArray | pa.Array, last: list | None, at: int) -> np.ndarray:
    """Whether each value equals the one before it; the first is compared with ``last[at]``."""
    value = column[0].as_py()
    head = last is not None and (value == last[at] or (value != value and last[at] != last[at]))
    if len(column) == 1:
        return np.array([head])
    a, b = column.slice(1), column.slice(0, len(column) - 1)
    equal = pc.fill_null(pc.equal(a, b), False)
    both_null = pc.and_(pc.is_null(a), pc.is_null(b))
    if pa.types.is_floating(column.type):
        both_null = pc.or_(both_null, pc.fill_null(pc.and_(pc.is_nan(a), pc.is_nan(b)), False))
    return np.concatenate([[head], np.asarray(pc.or_(equal, both_null))])


def _sums_in_range(by: list[str], values: list[str], kinds: list[pa.DataType]) -> Callable:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, carried = None, [0] * len(values)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            same = np.ones(n, dtype=bool)
            if last is None:
                same[0] = False
            for i, c in enumerate(by):
                same &= _same_as_before(batch.column(c), last, i)
            last = [batch.column(c)[n - 1].as_py() for c in by]
            # The place where each row's group begins, -1 for a group that began in an earlier batch.
            begins = np.maximum.accumulate(np.where(same, -1, np.arange(n)))
            out = []
            for i, (v, kind) in enumerate(zip(values, kinds)):
                x = np.asarray(pc.fill_null(batch.column(v), 0)).astype(kind.to_pandas_dtype())
                total = np.cumsum(x)
                base = np.where(begins >= 0, total[begins] - x[begins], -np.asarray(carried[i], x.dtype))
                local = total - base
                carried[i] = local[-1]
                out.append(pa.array(local, kind))
            names = [*batch.schema.names, *[f"_order_cum_{v}" for v in values]]
            yield pa.RecordBatch.from_arrays([*batch.columns, *out], names)

    return scan


def running_sum(df: DataFrame, order: str, values: list[str], by: list[str] | None = None, tasks: int | None = None) -> DataFrame:
    """Adds ``cum_<v>`` and ``all_<v>`` for each value column: the sum up to this row, and over its group.

    ``order`` must be distinct within a group (aggregate first), which also makes hot order values harmless.
    Null values count as 0.
    """
    by = by or []
    whole = {v: isinstance(df.schema[v].dataType, T.IntegralType) for v in values}
    kinds = [pa.int64() if whole[v] else pa.float64() for v in values]
    ranged = _in_ranges(df, [*by, order], tasks)
    added = [T.StructField(f"_order_cum_{v}", T.LongType() if whole[v] else T.DoubleType()) for v in values]
    local = checkpointed(ranged.mapInArrow(_sums_in_range(by, values, kinds), T.StructType([*ranged.schema.fields, *added])))
    totals = [F.coalesce(F.sum(v), F.lit(0)).alias(f"_order_t_{v}") for v in values]
    before, all_of = {f"_order_before_{v}": f"_order_t_{v}" for v in values}, {f"all_{v}": f"_order_t_{v}" for v in values}
    joined = _with_offsets(local, by, totals, before, all_of)
    return joined.select(
        *df.columns,
        *[(F.col(f"_order_cum_{v}") + F.col(f"_order_before_{v}")).alias(f"cum_{v}") for v in values],
        *[f"all_{v}" for v in values],
    )


def global_row_number(df: DataFrame, order: str, name: str, tasks: int | None = None) -> DataFrame:
    """Numbers rows from 1 in the order of a unique column."""
    return row_numbers(df, [order], name, tasks=tasks)


def exact_quantiles(
    df: DataFrame,
    value: str,
    probabilities: dict[str, float],
    by: list[str] | None = None,
    tasks: int | None = None,
    weight: str | None = None,
) -> DataFrame:
    """Linear-interpolation quantiles, one row per group, one column per entry of ``probabilities``.

    ``weight`` names a column saying how often a row counts. Null and NaN are left out.

    Values are counted before any shuffle of rows, so memory does not grow with repeats of a value and
    no aggregation buffer has to hold all distinct values of a group.
    """
    by = by or []
    counts = (
        df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
        .groupBy(*by, F.col(value).cast("double").alias("_v"))
        .agg((F.sum(weight) if weight else F.count(F.lit(1))).cast("long").alias("n"))
    )
    # Counting the rows, finding the ranges and dealing them out each read the counts: scan the input only once.
    ranked = running_sum(checkpointed(counts), "_v", ["n"], by=by, tasks=tasks)
    last = F.col("all_n") - 1

    def at(rank: Column) -> Column:
        # The value that holds 0-based position ``rank``.
        holds = (F.col("cum_n") > rank) & (F.col("cum_n") - F.col("n") <= rank)
        return F.max(F.when(holds, F.col("_v")))

    picked = ranked.groupBy(*by).agg(
        F.first("all_n").alias("_order_n"),
        *[at(F.floor(last * p)).alias(f"_lo_{k}") for k, p in probabilities.items()],
        *[at(F.ceil(last * p)).alias(f"_hi_{k}") for k, p in probabilities.items()],
    )

    def interpolated(k: str, p: float) -> Column:
        position = (F.col("_order_n") - 1) * F.lit(p)
        low, high = F.col(f"_lo_{k}"), F.col(f"_hi_{k}")
        return low + (high - low) * (position - F.floor(position))

    return picked.select(*by, *[interpolated(k, p).alias(k) for k, p in probabilities.items()])
