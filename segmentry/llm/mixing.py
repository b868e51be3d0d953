"""Mixing sources to target weights by fitting word budgets exactly.

Sources in code point order (null last) have the weights 5, 2, 1, repeating, and share the words of the whole
table. A target above ``max_times`` times its source is cut to that and the excess shared again by weight.
Every source is taken whole as often as it fits its target; what is left of the target is a budget below the
source's size. The budget is met from counts of documents by exact length: the same share of every length
first, up to a reserve of several longest documents, which a bounded-knapsack table decides, so a source misses its
target only by what no subset of the documents held back can reach. Which documents of a
length are taken follows a seeded hash of their ids, so reruns agree.

Nothing but a row for each source, length and slice of the seeded order is gathered for a source; documents of
one length in one source are ranked in slices, so a hot source or many copies do not meet in one task.

Defined results: a null text has size 0; documents of size 0 are taken as often as the source is taken whole;
rows with one id and size are taken in any order among themselves; an empty table gives no rows.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segmentry.llm.hashing import row_hash
from segmentry.session import checkpointed

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WEIGHTS = (5, 2, 1)
MAX_TIMES = 3
SEED = 20
# The seeded order is cut into so many slices for each source and length.
SLICES = 4096
# The knapsack table covers the words of so many of a source's longest documents, more if that misses the budget.
RESERVES = (4, 32)
SPACE = "[^\\x20\\x09-\\x0D]+"


def word_total(text: Column) -> Column:
    return F.when(text.isNull(), 0).otherwise(F.regexp_count(text, F.lit(SPACE))).cast("bigint")


def targets(sizes: dict[str | None, int], max_times: int = MAX_TIMES) -> dict[str | None, float]:
    """Words wanted from each source; ``sizes`` has a row for each source."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weights = {s: WEIGHTS[i % len(WEIGHTS)] for i, s in enumerate(names)}
    out = {s: 0.0 for s in names}
    left, free = float(sum(sizes.values())), list(names)
    while free:
        total = sum(weights[s] for s in free)
        share = {s: left * weights[s] / total for s in free}
        full = [s for s in free if share[s] > max_times * sizes[s]]
        if not full:
            out.update(share)
            break
        for s in full:
            out[s] = float(max_times * sizes[s])
            left -= out[s]
        free = [s for s in free if s not in set(full)]
    return out


def knapsack(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many of each length to take for a sum as near below ``budget`` as the lengths allow.

    The table has a place for each sum up to ``budget`` and notes which bundle reached it first; each length enters
    as bundles of 1, 2, 4, ... pieces, so a sum without its bundle was reached by earlier ones.
    """
    unit = int(np.gcd.reduce(lengths))
    budget, lengths = budget // unit, lengths // unit
    by = np.full(budget + 1, -1, np.int32)
    by[0] = 0
    bundles: list[tuple[int, int]] = [(0, 0)]
    for i, (length, count) in enumerate(zip(lengths.tolist(), counts.tolist(), strict=True)):
        left, bundle = min(count, budget // length), 1
        while left > 0 and by[budget] < 0:
            bundle = min(bundle, left)
            words = bundle * length
            by[np.flatnonzero((by[: budget + 1 - words] >= 0) & (by[words:] < 0)) + words] = len(bundles)
            bundles.append((i, bundle))
            left -= bundle
            bundle *= 2
    take = np.zeros(len(lengths), np.int64)
    at = int(np.flatnonzero(by >= 0)[-1])
    while at:
        i, bundle = bundles[by[at]]
        take[i] += bundle
        at -= bundle * int(lengths[i])
    return take


def fit(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length (> 0) make up ``budget`` words, at most all of them.

    Budgets of up to ``RESERVES[0]`` longest documents are solved exactly. Of larger ones so many words are held back
    for the table, and again more of them where the first reserve misses the budget.
    """
    total = int((lengths * counts).sum())
    if budget <= 0 or total == 0:
        return np.zeros(len(lengths), np.int64)
    if budget >= total:
        return counts.copy()
    best, missed = np.zeros(len(lengths), np.int64), budget
    for longest in RESERVES:
        reserve = min(longest * int(lengths.max()), budget)
        take = np.array([c * (budget - reserve) // total for c in counts.tolist()], np.int64)
        left = budget - int((lengths * take).sum())
        # What rounding down took from the shares, at most one document of each length.
        for i in np.argsort(-lengths).tolist():
            if left - int(lengths[i]) >= reserve and take[i] < counts[i]:
                take[i] += 1
                left -= int(lengths[i])
        some = np.flatnonzero((lengths <= left) & (counts > take))
        if len(some):
            take[some] += knapsack(lengths[some], (counts - take)[some], left)
        short = budget - int((lengths * take).sum())
        if short < missed:
            best, missed = take, short
        if missed == 0 or reserve == budget:
            break
    return best


def _plan(budgets: dict[str | None, tuple[int, int]]):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        source = group["source"].iloc[0]
        whole, budget = budgets[None if pd.isna(source) else source]
        group = group.sort_values("size", kind="stable")
        sizes, counts = group["size"].to_numpy(np.int64), group["n"].to_numpy(np.int64)
        take = np.zeros(len(group), np.int64)
        some = sizes > 0
        take[some] = fit(sizes[some], counts[some], budget)
        return pd.DataFrame({"source": group["source"].to_numpy(), "size": sizes, "_whole": whole, "_take": take})

    return run


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        seed: int = SEED, max_times: int = MAX_TIMES) -> DataFrame:
    """``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``taken`` and ``times`` of every row."""
    order = F.xxhash64(F.col(id_col), F.lit(seed))
    sized = checkpointed(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).alias("source"),
            word_total(F.col(text_col)).alias("size"),
            order.alias("_u"),
            F.shiftrightunsigned(order, 52).cast("int").alias("_slice"),
        )
    )
    slices = sized.groupBy("source", "size", "_slice").agg(F.count(F.lit(1)).alias("_n"))
    slices = checkpointed(slices)  # a row for each source, length and slice
    lengths = slices.groupBy("source", "size").agg(F.sum("_n").alias("n"))
    per_source = lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("words"))
    sizes = {r["source"]: int(r["words"]) for r in per_source.collect()}  # a row for each source
    wanted = targets(sizes, max_times)
    budgets = {}
    for source, target in wanted.items():
        whole = min(int(target // sizes[source]), max_times) if sizes[source] else 0
        budgets[source] = (whole, round(target) - whole * sizes[source] if whole < max_times else 0)
    plan = lengths.groupBy("source").applyInPandas(
        _plan(budgets), "source string, size bigint, _whole bigint, _take bigint"
    )
    rows = [(s, sizes[s], wanted[s]) for s in sizes]
    spark = docs.sparkSession
    facts = spark.createDataFrame(rows, "source string, source_size bigint, target double")

    same = lambda a, b, *more: a["source"].eqNullSafe(b["source"]) & (a["size"] == b["size"]) & _all(a, b, more)
    before = F.sum("_n").over(
        Window.partitionBy("source", "size").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    )
    ranked = slices.withColumn("_before", F.coalesce(before, F.lit(0)))
    decided = ranked.join(plan, same(ranked, plan)).select(
        ranked["source"], ranked["size"], ranked["_slice"], "_whole", (F.col("_take") - F.col("_before")).alias("_open")
    )
    decided = decided.join(facts, decided["source"].eqNullSafe(facts["source"])).select(
        decided["source"], "size", "_slice", "_whole", "_open", "source_size", "target"
    )
    place = F.row_number().over(Window.partitionBy("source", "size", "_slice").orderBy("_u", "doc_id"))
    numbered = sized.withColumn("_place", place)
    joined = numbered.join(decided, same(numbered, decided, "_slice"))
    times = F.col("_whole") + F.when(F.col("_place") <= F.col("_open"), 1).otherwise(0)
    return joined.select(
        "doc_id", numbered["source"], numbered["size"], "source_size", "target",
        (times * numbered["size"]).alias("taken"), times.cast("int").alias("times"),
    )


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """Every row as often as the mix takes it, all columns.

    Rows are met by id, source and size; rows equal in all three share what the mix takes of them evenly, an odd
    rest going to those whose columns have the smallest hashes, however the rows are dealt out.
    """
    times = mix(docs, id_col, text_col, source_col, **options)
    times = times.groupBy("doc_id", "source", "size").agg(F.sum("times").alias("__llm_times"), F.count(F.lit(1)).alias("__llm_rows"))
    times = times.withColumnsRenamed({"doc_id": "__llm_own", "source": "__llm_from", "size": "__llm_words"})
    sized = docs.withColumn("__llm_size", word_total(F.col(text_col)))
    same = sized[id_col].eqNullSafe(times["__llm_own"]) & sized[source_col].eqNullSafe(times["__llm_from"]) & (sized["__llm_size"] == times["__llm_words"])
    joined = sized.join(times, same)
    place = F.row_number().over(Window.partitionBy(id_col, source_col, "__llm_size").orderBy(row_hash(docs)))
    share = F.floor(F.col("__llm_times") / F.col("__llm_rows")) + F.when(place <= F.col("__llm_times") % F.col("__llm_rows"), 1).otherwise(0)
    counted = joined.withColumn("__llm_share", share.cast("int")).where("__llm_share > 0")
    repeated = counted.withColumn("__llm_copy", F.explode(F.sequence(F.lit(1), F.col("__llm_share"))))
    return repeated.select(*[F.col(c) for c in docs.columns])


def _all(a: DataFrame, b: DataFrame, names: tuple[str, ...]) -> Column:
    out = F.lit(True)
    for name in names:
        out = out & (a[name] == b[name])
    return out
