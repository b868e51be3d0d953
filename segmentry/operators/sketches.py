"""Quantiles from mergeable sketches: kept per slide, month or file, merged over any of them later.

A sketch (KLL) has a size that depends on ``k`` only, so sketches can be stored beside the data and asked about any
union of their groups without reading the data again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SKETCH_K = 400


def rank_error(k: int = SKETCH_K) -> float:
    """Bound of the error of a rank, as a share of the rows, that holds for 99 in 100 quantiles (published for KLL)."""
    return 2.296 / k**0.9021


def quantile_sketches(df: DataFrame, by: list[str | Column], value: str, k: int = SKETCH_K) -> DataFrame:
    """One sketch of ``value`` per group; nulls and NaN are left out."""
    x = F.col(value).cast("double")
    return df.where(x.isNotNull() & ~F.isnan(x)).groupBy(*by).agg(F.kll_sketch_agg_double(x, k).alias("sketch"))


def merged(sketches: DataFrame, by: list[str | Column], k: int = SKETCH_K) -> DataFrame:
    """Sketches of larger groups from those of smaller ones."""
    return sketches.groupBy(*by).agg(F.kll_merge_agg_double("sketch", k).alias("sketch"))


def rows_in(sketch: str = "sketch") -> Column:
    return F.kll_sketch_get_n_double(sketch)


def quantile(p: float, sketch: str = "sketch") -> Column:
    """An existing value whose rank is p of the rows, within ``rank_error``."""
    return F.kll_sketch_get_quantile_double(sketch, F.lit(p))


def within_rank(below: Column, upto: Column, total: Column, p: float, error: float) -> Column:
    """Whether a value with ``below`` smaller rows and ``upto`` rows up to it has rank p of ``total`` within the error."""
    # Ranks are whole rows: one row of slack.
    return (below <= (p + error) * total + 1) & (upto >= (p - error) * total - 1)
