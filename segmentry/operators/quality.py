"""Expectations on tables: counts, null rates, ranges, orphans. Each is one pass and one small row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmentry import fixed_values as fv
from segmentry.functions.numeric import round_even
from segmentry.functions.ordering import exact_quantiles


def check_row_count(df: DataFrame, minimum: int = fv.MIN_MONTH_ROWS) -> DataFrame:
    """Rows against a minimum, before or after a load."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).withColumn(
        "passed", (F.col("row_count") >= minimum).cast("int")
    )


def check_loaded_count(loaded: DataFrame, expected: int, tolerance: float = 0.05) -> DataFrame:
    """Loaded rows within a share of the expected number."""
    return loaded.agg(F.count(F.lit(1)).alias("row_count")).withColumns(
        {
            "expected": F.lit(expected).cast("long"),
            "passed": (F.abs(F.col("row_count") - expected) <= F.lit(tolerance * expected)).cast("int"),
        }
    )


def expectations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows breaking each rule (a rule that is unknown for a row is broken), long form, one scan."""
    broken = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(~F.coalesce(rule, F.lit(False))).alias(name) for name, rule in rules.items()],
    )
    return _unpivot_counts(broken, list(rules), "rule", "failed")


def trip_rules(now: Column | None = None) -> dict[str, Column]:
    low, high = fv.PASSENGER_RANGE
    now = now if now is not None else F.current_timestamp().cast("timestamp_ntz")
    return {
        "pickup_is_timestamp": F.col("tpep_pickup_datetime").isNotNull(),
        "dropoff_is_timestamp": F.col("tpep_dropoff_datetime").isNotNull(),
        "fare_positive": F.col("fare_amount") > 0,
        "passengers_in_range": F.col("passenger_count").between(low, high),
        "pickup_not_in_future": F.col("tpep_pickup_datetime") <= now,
    }


def null_rates(df: DataFrame, columns: list[str], limit: float = 0.01) -> DataFrame:
    """Null share of each critical column against a limit, one scan of these columns."""
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    )
    rates = _unpivot_counts(counted, columns, "column_name", "nulls")
    share = F.try_divide(F.col("nulls"), F.col("rows"))
    return rates.withColumns(
        {"null_rate": round_even(share, 6), "passed": F.coalesce((share < limit), F.lit(True)).cast("int")}
    )


def _unpivot_counts(one_row: DataFrame, columns: list[str], key: str, value: str) -> DataFrame:
    return one_row.unpivot(["_rows"], columns, key, value).withColumnRenamed("_rows", "rows")


def historical_bounds(history: DataFrame, value: str, low: float = 0.01, high: float = 0.99) -> DataFrame:
    """The range a column had in earlier loads, as exact quantiles."""
    return exact_quantiles(history, value, {"low": low, "high": high})


def share_within(df: DataFrame, value: str, low: float, high: float) -> DataFrame:
    """How much of a load lies inside historical bounds."""
    return df.where(F.col(value).isNotNull()).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(value).between(low, high)).alias("inside"),
    )


def check_dimension(vectors: DataFrame, dim: int, column: str = "embedding") -> DataFrame:
    """Vectors that are missing or not of the expected length."""
    wrong = F.coalesce(F.size(column) != dim, F.lit(True))
    return vectors.agg(F.count(F.lit(1)).alias("rows"), F.count_if(wrong).alias("wrong_dimension"))


def orphans(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Child rows without a parent."""
    return children.join(parents.select(key), key, "left_anti")


def cascade(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Child rows that keep a parent, the result of deleting with cascade."""
    return children.join(parents.select(key), key, "left_semi")
