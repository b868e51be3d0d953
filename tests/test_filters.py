"""Membership filters: no stored key is ever missed, few others are let through, new keys read no stored column."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from segmentry.operators import vectors as vec
from segmentry.sources import filters, tables


def keys(spark, lo, hi):
    return spark.range(lo, hi).select(F.concat(F.lit("k"), "id").alias("key"))


@pytest.mark.parametrize("room", [64, 1 << 20])
def test_every_stored_key_is_known(spark, path, room):
    for lo, hi in ((0, 50), (50, 60), (60, 2000), (2000, 2001), (2001, 2001)):
        filters.add(keys(spark, lo, hi).unionByName(spark.createDataFrame([(None,)], "key string")), path, "key", room)
    maybe = {r["key"] for r in filters.maybe_stored(keys(spark, 0, 12_000), path, "key").collect()}
    assert {f"k{i}" for i in range(2001)} <= maybe
    assert len(maybe) - 2001 < 10_000 * 0.01
    slabs = filters._slabs(spark, path)
    assert sum(used for _, used in slabs.values()) == 2001
    assert len(slabs) <= 7  # rooms double


def test_rows_whose_key_is_not_stored(spark, path):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (1, "again")], "id bigint, text string")
    stored = spark.createDataFrame([(1,), (9,)], "id bigint")
    filters.add(stored, path, "id")
    assert sorted(r["text"] or "" for r in filters.not_stored(df, path, "id", stored).collect()) == ["", "b"]


def test_new_records_read_no_stored_column(spark, path, monkeypatch):
    """The second batch is all new: the stored vectors are not touched; the third repeats it and adds nothing."""
    batch = lambda lo, hi: spark.createDataFrame([(f"r{i}", f"text number {i}") for i in range(lo, hi)], "id string, text string")
    vec.embed_new(spark, batch(0, 40), path)
    real = tables.read_keyed

    def unreadable(session, table):
        df = real(session, table)
        return df.withColumns({c: F.raise_error(F.lit("stored column read")).cast(df.schema[c].dataType) for c in df.columns})

    monkeypatch.setattr(tables, "read_keyed", unreadable)
    vec.embed_new(spark, batch(40, 90), path)
    monkeypatch.setattr(tables, "read_keyed", real)
    vec.embed_new(spark, batch(30, 95), path)
    vec.embed_new(spark, batch(0, 95), path, model=("hash", "other"))
    rows = tables.read_keyed(spark, path)
    assert rows.count() == 190 and rows.select("record_id", "model_version").distinct().count() == 190


def test_table_without_a_filter_is_read(spark, path):
    first = spark.createDataFrame([("a", "one text"), ("b", "two texts")], "id string, text string")
    tables.append_keyed(vec.embed_reviews(first), path, "record_id")
    vec.embed_new(spark, first.unionByName(spark.createDataFrame([("c", "three")], "id string, text string")), path)
    assert tables.read_keyed(spark, path).count() == 3
