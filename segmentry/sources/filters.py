"""Membership filters of keyed tables, kept beside the data.

The filter of a table is a short list of slabs. A slab has 64-bit words in which each key sets a few bits (a Bloom
filter whose key looks at one word only), and room for a number of keys. Loads add the words of their keys to the last
slab; when it is full, the next one has at least twice its room, so even many small loads make few slabs. A key whose
bits are not all set in some slab is surely not stored; one whose bits are may be. Words are written before the rows
they stand for, so a load that fails leaves keys too many, never too few.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from segmentry.sources import tables

# Folders of such a name inside a table are not read as its data.
FOLDER = "_filter"
BITS_PER_KEY = 32
BITS_SET = 8
FIRST_ROOM = 1 << 20
WORDS = "word bigint, bits bigint, slab int, n_words bigint, load string"


def _mask(hashed: Column) -> Column:
    """A word with up to BITS_SET bits, each taken from six bits of the hash."""
    mask = F.lit(0).cast("bigint")
    for i in range(BITS_SET):
        place = F.shiftrightunsigned(hashed, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), place))
    return mask


def _hashes(key: str) -> tuple[Column, Column]:
    """Two hashes of a key's text: one for its word, one for its bits."""
    text = F.col(key).cast("string")
    return F.xxhash64(text), F.xxhash64(text, F.lit("bits"))


def exists(spark: SparkSession, path: str) -> bool:
    return tables.exists(spark, f"{path}/{FOLDER}")


def _slabs(spark: SparkSession, path: str) -> dict[int, tuple[int, int]]:
    """Words and keys of every slab, from the names of its folders alone."""
    fs, folder = tables._hadoop_path(spark, f"{path}/{FOLDER}")
    if not fs.exists(folder):
        return {}
    inside = lambda p: [s.getPath() for s in fs.listStatus(p) if "=" in s.getPath().getName()]
    number = lambda p, sep: int(p.getName().rsplit(sep, 1)[1])
    out = {}
    for slab in inside(folder):
        for size in inside(slab):
            out[number(slab, "=")] = (number(size, "="), sum(number(load, "-") for load in inside(size)))
    return out


def _room(n_words: int) -> int:
    return n_words * 64 // BITS_PER_KEY


def add(df: DataFrame, path: str, key: str, first_room: int = FIRST_ROOM) -> None:
    """Adds the keys of ``df`` to the filter of the table at ``path``; nulls are left out."""
    spark = df.sparkSession
    keys = df.where(F.col(key).isNotNull()).select(key)
    n = keys.count()
    slabs = _slabs(spark, path)
    last = max(slabs, default=-1)
    n_words, used = slabs.get(last, (0, 0))
    if used + n > _room(n_words):
        room = max(first_room, 2 * _room(n_words))
        while room < n:
            room *= 2
        last, n_words = last + 1, room * BITS_PER_KEY // 64
    where, what = _hashes(key)
    words = keys.groupBy(F.pmod(where, F.lit(n_words)).alias("word")).agg(F.bit_or(_mask(what)).alias("bits"))
    names = {"slab": last, "n_words": n_words, "load": f"{uuid.uuid4().hex}-{n}"}
    folder = "/".join(f"{k}={v}" for k, v in names.items())
    words.write.mode("overwrite").parquet(f"{path}/{FOLDER}/{folder}")


def maybe_stored(df: DataFrame, path: str, key: str) -> DataFrame:
    """The distinct keys of ``df`` that may be stored; all others surely are not. Reads the filter only."""
    spark = df.sparkSession
    where, what = _hashes(key)
    sizes = [F.struct(F.lit(slab).alias("slab"), F.lit(n_words).cast("bigint").alias("n_words")) for slab, (n_words, _) in _slabs(spark, path).items()]
    asked = df.where(F.col(key).isNotNull()).select(key).distinct().select(key, where.alias("_where"), _mask(what).alias("_mask"), F.explode(F.array(*sizes)).alias("s"))
    asked = asked.select(key, "_mask", F.col("s.slab").alias("slab"), F.pmod(F.col("_where"), F.col("s.n_words")).alias("word"))
    words = spark.read.schema(WORDS).parquet(f"{path}/{FOLDER}").select("slab", "word", "bits")
    # A word may have been written by several loads; only the bits that some key asks for count.
    met = asked.join(words, ["slab", "word"]).groupBy(key, "slab", "_mask").agg(F.bit_or("bits").alias("bits"))
    return met.where(F.col("bits").bitwiseAND(F.col("_mask")) == F.col("_mask")).select(key).distinct()


def not_stored(df: DataFrame, path: str, key: str, stored: DataFrame, stored_key: str | None = None) -> DataFrame:
    """Rows of ``df`` whose key ``stored`` does not hold. The stored keys are read only if the filter knows some key.

    Rows with a null key stay, as a null matches nothing.
    """
    possible = maybe_stored(df, path, key).persist()
    try:
        if possible.isEmpty():
            return df
        hits = stored.select(F.col(stored_key or key).cast(df.schema[key].dataType).alias(key)).join(possible, key, "left_semi").distinct()
        return df.join(hits, key, "left_anti")
    finally:
        possible.unpersist()
