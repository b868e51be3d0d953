"""Tables as Parquet folders, and the re-runnable ways to change them.

Parquet has no MERGE. Changes therefore go one of three ways:

* append: new files only;
* by partition: dynamic overwrite replaces exactly the partitions that hold touched keys or months.
  Spark stages the new files and moves them at job commit, so lost executors never leave a table
  half written, and the old rows can be read while their replacement is computed. The partitions are moved
  one after another: a driver lost during that commit leaves some old and some new, and the load is to be
  run again;
* by version: a change that may touch any row writes the list of files that are version n+1, and new files only
  for those that held a touched row; readers take the highest version whose list was committed.

One writer per table at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.types import StructType

from segmentry.sources.trips import in_month, month_of, spread_by_partition

BUCKET = "key_bucket"
# An empty file of this name with the number of buckets behind it belongs to every keyed table.
BUCKET_MARK = "_buckets-"
# Enough for small tables; a table of terabytes wants one bucket per few GB, given when it is created.
DEFAULT_BUCKETS = 16


class SchemaMismatch(ValueError):
    pass


# Namespaces, ad-hoc SQL, existence ---------------------------------------------------------


def create_namespace(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def query(spark: SparkSession, sql: str, **params: object) -> DataFrame:
    """Ad-hoc SQL on registered views; ``:name`` markers take ``params``."""
    return spark.sql(sql, args=params or None)


def _hadoop_path(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a table has committed files; what an aborted first write left behind does not count."""
    fs, p = _hadoop_path(spark, path)
    return fs.exists(p) and any(s.getPath().getName()[0] not in "._" for s in fs.listStatus(p))


def _columns(df: DataFrame, ignore: tuple[str, ...] = ()) -> dict[str, str]:
    return {name: kind for name, kind in df.dtypes if name not in ignore}


def _require_same_columns(old: DataFrame, new: DataFrame, ignore: tuple[str, ...] = ()) -> None:
    if _columns(old, ignore) != _columns(new, ignore):
        raise SchemaMismatch(f"table has {_columns(old, ignore)}, load has {_columns(new, ignore)}")


# Append ------------------------------------------------------------------------------------


def append(df: DataFrame, path: str) -> None:
    """Creates the table if missing, then adds all rows. Columns are matched by name."""
    spark = df.sparkSession
    if exists(spark, path):
        old = spark.read.parquet(path)
        _require_same_columns(old, df)
        df = df.select(*old.columns)
    df.write.mode("append").parquet(path)


def append_parquet(spark: SparkSession, source: str, path: str) -> int:
    """Bulk append of Parquet files. Not idempotent. Returns the rows added (a footer count)."""
    df = spark.read.parquet(source)
    append(df, path)
    return df.count()


# By key ------------------------------------------------------------------------------------


def _bucket(key: str, buckets: int) -> Column:
    # The key's text is hashed, so the bucket does not depend on the integer width of a load.
    return F.coalesce(F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)), F.lit(0)).cast("int")


def _bucket_count(spark: SparkSession, path: str, buckets: int | None) -> int:
    """The number of buckets of a keyed table, written down when the table is created; another one is refused."""
    fs, p = _hadoop_path(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    known = [int(n.removeprefix(BUCKET_MARK)) for n in names if n.startswith(BUCKET_MARK)]
    if known:
        if buckets not in (None, known[0]):
            raise ValueError(f"{path} has {known[0]} buckets, not {buckets}")
        return known[0]
    buckets = buckets or DEFAULT_BUCKETS
    fs.mkdirs(p)
    fs.createNewFile(spark._jvm.org.apache.hadoop.fs.Path(p, f"{BUCKET_MARK}{buckets}"))
    return buckets


def _touched_buckets(keyed: DataFrame) -> list[int]:
    return sorted(r[0] for r in keyed.select(BUCKET).distinct().collect())  # at most ``buckets`` values


def read_keyed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(BUCKET)


def append_keyed(df: DataFrame, path: str, key: str, buckets: int | None = None) -> None:
    """Adds rows to a keyed table without looking at the stored ones."""
    buckets = _bucket_count(df.sparkSession, path, buckets)
    new = df.withColumn(BUCKET, _bucket(key, buckets))
    spread_by_partition(new, [BUCKET]).write.mode("append").partitionBy(BUCKET).parquet(path)


def read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A table that may not have been written yet."""
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def replace_by_key(df: DataFrame, path: str, key: str, buckets: int | None = None) -> None:
    """Deletes stored rows whose key occurs in ``df`` and stores every row of ``df``.

    Running it again gives the same table. A null key matches nothing; repeats of a key inside the
    load are all kept. Only the buckets of the loaded keys are read and rewritten.
    """
    spark = df.sparkSession
    buckets = _bucket_count(spark, path, buckets)
    new = df.withColumn(BUCKET, _bucket(key, buckets))
    if exists(spark, path):
        stored = spark.read.parquet(path)
        _require_same_columns(stored, df, ignore=(BUCKET,))
        touched = stored.where(F.col(BUCKET).isin(_touched_buckets(new)))
        kept = touched.join(new.select(BUCKET, key).distinct(), [BUCKET, key], "left_anti")
        new = kept.unionByName(new)
    spread_by_partition(new, [BUCKET]).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(BUCKET).parquet(path)


def first_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of every key in the given order.

    Spark cuts each key to one row per task before the shuffle (WindowGroupLimit), so a key that
    holds a large share of the rows does not fill one task.
    """
    w = W.partitionBy(key).orderBy(order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def insert_if_absent(df: DataFrame, path: str, key: str, order: str, buckets: int | None = None) -> None:
    """Appends rows whose key is not stored yet; inside the load the first row of a key wins.

    The key may not be null; a null one fails the load.
    """
    spark = df.sparkSession
    buckets = _bucket_count(spark, path, buckets)
    required = F.when(F.col(key).isNull(), F.raise_error(F.lit(f"null {key}"))).otherwise(F.col(key))
    df = df.withColumn(key, required)
    new = first_per_key(df, key, order).withColumn(BUCKET, _bucket(key, buckets))
    if exists(spark, path):
        stored = spark.read.parquet(path)
        _require_same_columns(stored, df, ignore=(BUCKET,))
        touched = stored.where(F.col(BUCKET).isin(_touched_buckets(df.select(_bucket(key, buckets).alias(BUCKET)))))
        new = new.join(touched.select(BUCKET, key), [BUCKET, key], "left_anti")
    spread_by_partition(new, [BUCKET]).write.mode("append").partitionBy(BUCKET).parquet(path)


# By month ----------------------------------------------------------------------------------


def replace_month(df: DataFrame, path: str, month: str, column: str = "tpep_pickup_datetime") -> None:
    """Replaces one month of the table with the rows of ``df`` in that month; strays are dropped."""
    rows = df.where(in_month(column, month)).withColumn("load_month", F.lit(month))
    if rows.isEmpty():
        # A dynamic overwrite leaves partitions alone that receive no row; here the month becomes empty.
        rows.drop("load_month").write.mode("overwrite").parquet(f"{path.rstrip('/')}/load_month={month}")
        return
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "load_month"
    ).parquet(path)


def write_months(df: DataFrame, path: str, column: str = "tpep_pickup_datetime") -> None:
    """Writes all months of ``df``, replacing exactly those it contains."""
    keyed = df.withColumn("load_month", month_of(column))
    spread_by_partition(keyed, ["load_month"]).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("load_month").parquet(path)


# By version --------------------------------------------------------------------------------
#
# ``data-<n>/`` holds the files that version n added; ``v=<n>/`` is a small table of the names of all its files.


def _versions(spark: SparkSession, path: str) -> list[int]:
    fs, p = _hadoop_path(spark, path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    numbers = [int(n[2:]) for n in names if n.startswith("v=")]
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path
    return sorted(n for n in numbers if fs.exists(jvm_path(f"{path}/v={n}/_SUCCESS")))


def version_files(spark: SparkSession, path: str, version: int | None = None) -> list[str]:
    """The files of a version (the highest committed one), relative to the table. As many names as a scan would list."""
    versions = _versions(spark, path)
    if not versions:
        raise FileNotFoundError(f"no committed version under {path}")
    rows = spark.read.schema("file string").parquet(f"{path}/v={version or versions[-1]}").collect()
    return sorted(r[0] for r in rows)


def _read_files(spark: SparkSession, path: str, files: list[str]) -> DataFrame:
    return spark.read.parquet(*[f"{path}/{f}" for f in files])


def read_versioned(spark: SparkSession, path: str) -> DataFrame:
    """The highest committed version."""
    return _read_files(spark, path, version_files(spark, path))


def _commit_version(df: DataFrame, path: str, unchanged: list[str]) -> int:
    """Writes ``df`` as new files, and these and the unchanged ones as the next version."""
    spark = df.sparkSession
    version = max(_versions(spark, path), default=0) + 1
    # An unfinished earlier attempt at this version is overwritten.
    df.write.mode("overwrite").parquet(f"{path}/data-{version}")
    fs, folder = _hadoop_path(spark, f"{path}/data-{version}")
    added = [f"data-{version}/{s.getPath().getName()}" for s in fs.listStatus(folder) if s.getPath().getName()[0] not in "._"]
    names = spark.createDataFrame([(f,) for f in [*unchanged, *added]], "file string")
    names.coalesce(1).write.mode("overwrite").parquet(f"{path}/v={version}")
    return version


def write_version(df: DataFrame, path: str) -> int:
    """Writes the whole table as the next version."""
    return _commit_version(df, path, [])


def replace_where(df: DataFrame, path: str, condition: str | None) -> int:
    """Deletes stored rows for which the condition is true, adds all rows of ``df``; returns the version.

    Only files that hold such a row are rewritten. They are found by a scan of the condition's columns, which
    skips what the files' statistics rule out.
    """
    spark = df.sparkSession
    if not _versions(spark, path):
        return write_version(df, path)
    files = version_files(spark, path)
    old = _read_files(spark, path, files)
    _require_same_columns(old, df)
    if not condition:
        return _commit_version(df.select(*old.columns), path, files)
    hit = old.where(F.expr(condition)).select(F.regexp_extract("_metadata.file_path", "(data-[0-9]+/[^/]+)$", 1).alias("f")).distinct()
    touched = {r[0] for r in hit.collect()}  # file names
    if touched:
        kept = _read_files(spark, path, sorted(touched)).where(~F.coalesce(F.expr(condition), F.lit(False)))
        df = kept.unionByName(df)
    return _commit_version(df, path, [f for f in files if f not in touched])


def copy_into(
    spark: SparkSession,
    source: str,
    path: str,
    schema,
    file_format: str = "parquet",
    condition: str | None = None,
) -> int:
    """Loads Parquet, CSV or JSON files into a versioned table after deleting by condition."""
    reader = spark.read.schema(schema)
    if file_format.lower() == "csv":
        reader = reader.option("header", True)
    return replace_where(reader.format(file_format.lower()).load(source), path, condition)


# JSON --------------------------------------------------------------------------------------


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)
