"""A stored index from key hashes to data files, for merges into tables that do not fit a join.

Beside a Parquet table, ``<root>/_key_index`` holds one row ``(bucket, h, file)`` for each key and data file:
``h`` is a 64-bit hash of the key columns, ``bucket`` (a partition folder) its remainder, and ``file`` the data file's path
under the root.  ``<root>/_indexed_files`` names the files that the index covers.  Both start with an underscore, so
readers of the table do not see them.

A merge looks up the hashes of its batch in the buckets that the batch touches, and reads only the data files that
hold one of them, so a batch of new keys reads no old data file.  Hashes only choose files; keys are
compared on the rows.

The index never decides what is in the table.  Data files that it does not cover (written by others, or
before a crash) are read in full and covered by the next merge; entries of files that are gone are passed
over.  Results are the same with the index absent, behind or complete.

A bitmap per partition was not built: keys here are hashes, spread evenly, so a batch of m keys misses a bitmap
of b places that holds n keys with probability about ``exp(-m n / b)``, which is nothing for
m = n = 10**6 unless b is 10**12.  Eight bytes a key rule files out at any size.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.session import frugal_writes, scratch_path
from hearth.sources.fresh import fresh_rows, key_hash
from hearth.sources.sinks import TABLE_CODEC, data_files, file_under, remove_folder, table_exists

#: Folders of the index.  At 100 TB some thousand keep a bucket of 10**12 keys at the size of one task.
BUCKETS = 64
INDEX, COVERED = "_key_index", "_indexed_files"


class RepeatedKeyError(ValueError):
    pass


def _bucket(buckets: int) -> Column:
    return F.pmod(F.col("h"), F.lit(buckets)).cast("int")


def covered_files(spark: SparkSession, root: str) -> set[str]:
    """Data files that the index covers: one short row each."""
    path = f"{root.rstrip('/')}/{COVERED}"
    return {r["file"] for r in spark.read.parquet(path).collect()} if table_exists(spark, path) else set()


def cover(spark: SparkSession, root: str, keys: Sequence[str], buckets: int = BUCKETS) -> list[str]:
    """Index the data files that are not covered yet, and return them."""
    root = root.rstrip("/")
    new = sorted(set(data_files(spark, root)) - covered_files(spark, root))
    if new:
        rows = read_files(spark, root, new).select(key_hash(keys).alias("h"), file_under(spark, root).alias("file"))
        with frugal_writes(spark):  # equal entries are in the same bucket: one shuffle serves both
            rows.withColumn("bucket", _bucket(buckets)).repartition("bucket").distinct().write.mode("append").partitionBy("bucket").parquet(f"{root}/{INDEX}")
        # files count as covered once their entries are there
        spark.createDataFrame([(f,) for f in new], "file string").coalesce(1).write.mode("append").parquet(f"{root}/{COVERED}")
    return new


def read_files(spark: SparkSession, root: str, files: Sequence[str]) -> DataFrame:
    """Some data files of the table, with its partition columns."""
    return spark.read.option("basePath", root).schema(spark.read.parquet(root).schema).parquet(*[f"{root}/{unquote(f)}" for f in files])


@contextmanager
def stored_hashes(batch: DataFrame, keys: Sequence[str]) -> Iterator[DataFrame]:
    """The distinct key hashes ``h`` of a batch, written once, eight bytes a key: the filters that a join infers would
    work out the batch's key columns again."""
    path = scratch_path(batch.sparkSession, f"hashes-{uuid.uuid4().hex}")
    try:
        with frugal_writes(batch.sparkSession):
            batch.select(key_hash(keys).alias("h")).distinct().write.parquet(path)
        yield batch.sparkSession.read.parquet(path)
    finally:
        remove_folder(batch.sparkSession, path)


def files_with_hashes(spark: SparkSession, hashes: DataFrame, root: str, buckets: int = BUCKETS) -> list[str]:
    """Data files that may hold a key with one of the hashes: those with one of them, and those that are not covered."""
    root = root.rstrip("/")
    there = set(data_files(spark, root))
    covered = covered_files(spark, root) & there
    found: set[str] = set()
    if covered:
        hashes = hashes.withColumn("bucket", _bucket(buckets))
        with frugal_writes(spark):
            touched = [r["bucket"] for r in hashes.select("bucket").distinct().collect()]  # at most ``buckets`` numbers
            if touched:
                index = spark.read.parquet(f"{root}/{INDEX}").where(F.col("bucket").isin(touched))
                found = {r["file"] for r in index.join(hashes, ["bucket", "h"], "left_semi").select("file").distinct().collect()}
    return sorted((found & there) | (there - covered))


def files_with_keys(batch: DataFrame, root: str, keys: Sequence[str], buckets: int = BUCKETS) -> list[str]:
    """Data files that may hold a key of ``batch``."""
    with stored_hashes(batch, keys) as hashes:
        return files_with_hashes(batch.sparkSession, hashes, root, buckets)


def append_indexed(
    batch: DataFrame, root: str, keys: Sequence[str], partition_by: Sequence[str] = ("dataset_name",), buckets: int = BUCKETS
) -> list[str]:
    """Insert-only load like ``sinks.append_new``, by the index: append the rows of ``batch`` whose key the table does not hold.
    The batch is worked out twice, or three times where some of its keys are there already and others are not.
    Returns the old data files that were read."""
    spark = batch.sparkSession
    root = root.rstrip("/")

    def append(rows: DataFrame) -> None:
        with frugal_writes(spark):
            rows.write.mode("append").option("compression", TABLE_CODEC).partitionBy(*partition_by).parquet(root)

    read: list[str] = []
    if table_exists(spark, root):
        with stored_hashes(batch, keys) as hashes:
            read = files_with_hashes(spark, hashes, root, buckets)
            held = read_files(spark, root, read).select(*keys) if read else None
            with fresh_rows(batch, held, keys, hashes=hashes) as fresh:
                append(fresh)
    else:
        append(batch)
    cover(spark, root, keys, buckets)
    return read


def upsert_indexed(batch: DataFrame, root: str, key: str | Sequence[str], partition_col: str, buckets: int = BUCKETS) -> list[object]:
    """Replace the table's rows whose key is in ``batch`` and insert the rest; a key may move to another partition.

    The index names the files that hold a key of the batch; their partitions and those that the batch falls in are
    rebuilt from all of their rows less the replaced keys, and nothing else is read or written.  A partition that
    all rows left is removed.  A batch that repeats a key raises before anything is written.  Returns the
    partitions that were rebuilt."""
    from hearth.session import ensure_checkpoint_dir

    keys = [key] if isinstance(key, str) else list(key)
    spark = batch.sparkSession
    root = root.rstrip("/")
    ensure_checkpoint_dir(spark)
    batch = batch.checkpoint(eager=True)  # read several times below, computed once
    twice = batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).collect()
    if twice:
        raise RepeatedKeyError(f"batch repeats key {tuple(twice[0])[:-1]}")
    if not table_exists(spark, root):
        batch.write.partitionBy(partition_col).parquet(root)
        cover(spark, root, keys, buckets)
        return []
    files = files_with_keys(batch, root, keys, buckets)
    current = spark.read.parquet(root)
    kind = current.schema[partition_col].dataType
    value = F.col(partition_col).cast(kind).alias("v")
    into = [r["v"] for r in batch.select(value).distinct().collect()]  # one value for each partition
    old: dict[object, str] = {}  # partitions that lose rows, and their folders
    if files:
        held = read_files(spark, root, files).select(*keys, value, F.split_part(file_under(spark, root), F.lit("/"), F.lit(1)).alias("folder"))
        old = {r["v"]: r["folder"] for r in held.join(batch.select(*keys), keys, "left_semi").select("v", "folder").distinct().collect()}
    rebuilt = list(dict.fromkeys([*into, *old]))
    named = [v for v in rebuilt if v is not None]
    inside = F.col(partition_col).isin(named)
    inside = inside | F.col(partition_col).isNull() if len(named) < len(rebuilt) else inside
    kept = current.where(inside).join(batch.select(*keys), keys, "left_anti")
    whole = batch.withColumn(partition_col, F.col(partition_col).cast(kind)).select(*current.columns).unionByName(kept.select(*current.columns))
    whole = whole.checkpoint(eager=True)  # no file is overwritten while it is read
    left = {r["v"] for r in whole.select(value).distinct().collect()}
    whole.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_col).parquet(root)
    for v, folder in old.items():
        if v not in left:
            remove_folder(spark, f"{root}/{unquote(folder)}")
    cover(spark, root, keys, buckets)
    return rebuilt
