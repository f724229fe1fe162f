"""Sinks: landed JSONL, load audit, versioned tables, published extracts."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.session import OPEN_TEXT_FILES, frugal_writes

LAYOUT = ("dataset_name", "ingest_date", "run_id")


#: Codec of appended tables: hashes are hex text, which zstd stores in half its length and Spark's own choice, snappy, does not shorten.
TABLE_CODEC = "zstd"

#: Rows of one compressed landed file, at most: such a file is read by one task.
LANDED_ROWS = 500_000


def write_normalized(
    raw: DataFrame, root: str, mode: str = "append", ingest_date: Column | None = None, compression: str | None = None
) -> None:
    """Land raw records as JSONL under ``dataset_name=/ingest_date=/run_id=``.
    The three columns move into the path; reading the root restores them.
    ``ingest_date``: the day of each row's run as text, where rows of one run carry times of
    many days (else every one of these would be a folder); the day of ``ingested_at`` without it.
    ``compression``: a codec of Spark's JSON writer (``gzip``, say; files then hold ``LANDED_ROWS`` rows at most), plain text
    without it.  Key names and urls repeat in every line, so landed text is some ten times larger than its compressed form."""
    day = ingest_date if ingest_date is not None else F.date_format(F.col("ingested_at"), "yyyy-MM-dd")
    writer = (
        raw.withColumn("ingest_date", day).write.mode(mode)
        .partitionBy(*LAYOUT)
        .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
        .option("ignoreNullFields", "false")
    )
    if compression is not None:
        writer = writer.option("compression", compression).option("maxRecordsPerFile", LANDED_ROWS)
    with frugal_writes(raw.sparkSession, OPEN_TEXT_FILES):
        writer.json(root)


def append_audit(buffer: DataFrame, stage: str, audit_path: str, status: str = "loaded") -> DataFrame:
    """Append one audit row for a load: id, time, stage, rows in the buffer, status.
    The count runs as a distributed aggregate; only the one row is written."""
    row = buffer.agg(F.count(F.lit(1)).alias("rows_loaded")).select(
        F.expr("uuid()").alias("load_id"),
        F.current_timestamp().alias("loaded_at"),
        F.lit(stage).alias("stage_name"),
        F.col("rows_loaded").cast("long"),
        F.lit(status).alias("status"),
    )
    row.coalesce(1).write.mode("append").parquet(audit_path)
    return row


def _children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder of any file system that Spark reads; none if the folder is not there.  Other errors raise."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(folder))


class VersionConflict(RuntimeError):
    """Another writer committed since the version that a commit is based on."""


def _pointers(spark: SparkSession, table_root: str) -> list[str]:
    """Names of the commits, oldest first.  A commit is one file, created at once with all that it says."""
    return [n for n in _children(spark, f"{table_root.rstrip('/')}/_pointers") if n.isdigit()]


def _create(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with ``text`` unless there is one (false).  The file system decides between writers, not a listing:
    a file with the text under a name of its own is renamed to ``path`` (linked on a local disk), which fails where a file stands."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf)
    fs = target.getFileSystem(conf)
    own = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    out = fs.create(own, False)
    out.write(bytearray(text.encode()))
    out.close()
    def rename() -> None:
        context.rename(own, target, spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))

    def link() -> None:
        # Hadoop's local rename looks for the file first and then replaces it, and another writer may come between; a link does not
        name, there = (jvm.java.io.File(p.toUri().getPath()).toPath() for p in (own, target))
        try:
            jvm.java.nio.file.Files.createLink(there, name)
        except Exception as e:  # noqa: BLE001 - the JVM's class is told by its name
            if "FileAlreadyExistsException" in str(e):
                raise
            rename()  # no links on this file system

    try:
        link() if fs.getUri().getScheme() == "file" else rename()
        return True
    except Exception as e:  # noqa: BLE001 - the JVM's class is told by its name
        if "FileAlreadyExistsException" not in str(e):
            raise
        return False
    finally:
        fs.delete(own, False)


def current_version(spark: SparkSession, table_root: str) -> int:
    """Number of the newest commit; 0 for a table that was never written."""
    return max((int(n) for n in _pointers(spark, table_root)), default=0)


def write_version(df: DataFrame, table_root: str, base: int | None = None, attempts: int = 20) -> str:
    """Write ``df`` as a new version folder, then commit it.

    Commits are numbered; each is a file that exactly one writer can create, so a reader sees the old version
    or the new one, and of several writers each takes a number of its own.  ``base``: the commit that ``df`` was made from
    (``current_version``); if another one came since, ``VersionConflict`` is raised and nothing is committed.  Without it the
    commit replaces whatever is there (a full refresh) and goes on to the next free number.  Never
    overwrites a path that may be being read (a merge reads the current
    version while computing the next one)."""
    spark = df.sparkSession
    root = table_root.rstrip("/")
    version = f"{root}/v-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(version)
    for _ in range(attempts):
        now = current_version(spark, root)
        if base is not None and now != base:
            raise VersionConflict(f"{root} is at commit {now}, not at {base}")
        if _create(spark, f"{root}/_pointers/{now + 1:012d}", version):
            return version
    raise VersionConflict(f"{root}: no free commit in {attempts} attempts")


def update_version(spark: SparkSession, table_root: str, change: Callable[[DataFrame | None], DataFrame], attempts: int = 20) -> str:
    """Commit ``change`` of the current version.  If another writer was first, the change is made again from what that one committed."""
    for _ in range(attempts):
        base = current_version(spark, table_root)
        try:
            return write_version(change(read_current(spark, table_root, base)), table_root, base)
        except VersionConflict:
            continue
    raise VersionConflict(f"{table_root}: other writers were first {attempts} times")


def read_current(spark: SparkSession, table_root: str, commit: int | None = None) -> DataFrame | None:
    """The current version of a versioned table (or that of a commit), or None if never written.  A table that cannot be read raises."""
    commit = current_version(spark, table_root) if commit is None else commit
    if not commit:
        return None
    pointer = spark.read.text(f"{table_root.rstrip('/')}/_pointers/{commit:012d}").first()
    return spark.read.parquet(pointer[0])


def truncate_reload(df: DataFrame, table_root: str) -> DataFrame:
    """Replace all rows of a table by those of ``df`` (also by none), and read it back."""
    write_version(df, table_root)
    return read_current(df.sparkSession, table_root)


def materialize(df: DataFrame, layer: str, name: str, root: str | None = None) -> DataFrame:
    """Staging models are views; intermediate and mart models are tables
    (written as a new version and read back)."""
    if layer == "staging" or root is None:
        df.createOrReplaceTempView(name)
        return df
    version = write_version(df, f"{root.rstrip('/')}/{layer}/{name}")
    out = df.sparkSession.read.parquet(version)
    out.createOrReplaceTempView(name)
    return out


# BI column classes of the published extracts and their Spark types.
EXTRACT_TYPES = {"STRING": "string", "DECIMAL": "double", "INTEGER": "bigint", "DATETIME": "date"}

# The five published extracts (source model, then column and class).
EXTRACTS: Mapping[str, tuple[str, Sequence[tuple[str, str]]]] = {
    "neighborhood_scorecard": (
        "mart_neighborhood_scorecard",
        [
            ("neighborhood_scorecard_id", "STRING"), ("postal_code", "STRING"), ("neighborhood", "STRING"),
            ("borough", "STRING"), ("latest_rent_month", "DATETIME"), ("zori_rent", "DECIMAL"),
            ("rent_yoy_pct", "DECIMAL"), ("six_month_rent_volatility", "DECIMAL"), ("rent_volatility_band", "STRING"),
            ("active_inventory", "INTEGER"), ("listing_count", "INTEGER"), ("avg_days_on_market", "DECIMAL"),
            ("affordable_rental_units", "INTEGER"), ("permit_count", "INTEGER"),
            ("development_activity_band", "STRING"), ("recruiter_demo_signal_score", "INTEGER"),
        ],
    ),
    "rent_trends": (
        "fct_rent_trends",
        [
            ("zip_month_signal_id", "STRING"), ("postal_code", "STRING"), ("signal_month", "DATETIME"),
            ("zori_rent", "DECIMAL"), ("active_inventory", "INTEGER"), ("rent_mom_delta", "DECIMAL"),
            ("rent_yoy_pct", "DECIMAL"), ("inventory_mom_delta", "INTEGER"), ("six_month_rent_volatility", "DECIMAL"),
            ("rent_volatility_band", "STRING"),
        ],
    ),
    "affordability": (
        "mart_affordability",
        [
            ("affordability_id", "STRING"), ("postal_code", "STRING"), ("signal_month", "DATETIME"),
            ("zori_rent", "DECIMAL"), ("annual_rent", "DECIMAL"), ("income_needed_at_30_pct", "DECIMAL"),
            ("rent_yoy_pct", "DECIMAL"), ("rent_volatility_band", "STRING"),
        ],
    ),
    "development_activity": (
        "mart_development_activity",
        [
            ("development_activity_id", "STRING"), ("borough", "STRING"), ("postal_code", "STRING"),
            ("neighborhood_code", "STRING"), ("housing_projects", "INTEGER"), ("affordable_rental_units", "INTEGER"),
            ("total_housing_units", "INTEGER"), ("permit_count", "INTEGER"), ("estimated_development_cost", "DECIMAL"),
            ("latest_permit_issued_date", "DATETIME"), ("development_activity_band", "STRING"),
        ],
    ),
    "transit_price_effect": (
        "mart_transit_price_effect",
        [
            ("transit_price_effect_id", "STRING"), ("borough", "STRING"), ("snapshot_date", "DATETIME"),
            ("avg_listing_rent", "DECIMAL"), ("median_listing_rent", "DECIMAL"), ("listing_count", "INTEGER"),
            ("station_complex_count", "INTEGER"), ("ada_station_complex_count", "INTEGER"),
            ("rent_per_station_complex", "DECIMAL"),
        ],
    ),
}


def extract(df: DataFrame, columns: Sequence[tuple[str, str]]) -> DataFrame:
    """Column subset of a mart, each cast to its published type class."""
    return df.select(*[F.col(c).cast(EXTRACT_TYPES[kind]).alias(c) for c, kind in columns])


def publish(df: DataFrame, columns: Sequence[tuple[str, str]], path: str) -> None:
    extract(df, columns).write.mode("overwrite").parquet(path)


# ---------------------------------------------------------------------------
# incremental table maintenance without rewriting the table


def table_exists(spark: SparkSession, root: str) -> bool:
    """Whether anything was written under ``root``.  Only a missing or empty folder is "no table"; a table that
    cannot be read is one, and reading it raises."""
    return any(not n.startswith(("_", ".")) for n in _children(spark, root))


def _root_parts(spark: SparkSession, root: str) -> int:
    """Parts of the root's path, its scheme and host apart."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return len(fs.makeQualified(path).toUri().getPath().rstrip("/").split("/"))


_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"


def data_files(spark: SparkSession, root: str) -> list[str]:
    """The table's data files, as paths under its root in URL form (one name for each file on the driver)."""
    n = _root_parts(spark, root)
    return sorted("/".join(re.sub(_HOST, "", f).split("/")[n:]) for f in spark.read.parquet(root).inputFiles())


def file_under(spark: SparkSession, root: str) -> Column:
    """The data file of each row of a scan of the table, named as in ``data_files``."""
    parts = F.split(F.regexp_replace(F.col("_metadata.file_path"), _HOST, ""), "/")
    return F.array_join(F.slice(parts, _root_parts(spark, root) + 1, F.size(parts)), "/")


def remove_folder(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def append_new(
    batch: DataFrame,
    target_root: str,
    keys: Sequence[str],
    partition_by: Sequence[str] = ("dataset_name",),
    only: Mapping[str, Sequence[object]] | None = None,
    pick: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Insert-only load: append the batch rows whose key is not in the table; with ``pick``
    (which leaves one row a key) repeats in the batch collapse first.

    Only new files are written; the existing table is read (key columns, and with
    ``only`` just the partitions of the values it names) but never rewritten.  Whole rows
    are shuffled only where their key may be there already (``sources.fresh``).  A Spark append
    commits atomically, and a replayed batch finds its rows present and appends
    nothing, so a retried load is exactly-once in effect.
    """
    from hearth.operators.merge import existing_keys
    from hearth.sources.fresh import fresh_rows

    spark = batch.sparkSession
    held = existing_keys(spark.read.parquet(target_root), keys, only) if table_exists(spark, target_root) else None
    with fresh_rows(batch, held, keys, pick) as fresh, frugal_writes(spark):
        fresh.write.mode("append").option("compression", TABLE_CODEC).partitionBy(*partition_by).parquet(target_root)


def _by_partition(df: DataFrame, part: str) -> DataFrame:
    """Rows of a partition brought together before they are written: else every task leaves a small file in every
    partition, and files grow with the tasks.  Adaptive execution splits partitions that are large."""
    return df.hint("rebalance", part)


def upsert_partitions(
    model_output: DataFrame,
    target_root: str,
    key: str,
    watermark_col: str,
    partition_col: str | None = None,
) -> None:
    """Incremental upsert that rewrites only the partitions the new rows fall in.

    The table is partitioned by ``partition_col`` (default: the watermark
    column; a coarser column such as the month also works).  Rows of the
    model at or after the table's high-water mark replace rows with the same
    key.  Every partition that is rewritten is rebuilt from all of its old rows
    (minus replaced keys) plus the new ones, so a coarse partition loses
    nothing; all other partitions are not touched.  The replacement is
    written to the scratch folder before the dynamic partition overwrite, so no file is
    overwritten while it is still being read.

    A batch that repeats a key raises, and so does a key that the table holds in
    another partition than the batch (the old row would stay beside the new one);
    nothing is written then.
    """
    from hearth.operators.merge import DuplicateKeyError, high_water_mark
    from hearth.session import scratch_path

    spark = model_output.sparkSession
    part = partition_col or watermark_col
    if not table_exists(spark, target_root):
        _by_partition(model_output, part).write.mode("overwrite").partitionBy(part).parquet(target_root)
        return
    current = spark.read.parquet(target_root)
    mark = high_water_mark(current, watermark_col)
    scratch = scratch_path(spark, f"upsert-{uuid.uuid4().hex}")
    model_output.where(F.col(watermark_col) >= F.lit(mark)).write.parquet(f"{scratch}/batch")
    batch = spark.read.parquet(f"{scratch}/batch")  # read several times below, computed once
    if part == watermark_col:
        first_part = mark
    else:
        first_part = batch.agg(F.min(part)).first()[0]
        if first_part is None:
            return
    twice = batch.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).collect()
    if twice:
        raise DuplicateKeyError(f"batch repeats key {twice[0][0]}")
    moved = current.select(key, F.col(part).alias("__old")).join(batch.select(key, F.col(part).alias("__new")), key)
    moved = moved.where(~F.col("__old").eqNullSafe(F.col("__new"))).limit(1).collect()
    if moved:
        raise DuplicateKeyError(f"key {moved[0][0]} moves from partition {moved[0][1]} to {moved[0][2]}")
    affected = current.where(F.col(part) >= F.lit(first_part))
    kept = affected.join(batch.select(key), key, "left_anti")
    batch.unionByName(kept.select(*batch.columns)).write.parquet(f"{scratch}/replacement")
    (
        _by_partition(spark.read.parquet(f"{scratch}/replacement"), part).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(part)
        .parquet(target_root)
    )
