"""Session helpers.

Library code never builds its own session: every operator takes DataFrames
and returns DataFrames.  ``local_session`` is for tests and the bench only.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "hearth") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.parquet.aggregatePushdown", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("HEARTH_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    On a cluster the setting points at shared storage and is used as is.  Only
    when it is unset (local tests) a scratch folder is made for this process.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured and not sc.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not configured:
        configured = tempfile.mkdtemp(prefix="hearth-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder, for written intermediates."""
    return ensure_checkpoint_dir(spark).rstrip("/") + "/" + name


#: Files that a task keeps open while it writes into partition folders; with more folders than that it sorts the rest of its rows.
#: A Parquet file holds its rows in memory until there are 128 MB of them, so few are open then; text is passed on.
OPEN_FILES, OPEN_TEXT_FILES = 4, 16


@contextmanager
def frugal_writes(spark: SparkSession, open_files: int = OPEN_FILES) -> Iterator[None]:
    """Writes inside leave little on the executors' disks: the shuffles of each are removed when it is through (else they stay until the
    driver collects its garbage), and tasks keep a file open for each partition folder instead of sorting whole rows, which spills.
    Only for writes and other plans that run once: a plan that is run again works its shuffles out again."""
    wanted = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.maxConcurrentOutputFileWriters": str(open_files)}
    before = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
