"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import contextlib
import ctypes
import os
import tempfile
import threading
import uuid
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SHIPPED: set[str] = set()
_LOCK = threading.Lock()
#: Bytes of an Arrow batch between an executor and its Python workers, and the setting that bounds them.
BATCH, BATCH_BYTES = 4 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, whole."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` long and ``text`` string only (null text: empty); other columns never reach an operator."""
    return docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    )


def ship(spark: SparkSession) -> None:
    """Send the package's sources to the executors once per application, as ``--py-files`` would.

    Functions that run in Python workers are pickled by reference, so the
    workers need the package whatever folder the driver loaded it from.  A session
    that does not bound its Arrow batches by bytes gets ``BATCH``: 10,000 rows of text, the
    default, take tens of MB on both sides of every task.
    """
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, str(BATCH))
    app = spark.sparkContext.applicationId
    with _LOCK:
        if app in _SHIPPED:
            return
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        out = os.path.join(tempfile.mkdtemp(prefix="hearth-src-"), "hearth_src.zip")
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            for folder, _, names in os.walk(root):
                for n in names:
                    if n.endswith(".py"):
                        full = os.path.join(folder, n)
                        z.write(full, os.path.relpath(full, os.path.dirname(root)))
        spark.sparkContext.addPyFile(out)
        _SHIPPED.add(app)


def give_back() -> None:
    """Freed memory goes back to the system where the C library can do that: a driver that trained waits on jobs for long afterwards."""
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def rows_of(batches: Iterator[pa.RecordBatch], most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut so that their text stays near ``most_bytes``: what a worker makes of them is bounded by
    that and one row, whatever the session's batch size (see ``ship``).  No row is split or lost."""
    for b in batches:
        if not b.num_rows:
            continue
        step = max(1, int(b.num_rows * most_bytes / max(b.nbytes, 1)))
        for at in range(0, b.num_rows, step):
            yield b.slice(at, step)


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows that agree on ``keys`` (no nulls), one table a group, of batches that are sorted by them."""
    held: list[pa.RecordBatch] = []
    last: tuple = ()
    for b in batches:
        if not b.num_rows:
            continue
        cols = [b.column(k).to_numpy(zero_copy_only=False) for k in keys]
        cut = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in cols])) + 1
        edges = [0, *cut.tolist(), b.num_rows]
        for s, e in zip(edges[:-1], edges[1:]):
            this = tuple(c[s] for c in cols)
            if held and this != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(b.slice(s, e - s))
            last = this
    if held:
        yield pa.Table.from_batches(held)


def key_filter(nodes: DataFrame) -> np.ndarray:
    """A packed bitmap by the hashes of ``node``: of fixed size (2 MB), however many nodes there are.  It only spares work:
    bit ``pmod(xxhash64(key), key_filter.bits)`` is set for each node, and for others that share its place."""
    at = nodes.select((F.pmod(F.xxhash64("node"), F.lit(key_filter.bits)) + 1).alias("x"))
    parts = at.groupBy(F.bitmap_bucket_number("x").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("x")).alias("bits")).collect()
    out = np.zeros((key_filter.bits // 32_768, 4_096), dtype=np.uint8)
    for part in parts:
        out[part["bucket"] - 1] = np.frombuffer(part["bits"], dtype=np.uint8)
    return np.packbits(np.unpackbits(out.reshape(-1), bitorder="little"))


key_filter.bits = 1 << 24


def in_filter(packed: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Whether the places' bits are set, read from the packed bitmap as it is."""
    return (packed[places >> 3] >> (7 - (places & 7)).astype(np.uint8) & 1).astype(bool)


def checkpoint(df: DataFrame, spark: SparkSession) -> DataFrame:
    """Cut the lineage in the shared folder of ``spark.checkpoint.dir`` (see ``hearth.session``)."""
    from hearth.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, spark: SparkSession, name: str) -> DataFrame:
    """Cut the lineage by a Parquet table in the shared scratch folder: for larger intermediates, which it
    compresses and of which later reads take only the columns they need."""
    from hearth.session import scratch_path

    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.parquet(path)
