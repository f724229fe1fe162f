"""Dense, ordered row numbers without funnelling the data through one task.

``row_number()`` over an unpartitioned window moves every row to a single
task.  Instead: tag rows with ``monotonically_increasing_id`` (partition index
in the high bits, position in the low 33 bits), count rows per partition, turn
the counts into offsets, and add the offset back.  Only one row per partition
ever reaches a single task, and the offsets table is broadcast because its
size is bounded by the number of partitions, not by the data.

The input must have a deterministic partitioning (a file scan, or a written
table): the tag is computed by two scans that must agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_LOW_BITS = 33
_MASK = (1 << _LOW_BITS) - 1


def with_dense_index(df: DataFrame, name: str = "ordinal", start: int = 1, within: Column | None = None) -> DataFrame:
    """Add ``name``: 1-based (by default) position of each row in scan order.

    ``within`` numbers rows separately per value of that column, e.g.
    ``F.col("_metadata.file_path")`` on a file scan for per-file row numbers
    (the splits of one file are scanned in file order).  The offsets table then
    has one row per (value, input partition) pair, i.e. per file split.
    """
    tag = "__hearth_mid"
    tagged = df.withColumn(tag, F.monotonically_increasing_id())
    if within is not None:
        tagged = tagged.withColumn("__within", within)
    part = F.shiftright(F.col(tag), _LOW_BITS)
    group = ["__within"] if within is not None else []
    counts = tagged.groupBy(*group, part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    # One row per input partition (per file split with ``within``): the window
    # below and the broadcast are bounded by the scan's splits, not its rows.
    w = (Window.partitionBy(*group) if group else Window).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*group, "__part", F.sum("__n").over(w).alias("__off")).fillna({"__off": 0})
    cond = part == F.col("__part")
    if group:
        offsets = offsets.withColumnRenamed("__within", "__within_o")
        cond = cond & F.col("__within").eqNullSafe(F.col("__within_o"))
    joined = tagged.join(F.broadcast(offsets), cond, "left")
    return joined.withColumn(
        name, (F.col("__off") + F.col(tag).bitwiseAND(F.lit(_MASK)) + F.lit(start)).cast("long")
    ).drop(tag, "__part", "__off", "__within", "__within_o")
