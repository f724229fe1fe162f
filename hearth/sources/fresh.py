"""Rows of a batch that a table does not hold yet, found with little disk.

An anti-join by keys moves whole rows of the batch and all keys of the table through a shuffle, which for landed records is a
multiple of what they take compressed.  Here hashes go ahead of the rows: one shuffle of eight bytes a key finds the hashes that
the batch shares with the table (or, where repeats collapse, with itself).  They are marked in a bitmap that is broadcast.  A row
whose place is not marked has a key that nothing else has, so it is taken as it stands, without a shuffle.  The others are
compared by their keys, as before, in slices of bounded size; shuffles of a slice are removed before the next one begins.

Hashes never decide: a marked place only says "compare".  Results are those of the join.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearth.session import frugal_writes, scratch_path

#: Places of the bitmap for each shared hash (a share of 1/64 of the other rows is compared in vain), and the most it has, 32 MB.
#: Both are powers of two.
PLACES, MOST_PLACES = 64, 1 << 28
#: Rows that are compared at once, about.
SLICE_ROWS = 16_000_000

#: Types of which equal values have equal hashes, on either side of a join.
_PLAIN = (T.StringType, T.BinaryType, T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType)


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


def comparable(batch: DataFrame, target: DataFrame | None, keys: Sequence[str]) -> bool:
    """Whether equal keys have equal hashes on both sides (a partition folder may be read back with another type)."""
    kinds = [batch.schema[k].dataType for k in keys]
    return all(isinstance(k, _PLAIN) for k in kinds) and (target is None or kinds == [target.schema[k].dataType for k in keys])


def shared_hashes(batch: DataFrame, target: DataFrame | None, keys: Sequence[str], repeats: bool) -> DataFrame:
    """Hashes ``h`` of the batch that the table has too, or with ``repeats`` that come twice in the batch; ``n``: rows of the batch."""
    rows = batch.select(key_hash(keys).alias("h"), F.lit(1).alias("n"), F.lit(False).alias("held"))
    if target is not None:
        rows = rows.unionByName(target.select(key_hash(keys).alias("h"), F.lit(0).alias("n"), F.lit(True).alias("held")))
    by_hash = rows.groupBy("h").agg(F.sum("n").alias("n"), F.max("held").alias("held"))
    shared = F.col("held") | (F.col("n") > 1) if repeats else F.col("held")
    return by_hash.where((F.col("n") > 0) & shared).select("h", "n")


def _marks(shared: DataFrame, places: int) -> DataFrame:
    """The bitmap: ``__words``, 64 words of 64 places each, for each ``__chunk`` that has a mark."""
    at = F.col("h").bitwiseAND(F.lit(places - 1))
    words = shared.select(at.alias("at")).groupBy(F.shiftright("at", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(at & 63 AS INT)))").alias("bits"))
    chunks = words.groupBy(F.shiftright("word", 6).alias("__chunk")).agg(
        F.map_from_entries(F.collect_list(F.struct(F.expr("cast(word & 63 AS INT)"), "bits"))).alias("m")
    )
    return chunks.select("__chunk", F.expr("transform(sequence(0, 63), k -> coalesce(m[k], 0L))").alias("__words"))


def _marked(df: DataFrame, marks: DataFrame, places: int, keys: Sequence[str], want: bool, slices: int = 1, number: int = 0) -> DataFrame:
    """Rows whose place is marked (of one slice), or with ``want=False`` those whose place is not."""
    h = df.withColumn("__h", key_hash(keys))
    if slices > 1:
        h = h.where(F.pmod(F.shiftright("__h", 40), F.lit(slices)) == number)
    at = h.withColumn("__at", F.col("__h").bitwiseAND(F.lit(places - 1))).withColumn("__chunk", F.shiftright("__at", 12))
    hit = F.expr("coalesce(shiftright(get(__words, cast(shiftright(__at, 6) & 63 AS INT)), cast(__at & 63 AS INT)) & 1L, 0L) = 1L")
    return at.join(F.broadcast(marks), "__chunk", "inner" if want else "left").where(hit if want else ~hit).select(*df.columns)


@contextmanager
def fresh_rows(
    batch: DataFrame,
    target: DataFrame | None,
    keys: Sequence[str],
    pick: Callable[[DataFrame], DataFrame] | None = None,
    hashes: DataFrame | None = None,
) -> Iterator[DataFrame]:
    """The rows of ``batch`` whose key is not in ``target``, to be written inside the ``with`` block.

    ``pick`` leaves one row for each key of the batch (without it all rows of a new key are kept).  ``hashes``: the distinct key
    hashes ``h`` of the batch, where they are stored already.  The batch is worked out up to three times, so
    its keys must come out alike each time, as those of stored files do."""
    from hearth.sources.sinks import remove_folder

    spark = batch.sparkSession
    keys = list(keys)
    held = target.select(*keys) if target is not None else None
    if held is None and pick is None:
        yield batch
        return
    if not comparable(batch, held, keys):
        rows = pick(batch) if pick else batch
        yield rows.join(held, keys, "left_anti") if held is not None else rows
        return
    scratch = scratch_path(spark, f"fresh-{uuid.uuid4().hex}")
    try:
        with frugal_writes(spark):
            if hashes is not None and pick is None:
                found = hashes.join(held.select(key_hash(keys).alias("h")), "h", "left_semi").select("h", F.lit(1).alias("n"))
            else:
                found = shared_hashes(batch, held, keys, pick is not None)
            found.write.parquet(f"{scratch}/shared")
            shared = spark.read.parquet(f"{scratch}/shared")
            count, rows = shared.agg(F.count("h"), F.sum("n")).first()
        if not count:
            yield batch
            return
        places = min(MOST_PLACES, 1 << max(12, (count * PLACES - 1).bit_length()))
        with frugal_writes(spark):
            _marks(shared, places).write.parquet(f"{scratch}/marks")
        marks = spark.read.parquet(f"{scratch}/marks")
        slices = -(-rows // SLICE_ROWS)
        for number in range(slices):
            part = _marked(batch, marks, places, keys, True, slices, number)
            part = pick(part) if pick else part
            if held is not None:
                # no anti-join: the optimizer would move it below the join with the marks, and all rows would be compared
                there = _marked(held, marks, places, keys, True, slices, number).distinct().withColumn("__there", F.lit(True))
                part = part.join(there, keys, "left").where("__there IS NULL").select(*batch.columns)
            with frugal_writes(spark):
                part.write.mode("append").option("compression", "zstd").parquet(f"{scratch}/rest")
        rest = spark.read.schema(part.schema).parquet(f"{scratch}/rest")
        whole = False  # whether every key was compared
        if hashes is not None and pick is None:
            with frugal_writes(spark):
                whole = hashes.count() == count
        if whole:
            yield rest
        else:
            yield _marked(batch, marks, places, keys, False).unionByName(rest)
    finally:
        remove_folder(spark, scratch)
