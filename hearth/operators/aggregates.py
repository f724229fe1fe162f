"""Aggregate helpers, including an exact median that survives hot groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearth.operators.joins import join_null_safe
from hearth.session import ensure_checkpoint_dir

def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def count_when(pred: Column) -> Column:
    """Rows where ``pred`` is true (NULL is not counted); 0 for an empty group."""
    return F.count_if(pred)


def flag_sum(pred: Column) -> Column:
    """``sum(case when pred then 1 else 0 end)`` as bigint."""
    return F.sum(F.when(pred, F.lit(1)).otherwise(F.lit(0))).cast("long")


def sum_default(c: Column | str, default: object) -> Column:
    """``sum(coalesce(c, default))``."""
    return F.sum(F.coalesce(_c(c), F.lit(default)))


def any_stable(c: Column | str) -> Column:
    """A representative value per group.  ``any_value`` is not reproducible, so
    the smallest value is taken."""
    return F.min(_c(c))


def mean(c: Column | str, scale: int | None = None) -> Column:
    """Average as a double.

    With ``scale`` (the decimal scale of a money column) the sum is taken
    exactly in integer units (cents for scale 2) and divided once, so the
    result is the correctly rounded quotient and does not depend on the order
    of summation: identical on every engine and every partitioning."""
    if scale is None:
        return F.avg(_c(c).cast("double"))
    units = (_c(c) * F.lit(10**scale)).cast("long")
    return F.sum(units).cast("double") / F.count(_c(c)).cast("double") / F.lit(float(10**scale))


def rollup_sum(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Re-aggregate already-aggregated columns to a coarser key."""
    return df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in cols])


# ---------------------------------------------------------------------------
# exact median


def _value_counts(df: DataFrame, keys: Sequence[str], value: Column | str) -> DataFrame:
    """(keys, value, multiplicity): repeated values of a hot group collapse map-side."""
    v = _c(value).cast("double")
    return (
        df.select(*keys, v.alias("__v"))
        .where(F.col("__v").isNotNull())
        .groupBy(*keys, "__v")
        .agg(F.count(F.lit(1)).alias("__c"))
    )


def _median_builtin(df: DataFrame, keys: Sequence[str], value: Column | str, alias: str) -> DataFrame:
    # Spark's exact percentile keeps one value->count map per group (with
    # map-side partial aggregation): memory grows with distinct values, not rows.
    return df.groupBy(*keys).agg(F.median(_c(value).cast("double")).alias(alias))


def _median_ranked(counts: DataFrame, keys: Sequence[str], alias: str, partitions: int | None) -> DataFrame:
    """Rank selection: sort (keys, value) across range partitions, prefix-sum the
    multiplicities, and pick the one or two middle ranks of every group.

    A hot group spreads over many range partitions; no task ever holds a whole
    group.  What is known of a (group, partition) pair is one row, and the
    partition that holds a rank is found by a running sum over a group's pairs.
    """
    # Defined here so it is shipped to the Python workers by value: executors
    # need pandas, not this package.
    def _running_end(batches):
        import pandas as pd

        total = 0
        for pdf in batches:
            if len(pdf):
                ends = pdf["__c"].cumsum() + total
                total = int(ends.iloc[-1])
                pdf = pdf.assign(__end=ends.astype("int64"))
            else:
                pdf = pdf.assign(__end=pd.Series([], dtype="int64"))
            yield pdf

    spark = counts.sparkSession
    # Without an explicit count AQE may coalesce the range partitions; it only
    # merges adjacent ranges in order, so per-partition prefix sums stay valid.
    ranged = counts.repartitionByRange(partitions, *keys, "__v") if partitions else counts.repartitionByRange(*keys, "__v")
    ordered = ranged.sortWithinPartitions(*keys, "__v")
    tagged = ordered.withColumn("__pid", F.spark_partition_id())
    schema = T.StructType(tagged.schema.fields + [T.StructField("__end", T.LongType(), False)])
    # Two branches read this (pieces, values); checkpoint it once so the input
    # is not scanned and aggregated twice.
    ensure_checkpoint_dir(spark)
    local = tagged.mapInPandas(_running_end, schema).checkpoint(eager=True)

    # One row per (group, partition): its rows, and the running count before them.
    pieces = local.groupBy(*keys, "__pid").agg(
        F.sum("__c").alias("__m"), F.min(F.col("__end") - F.col("__c")).alias("__base")
    )
    earlier = Window.partitionBy(*keys).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    placed = pieces.select(
        *keys, "__pid", "__m", "__base",
        F.coalesce(F.sum("__m").over(earlier), F.lit(0)).alias("__before"),
        F.sum("__m").over(Window.partitionBy(*keys)).alias("__n"),
    )
    ranks = F.array(F.floor((F.col("__n") - 1) / 2).cast("long") + 1, F.floor(F.col("__n") / 2).cast("long") + 1)
    located = (
        placed.select(*keys, "__pid", "__m", "__base", "__before", F.explode(ranks).alias("__r"))
        .where((F.col("__r") > F.col("__before")) & (F.col("__r") <= F.col("__before") + F.col("__m")))
        .select(*keys, "__pid", (F.col("__r") - F.col("__before") + F.col("__base")).alias("__p"))
    )
    picked = join_null_safe(local, located, [*keys, "__pid"]).where(
        (F.col("__p") <= F.col("__end")) & (F.col("__p") > F.col("__end") - F.col("__c"))
    )
    return picked.groupBy(*keys).agg(F.avg("__v").alias(alias))


def grouped_median(
    df: DataFrame,
    keys: Sequence[str],
    value: Column | str,
    alias: str = "median",
    strategy: str = "ranked",
    partitions: int | None = None,
) -> DataFrame:
    """Exact median of ``value`` per group (mean of the two middle values for
    an even count), as a double.  Groups whose values are all NULL are absent;
    join the result back with a left join to keep them.

    ``strategy`` is the caller's: ``ranked`` (rank selection, memory independent
    of group size) or ``builtin`` (exact percentile in the group's own
    aggregation, memory = distinct values of the group; for values that the
    caller knows to be few, such as prices on a grid).  The size of the data never
    picks one.
    """
    if strategy == "builtin":
        return _median_builtin(df, keys, value, alias)
    if strategy == "ranked":
        return _median_ranked(_value_counts(df, keys, value), keys, alias, partitions)
    raise ValueError(f"unknown median strategy {strategy!r}")


def aggregate_with_median(
    df: DataFrame,
    keys: Sequence[str],
    aggs: Sequence[Column],
    medians: Sequence[tuple[Column | str, str]],
    strategy: str = "ranked",
) -> DataFrame:
    """``groupBy(keys).agg(*aggs)`` plus exact medians.

    ``ranked`` medians are joined back on the (NULL-safe) group key, so every
    group is kept; ``builtin`` ones (alias ``inline``) are computed in the same
    aggregation.  See ``grouped_median`` for the choice.
    """
    if strategy in ("builtin", "inline"):
        return df.groupBy(*keys).agg(*aggs, *[F.median(_c(v).cast("double")).alias(a) for v, a in medians])
    if strategy != "ranked":
        raise ValueError(f"unknown median strategy {strategy!r}")
    out = df.groupBy(*keys).agg(*aggs)
    for value, alias in medians:
        out = join_null_safe(out, grouped_median(df, keys, value, alias, "ranked"), keys, "left")
    return out
