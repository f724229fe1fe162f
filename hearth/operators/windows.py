"""Window operators: latest row per key, lag deltas and ratios, rolling stddev.

Null ordering is always spelled out.  The warehouse semantics being matched
treat NULL as the largest value: ascending puts NULLs last, descending puts
them first.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

OrderSpec = str | tuple[str, str]


def _order(spec: OrderSpec) -> Column:
    """``'col'`` -> ascending NULLS LAST; ``('col', 'desc')`` -> descending NULLS FIRST."""
    if isinstance(spec, str):
        return F.col(spec).asc_nulls_last()
    name, direction = spec
    if direction.lower() == "desc":
        return F.col(name).desc_nulls_first()
    return F.col(name).asc_nulls_last()


def ordered_window(keys: Sequence[str], order: Sequence[OrderSpec]) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(*[_order(o) for o in order])


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[OrderSpec], rank_col: str = "__rn") -> DataFrame:
    """Keep the first row per ``keys`` under ``order`` (QUALIFY row_number() = 1).

    Catalyst plans this as a WindowGroupLimit with a partial phase before the
    shuffle, so a hot key is cut down to one row per map task before it moves.
    """
    w = ordered_window(keys, order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) == 1).drop(rank_col)


def lag_ratio(
    c: str, keys: Sequence[str], order: Sequence[OrderSpec], n: int = 1, lag_col: Column | None = None
) -> Column:
    """``c / nullif(lag(c, n), 0) - 1`` in double precision.  ``n`` counts rows,
    not calendar periods: gaps in the series are not noticed."""
    prev = lag_col if lag_col is not None else F.lag(c, n).over(ordered_window(keys, order))
    return F.col(c).cast("double") / F.nullif(prev.cast("double"), F.lit(0.0)) - F.lit(1.0)


def rolling_stddev(c: str, keys: Sequence[str], order: Sequence[OrderSpec], rows: int = 6) -> Column:
    """Sample stddev over the current row and the ``rows - 1`` before it; NULLs
    are skipped and fewer than two values give NULL."""
    w = ordered_window(keys, order).rowsBetween(-(rows - 1), Window.currentRow)
    return F.stddev_samp(F.col(c).cast("double")).over(w)


# ---------------------------------------------------------------------------
# lag that survives hot keys

def _ascending_only(order: Sequence[OrderSpec]) -> bool:
    return all(isinstance(o, str) or o[1].lower() != "desc" for o in order)


def _name(o: OrderSpec) -> str:
    return o if isinstance(o, str) else o[0]


def _lag_ranked(
    df: DataFrame, keys: Sequence[str], order: Sequence[OrderSpec], lags: Sequence[tuple[str, str]], partitions: int | None
) -> DataFrame:
    """lag(c, 1) without putting a key in one task.

    Rows are range-partitioned on (keys, order), so a hot key spreads over
    several partitions.  The lag is taken per (partition, key) and the first
    row of each piece takes its predecessor from the last row of the previous
    non-empty partition: a table with one row per partition, broadcast because
    its size is bounded by the partition count.
    """
    spark = df.sparkSession
    sort_cols = [F.col(k).asc_nulls_last() for k in keys] + [_order(o) for o in order]
    # AQE may coalesce adjacent ranges when no count is given; order is kept.
    ranged = df.repartitionByRange(partitions, *sort_cols) if partitions else df.repartitionByRange(*sort_cols)
    ranked = ranged.withColumn("__pid", F.spark_partition_id())
    # Read twice (per-piece lags, partition boundaries): written once, as Parquet, of which the boundaries read a few columns.
    from hearth.session import scratch_path

    path = scratch_path(spark, f"lag-{uuid.uuid4().hex}")
    ranked.write.parquet(path)
    ranked = spark.read.parquet(path)
    w = Window.partitionBy("__pid", *keys).orderBy(*[_order(o) for o in order])
    local = ranked.select(
        "*", F.row_number().over(w).alias("__pos"), *[F.lag(src, 1).over(w).alias(f"__lag_{out}") for src, out in lags]
    )
    # position of a row in the (keys asc nulls last, order asc nulls last) sort, as a comparable struct
    rank_key = F.struct(*[F.struct(F.col(c).isNull(), F.col(c)) for c in [*keys, *map(_name, order)]])
    payload = F.struct(*[F.col(k).alias(k) for k in keys], *[F.col(src).alias(f"v_{out}") for src, out in lags])
    last = ranked.groupBy("__pid").agg(F.max_by(payload, rank_key).alias("__last"))
    prev = last.select("__pid", F.lag("__last").over(Window.orderBy("__pid")).alias("__prev"))
    joined = local.join(F.broadcast(prev), "__pid", "left")
    same = None
    for k in keys:
        term = F.col("__prev").getField(k).eqNullSafe(F.col(k))
        same = term if same is None else same & term
    first = (F.col("__pos") == 1) & F.col("__prev").isNotNull() & same
    out = joined.select(
        *df.columns,
        *[F.when(first, F.col("__prev").getField(f"v_{o}")).otherwise(F.col(f"__lag_{o}")).alias(o) for _, o in lags],
    )
    return out


def with_lags(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[OrderSpec],
    lags: Sequence[tuple[str, str]],
    strategy: str = "ranked",
    partitions: int | None = None,
) -> DataFrame:
    """Add ``lag(source, 1)`` columns, as ``(source, output)`` pairs.

    ``strategy`` is the caller's: ``ranked`` is range-partitioned, no task ever
    holds a whole key (ascending orders only); ``window`` is one window per key, for
    keys that the caller knows to be bounded.  The size of the data never picks one.
    The order should end in a unique column so the predecessor is defined.
    """
    if strategy == "window":
        w = ordered_window(keys, order)
        return df.select("*", *[F.lag(src, 1).over(w).alias(out) for src, out in lags])
    if strategy == "ranked":
        if not _ascending_only(order):
            raise ValueError("the ranked lag supports ascending orders only")
        return _lag_ranked(df, keys, order, lags, partitions)
    raise ValueError(f"unknown lag strategy {strategy!r}")
