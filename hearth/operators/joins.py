"""Join operators: coalescing full outer joins, lookups, anti joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Tasks over which rows with a NULL key are spread, at most.
NULL_SPREAD = 4096


def _spread(df: DataFrame, key: str, sign: int) -> Column:
    """0 for rows that have their key, else a number by the row's other values.  Rows with a NULL key match
    nothing, but an outer join keeps them, and a shuffle by the key alone puts all of them into one task.  As a
    second key (with another sign on either side, so it never makes a match) this deals them over the tasks."""
    plain = [F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return F.when(F.col(f"`{key}`").isNull(), sign * (F.pmod(F.xxhash64(*plain), F.lit(NULL_SPREAD)) + 1)).otherwise(0)


def full_outer_coalesce(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str | tuple[str, str]],
    null_as: Mapping[str, object] | None = None,
    left_prefix: str = "l__",
    right_prefix: str = "r__",
) -> DataFrame:
    """Full outer equi-join returning both sides' columns prefixed.

    ``on`` items are a shared column name or a ``(left_col, right_col)`` pair.
    ``null_as`` maps a left key column to a stand-in value: both sides are
    compared through ``coalesce(col, value)``, so NULL and the stand-in match
    each other, and the comparison stays a hashable equi-join.  Keys without a
    stand-in never match on NULL, and such rows survive unmatched on both sides; with a single
    key they are spread over the tasks (``_spread``), with several the others do that.
    """
    null_as = dict(null_as or {})
    l = left.select(*[F.col(c).alias(left_prefix + c) for c in left.columns])
    r = right.select(*[F.col(c).alias(right_prefix + c) for c in right.columns])
    cond: Column | None = None
    for item in on:
        lc, rc = (item, item) if isinstance(item, str) else item
        a, b = F.col(left_prefix + lc), F.col(right_prefix + rc)
        if lc in null_as:
            fill = F.lit(null_as[lc])
            a, b = F.coalesce(a, fill), F.coalesce(b, fill)
        term = a == b
        cond = term if cond is None else cond & term
    if len(on) > 1 or null_as:
        return l.join(r, cond, "full_outer")
    lc, rc = (on[0], on[0]) if isinstance(on[0], str) else on[0]
    l = l.withColumn("__left_spread", _spread(l, left_prefix + lc, 1))
    r = r.withColumn("__right_spread", _spread(r, right_prefix + rc, -1))
    return l.join(r, cond & (F.col("__left_spread") == F.col("__right_spread")), "full_outer").drop("__left_spread", "__right_spread")


def left_chain(df: DataFrame, steps: Sequence[tuple[DataFrame, str, str | tuple[str, str]]]) -> DataFrame:
    """``df`` left-joined with several tables, one after the other.

    ``steps``: (table, prefix, key), the key a column of both or a (column of ``df``, column of the table) pair.  The
    columns of a table come with its prefix.  All rows of ``df`` stay; a table with several rows of a key
    fans them out.  Rows with a NULL key have no match and are spread over the tasks (``_spread``); steps on one
    key share its shuffle."""
    out = df
    spread: dict[str, str] = {}
    for table, prefix, key in steps:
        left, right = (key, key) if isinstance(key, str) else key
        if left not in spread:
            spread[left] = f"__spread_{left}"
            out = out.withColumn(spread[left], _spread(df, left, 1))
        side = table.where(F.col(f"`{right}`").isNotNull()).select(*[F.col(f"`{c}`").alias(prefix + c) for c in table.columns], F.pmod(F.xxhash64(F.col(f"`{right}`")), F.lit(1)).alias("__zero"))
        # always 0, but no literal: the planner would take a literal out of the join's keys
        cond = (F.col(f"`{left}`") == F.col(f"`{prefix + right}`")) & (F.col(spread[left]) == F.col("__zero"))
        out = out.join(side, cond, "left").drop("__zero")
    return out.drop(*spread.values())


def lookup(df: DataFrame, dim: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join a dimension onto ``df``.  No hint: Spark broadcasts it when file statistics or the measured
    shuffle size are under its threshold, and splits skewed keys of a shuffle join otherwise."""
    return df.join(dim, list(on), how)


def anti(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``other`` (NULL keys never match)."""
    return df.join(other.select(*keys), list(keys), "left_anti")


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where NULL matches NULL (``<=>``); keys appear once, from the left."""
    renamed = right.select(*[F.col(c).alias("__rk_" + c) if c in keys else F.col(c) for c in right.columns])
    cond: Column | None = None
    for k in keys:
        term = F.col(k).eqNullSafe(F.col("__rk_" + k))
        cond = term if cond is None else cond & term
    out = left.join(renamed, cond, how)
    return out.drop(*["__rk_" + k for k in keys])
