"""Projections and filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def where_in(df: DataFrame, col: str, values: Sequence[object]) -> DataFrame:
    """Equality / IN-list filter (pushed to the scan as an ``In`` filter)."""
    return df.where(F.col(col).isin(list(values)))


def where_present(df: DataFrame, *cols: str) -> DataFrame:
    """Rows where every named column is non-NULL."""
    cond = None
    for c in cols:
        term = F.col(c).isNotNull()
        cond = term if cond is None else cond & term
    return df if cond is None else df.where(cond)


def project(df: DataFrame, mapping: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """Subset, reorder and rename: ``{source: target}`` or a list of names."""
    if isinstance(mapping, Mapping):
        return df.select(*[F.col(src).alias(dst) for src, dst in mapping.items()])
    return df.select(*mapping)


def distinct_rows(df: DataFrame, *cols: str) -> DataFrame:
    """SELECT DISTINCT over the named columns (all columns when none given)."""
    return (df.select(*cols) if cols else df).distinct()
