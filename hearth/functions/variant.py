"""Payloads of ``VARIANT`` type beside the ``map<string,string>`` ones.

``payload_of`` looks at the column's type and gives either the map column or a
``Variant``; ``field``, ``has_field`` (``hearth.functions.payload``) and ``unpivot`` take both, so a
model is written once.

JSON null, as the warehouse has it: a member that is null is *present*
(``has_field`` is true, ``unpivot`` has a row), and its text is NULL.  In a map the
value is NULL then, and ``has_field`` is false; a map cannot tell the two apart.
Strings come as they are, numbers and booleans as their JSON text, objects and arrays as JSON text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Variant:
    """A payload column of ``VARIANT`` type."""

    column: Column

    def member(self, name: str) -> Column:
        """The member as a variant (a JSON null stays one); NULL when the key is missing or the payload is no object."""
        if '"' not in name:
            return F.try_variant_get(self.column, f'$["{name}"]', "variant")
        if "'" not in name:
            return F.try_variant_get(self.column, f"$['{name}']", "variant")
        raise ValueError(f"a path cannot name a key with both kinds of quotes: {name}")


def variant_text(v: Column) -> Column:
    """A variant as text: strings without quotes, JSON null as NULL, the rest as JSON."""
    kind = F.schema_of_variant(v)
    return F.when(kind == "STRING", F.try_variant_get(v, "$", "string")).when(kind != "VOID", F.to_json(v))


def payload_of(df: DataFrame, name: str = "payload") -> Column | Variant:
    """The payload column as the functions of this package take it."""
    c = F.col(f"`{name}`")
    return Variant(c) if isinstance(df.schema[name].dataType, T.VariantType) else c


def unpivot(df: DataFrame, payload: str, pattern: str | None = None, key: str = "key", value: str = "value") -> DataFrame:
    """``df`` with one row for each member of its payload whose name matches ``pattern`` (a lateral flatten): ``key`` and ``value`` as text.

    A map is filtered before its entries become rows; a variant's members become
    rows of ``variant_explode``, and members are turned into text after the filter.  Payloads that are no object have no rows."""
    dtype = df.schema[payload].dataType
    c = F.col(f"`{payload}`")
    if not isinstance(dtype, T.VariantType):
        entries = c if pattern is None else F.map_filter(c, lambda k, _: k.rlike(pattern))
        return df.select("*", F.explode(entries).alias(key, value))
    members = df.sparkSession.tvf.variant_explode(c.outer()).toDF("__pos", "__key", "__value")
    rows = df.lateralJoin(members).where(F.col("__key").isNotNull())  # elements of an array have no key
    if pattern is not None:
        rows = rows.where(F.col("__key").rlike(pattern))
    return rows.select(*df.columns, F.col("__key").alias(key), variant_text(F.col("__value")).alias(value))


def map_of(payload: Variant) -> Column:
    """The variant's members as the canonical map payload (keys with JSON null map to NULL; no object: NULL)."""
    members = F.try_variant_get(payload.column, "$", "map<string,variant>")
    return F.transform_values(members, lambda _, v: variant_text(v))
