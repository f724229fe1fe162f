"""Presentation for cross-engine comparison.

Results are compared against DuckDB, whose value types differ from Spark's
in ways that say nothing about correctness (decimal widths, date objects).
``checkable`` renders every column in a form both engines share: decimals as
double, dates and timestamps as ISO text (instants in UTC, so the session
time zone does not matter), arrays and maps as JSON text.  The
oracle SQL applies the same rendering.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearth.functions.scalar import utc_text


KEEP_NULLS = {"ignoreNullFields": "false"}


def checkable(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, T.DecimalType):
            c = c.cast("double")
        elif isinstance(t, T.TimestampType):
            c = utc_text(c)
        elif isinstance(t, (T.DateType, T.TimestampNTZType)):
            c = c.cast("string")
        elif isinstance(t, T.MapType):
            c = F.to_json(F.array_sort(F.map_entries(c)), KEEP_NULLS)
        elif isinstance(t, (T.ArrayType, T.StructType)):
            c = F.to_json(c, KEEP_NULLS)
        elif isinstance(t, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        elif isinstance(t, T.FloatType):
            c = c.cast("double")
        cols.append(c.alias(f.name))
    return df.select(*cols)
