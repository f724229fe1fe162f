"""File scans: all-string CSV, JSON documents, landed JSONL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearth.schemas import LANDED_SCHEMA

BOM = "﻿"


#: Columns that one CSV file may have (the reader's own default is 20,480 and it then raises).
CSV_MAX_COLUMNS = 1_000_000


def _csv(spark: SparkSession, path: str | list[str], multiline: bool, empty_as: str | None) -> DataFrame:
    df = (
        spark.read.option("header", True)
        .option("multiLine", multiline)
        .option("escape", '"')
        .option("encoding", "UTF-8")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("inferSchema", False)
        .option("maxColumns", CSV_MAX_COLUMNS)
        .csv(path)
    )
    renamed = [F.col(f"`{c}`").alias(c.lstrip(BOM)) for c in df.columns]
    df = df.select(*renamed)
    return df.na.fill(empty_as) if empty_as is not None else df


def csv_headers(spark: SparkSession, path: str) -> list[tuple[str, list[str]]]:
    """Header lines of the files under ``path`` and the files of each, by file name.

    One scan; only the first split of a file can hold its header, and of that
    its first line that is not blank."""
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"),
        F.monotonically_increasing_id().alias("line"),
    )
    first = lines.where("at = 0 AND trim(value) <> ''").groupBy("file").agg(F.min_by("value", "line").alias("header"))
    groups: dict[str, list[str]] = {}
    for r in first.orderBy("file").collect():  # one short row per file
        groups.setdefault(r["header"].lstrip(BOM).rstrip("\r"), []).append(r["file"])
    return list(groups.items())


def read_csv_rows(
    spark: SparkSession, path: str, multiline: bool | str = True, empty_as: str | None = "", same_header: bool = False
) -> DataFrame:
    """CSV with a header row, every column as text.

    ``""`` quoting and quoted newlines are honoured, blank lines skipped,
    surrounding spaces kept and a UTF-8 byte-order mark dropped from the first
    header.  Spark cannot tell an unquoted empty field from a missing one, so
    every empty field becomes ``empty_as`` (``''`` by default).

    Every file follows its own header: files are read by header and put
    together by column name, and a column that a file does not have is NULL in its
    rows (wide feeds gain a column per delivery).  ``same_header=True`` skips
    the scan for headers where they are known to agree.

    ``multiline=True`` makes each file a single task (a quoted newline may sit
    anywhere); ``multiline="split"`` honours quoted newlines as well but splits large files
    over tasks (``sources.csv_records``); ``False`` is for feeds without quoted newlines.
    """
    if multiline == "split":
        return _split_csv(spark, path, empty_as)
    groups = [] if same_header else csv_headers(spark, path)
    if len(groups) <= 1:
        return _csv(spark, path, multiline, empty_as)
    parts = [_csv(spark, files, multiline, empty_as) for _, files in groups]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def _split_csv(spark: SparkSession, path: str, empty_as: str | None) -> DataFrame:
    """Records that ``csv_records`` found, parsed by Spark's CSV functions under the header of their file."""
    from hearth.sources import csv_records

    # a header's columns as the reader has them (names made unique, without the byte-order mark)
    groups = [(_csv(spark, files, True, None).columns, files) for _, files in csv_headers(spark, path)]
    found = csv_records.records(csv_records.physical_lines(spark, path)).where("not first")
    options = {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "maxColumns": str(CSV_MAX_COLUMNS), "multiLine": "true"}
    out = None
    for columns, files in groups:
        mine = found.where(F.col("file").isin(files)) if len(groups) > 1 else found
        schema = ", ".join(f"c{k} string" for k in range(len(columns)))
        row = F.from_csv(F.regexp_replace("text", r"\r$", ""), schema, options)
        part = mine.select(row.alias("r")).select(*[F.col(f"r.c{k}").alias(c) for k, c in enumerate(columns)])
        part = part.na.fill(empty_as) if empty_as is not None else part
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out if out is not None else _csv(spark, path, True, empty_as)


def _truthy(v: Column) -> Column:
    """JSON truthiness of a variant (non-empty array/object/string, non-zero number, true)."""
    t = F.schema_of_variant(v)
    return (
        F.when(v.isNull() | F.is_variant_null(v), F.lit(False))
        .when(t.startswith("ARRAY"), F.size(F.try_variant_get(v, "$", "array<variant>")) > 0)
        .when(t.startswith("OBJECT"), F.to_json(v) != F.lit("{}"))
        .when(t == "STRING", F.try_variant_get(v, "$", "string") != F.lit(""))
        .when(t == "BOOLEAN", F.try_variant_get(v, "$", "boolean"))
        .otherwise(F.coalesce(F.try_variant_get(v, "$", "double") != F.lit(0.0), F.lit(True)))
    )


def read_json_rows(spark: SparkSession, path: str, malformed: str = "raise") -> DataFrame:
    """Rows of JSON documents: a top-level array, or an object whose first
    truthy member among ``records``, ``data``, ``rows`` is the row array.
    Non-object elements are dropped; any other document yields no rows.

    A document that is no JSON raises, or is left out with ``malformed="skip"``.
    A document over the size of one variant value is parsed as an array (or object
    of arrays) of variants instead, so its size does not lose rows.

    Returns ``row`` (map<string,string>: numbers as text, nested values as JSON
    text) and ``source_file``.  A document is parsed whole, so one file is one
    task; the landed JSONL form (``read_normalized``) is the scalable one.
    """
    if malformed not in ("raise", "skip"):
        raise ValueError(f"unknown way with malformed documents: {malformed!r}")
    docs = spark.read.text(path, wholetext=True).select(
        "value", F.try_parse_json(F.col("value")).alias("doc"), F.col("_metadata.file_path").alias("source_file")
    )
    doc = F.col("doc")
    members = [F.try_variant_get(doc, f"$.{k}", "variant") for k in ("records", "data", "rows")]
    first = F.when(_truthy(members[0]), members[0]).when(_truthy(members[1]), members[1]).when(_truthy(members[2]), members[2])
    is_array = F.schema_of_variant(doc).startswith("ARRAY")
    rows_v = F.when(is_array, doc).when(F.schema_of_variant(doc).startswith("OBJECT"), first)
    arr = F.when(F.schema_of_variant(rows_v).startswith("ARRAY"), F.try_variant_get(rows_v, "$", "array<variant>"))
    # no variant of the whole: too large for one, or no JSON (which the strict parser refuses)
    strict = {"mode": "FAILFAST" if malformed == "raise" else "PERMISSIVE"}
    is_list = F.ltrim(F.regexp_replace(F.substring("value", 1, 1000), r"^[\s\uFEFF]+", "")).startswith("[")
    lists = F.from_json("value", "array<variant>", strict)
    named = F.from_json("value", "records array<variant>, data array<variant>, rows array<variant>", strict)
    filled = [F.when(F.size(named[k]) > 0, named[k]) for k in ("records", "data", "rows")]
    large = F.when(is_list, lists).otherwise(F.coalesce(*filled))
    given = doc.isNotNull() | (F.trim("value") == "")
    elems = docs.select(F.explode(F.when(given, arr).otherwise(large)).alias("elem"), "source_file")
    objects = elems.where(F.schema_of_variant(F.col("elem")).startswith("OBJECT"))
    return objects.select(
        F.from_json(F.to_json(F.col("elem")), "map<string,string>").alias("row"), "source_file"
    )


#: Columns of landed lines as they are read, with the text of lines that do not fit.
LANDED_AND_REJECTS = T.StructType(LANDED_SCHEMA.fields + [T.StructField("_corrupt_record", T.StringType())])
#: The reader checks the columns that a query takes.  Naming the payload in every query makes a line good
#: or bad for all of them alike, so counts, audits and loads of the same files agree.
WHOLE_LINES = "coalesce(size(payload), -1) >= -1"
GOOD_LINES = f"_corrupt_record IS NULL AND {WHOLE_LINES}"


def read_normalized(
    spark: SparkSession, root: str, file_pattern: str | None = None, keep_rejects: bool = False, as_of: str | None = None
) -> DataFrame:
    """Landed raw records (JSONL, hive layout ``dataset_name=/ingest_date=/run_id=``).

    Explicit schema, no inference.  Malformed lines are skipped rather than
    failing the load, whichever columns a query takes; with ``keep_rejects`` they come back with a
    ``_corrupt_record`` column instead, so they can be counted.  Timestamps are
    parsed tolerantly (bad text -> NULL).  ``original_s3_key`` falls back to the
    file each row came from.  ``as_of`` stamps the rows with the time of the
    load (``loaded_at``), which ``quality.freshness`` reads.
    """
    reader = spark.read.schema(LANDED_AND_REJECTS).option("mode", "PERMISSIVE")
    if file_pattern:
        reader = reader.option("pathGlobFilter", file_pattern)
    df = reader.json(root).where(WHOLE_LINES if keep_rejects else GOOD_LINES)
    cols = [
        "dataset_name", "dataset_type", "source_url", "source_row_id", "record_hash",
    ]
    out = df.select(
        *cols,
        F.try_to_timestamp(F.col("extracted_at")).alias("extracted_at"),
        F.try_to_timestamp(F.col("ingested_at")).alias("ingested_at"),
        "run_id",
        F.coalesce(F.col("original_s3_key"), F.col("_metadata.file_path")).alias("original_s3_key"),
        "payload",
        *(["_corrupt_record"] if keep_rejects else []),
        *([F.lit(as_of).cast("timestamp").alias("loaded_at")] if as_of is not None else []),
    )
    return out
