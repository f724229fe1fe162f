"""Secret scans with an incremental blob ledger (native).

Every text is a blob named by the SHA-256 of its bytes, so all versions and
copies of a file that hold the same text share one blob.  The ledger is a stored
table of findings, one row ``(blob, rule_version, spans)`` for every pair that was scanned, also
without a finding; a run scans only pairs that it does not hold, appends their rows, and joins findings
back to all paths.  A new rule version rescans each blob once; a new version of
one file scans that blob alone.  As findings and ledger are one table, neither can come without the other.

Spans are found with JVM regular expressions only: the text between matches
(``split``) and the matches (``regexp_extract_all``) become rows, running sums of their lengths are
the offsets in code points, and matches that are too short drop out afterwards, so
they still consume their text as a leftmost non-overlapping search does.  All steps are linear in the text and its matches.

Defined cases: null text is the empty blob; repeated rows and ids are paths of
their own; ties cannot occur within a kind (matches of a kind do not overlap)
and kinds that start together come in the order of ``KINDS``; other columns are
ignored; texts of any length are read whole; an empty table gives no rows.  One writer at a time appends to a ledger.
No Python runs on the executors.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hearth.session import scratch_path
from hearth.sources.sinks import table_exists

#: Version of the rules below; change it with any of them.
RULES = "1"
#: Kind, pattern, group whose length is checked, least length.  Patterns are bounded below where that cannot
#: change the matches (a run is taken whole either way); ``assign`` is searched unbounded and checked after.
KINDS: list[tuple[str, str, int, int]] = [
    ("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
]
SPAN = "struct<start:bigint,rank:int,kind:string,end:bigint>"


def blob_of(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def _matches(text: Column, rank: int, kind: str, pattern: str, group: int, least: int) -> Column:
    """Array of the matches of one kind in order: number, characters before it since the last one, its own, and whether it counts."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    checked = whole if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    rows = F.arrays_zip(F.slice(F.split(text, pattern, -1), 1, F.greatest(F.size(whole), F.lit(0))).alias("g"), whole.alias("w"), checked.alias("c"))
    one = lambda x, i: F.struct(
        F.lit(rank).alias("rank"), i.alias("i"), F.length(x["g"]).cast("long").alias("gap"), F.length(x["w"]).cast("long").alias("n"), (F.length(x["c"]) >= least).alias("counts")
    )
    return F.when(text.rlike(pattern), F.transform(rows, one)).otherwise(F.expr("cast(array() as array<struct<rank:int,i:int,gap:bigint,n:bigint,counts:boolean>>)"))


def scan(blobs: DataFrame) -> DataFrame:
    """``blob spans`` of ``blob text`` (each blob once): spans of all kinds by start, then kind."""
    matches = F.concat(*[_matches(F.col("text"), i, *k) for i, k in enumerate(KINDS)])
    rows = blobs.select("blob", F.explode_outer(matches).alias("m")).select("blob", "m.*")
    upto = Window.partitionBy("blob", "rank").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.withColumn("end", F.sum(F.col("gap") + F.col("n")).over(upto))
    name = F.element_at(F.array(*[F.lit(k[0]) for k in KINDS]), F.col("rank") + 1)
    span = F.struct((F.col("end") - F.col("n")).alias("start"), "rank", name.alias("kind"), "end")
    return placed.groupBy("blob").agg(F.sort_array(F.collect_list(F.when(F.col("counts"), span))).alias("spans"))


def unseen(texts: DataFrame, findings: DataFrame | None, rule_version: str = RULES) -> DataFrame:
    """``blob text`` once for every blob of ``texts`` that the ledger does not have for these rules."""
    blobs = texts.select(blob_of(F.col("text")).alias("blob"), F.coalesce("text", F.lit("")).alias("text"))
    if findings is not None:
        known = findings.where(F.col("rule_version") == rule_version).select("blob").distinct()
        blobs = blobs.join(known, "blob", "left_anti")
    return blobs.dropDuplicates(["blob"])


def scan_increment(texts: DataFrame, ledger: str, rule_version: str = RULES) -> DataFrame:
    """``blob rule_version spans`` of all blobs that the stored ledger holds for these rules, after those of ``texts`` that it did not
    hold were scanned and appended.  ``ledger``: the folder of the table, which need not exist yet."""
    spark = texts.sparkSession
    known = spark.read.parquet(ledger) if table_exists(spark, ledger) else None
    if known is not None and (missing := {"blob", "rule_version", "spans"} - set(known.columns)):
        raise ValueError(f"no ledger of findings in {ledger}: it has no {', '.join(sorted(missing))}")
    new = scan(unseen(texts, known, rule_version)).select("blob", F.lit(rule_version).alias("rule_version"), "spans")
    new.write.mode("append").parquet(ledger)
    return spark.read.parquet(ledger).where(F.col("rule_version") == rule_version)


def scratch_ledger(spark: SparkSession) -> str:
    """A ledger's folder for one run, in the shared scratch folder."""
    return scratch_path(spark, f"ledger-{uuid.uuid4().hex}")


def to_paths(paths: DataFrame, findings: DataFrame) -> DataFrame:
    """Findings of every row of ``paths`` (any columns and ``blob``); a blob without findings has an empty array."""
    f = findings.where(F.size("spans") > 0).select(F.col("blob").alias("_blob"), F.col("spans"))
    return paths.join(f, F.col("blob") == F.col("_blob"), "left").drop("_blob").withColumn(
        "spans", F.coalesce("spans", F.expr(f"cast(array() as array<{SPAN}>)"))
    )


def spans_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def document_findings(docs: DataFrame, ledger: str | None = None) -> DataFrame:
    """One row per document: counts by kind, the spans, and a digest of them.  ``ledger``: as in ``scan_increment``; one for this run without it."""
    paths = docs.select("doc_id", blob_of(F.col("text")).alias("blob"))
    found = to_paths(paths, scan_increment(docs, ledger or scratch_ledger(docs.sparkSession)))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.withColumn("t", spans_text(F.col("spans"))).select(
        "doc_id", *[count(k[0]) for k in KINDS], F.sha2("t", 256).alias("base_sha256"), F.col("t").alias("spans")
    )


def kept_parts(findings: DataFrame) -> DataFrame:
    """``blob parts`` of blobs with spans: what lies between their spans as (start, length), where overlapping and touching spans are one;
    the length of the last part is that of the longest text."""
    rows = findings.where(F.size("spans") > 0).select("blob", F.posexplode("spans").alias("k", "s")).select("blob", "k", "s.start", "s.end")
    before = Window.partitionBy("blob").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("at", F.coalesce(F.max("end").over(before), F.lit(0)))
    part = F.struct("k", F.col("at").alias("start"), (F.col("start") - F.col("at")).alias("n"))
    apart = (F.col("start") > F.col("at")) | (F.col("k") == 0)
    parts = rows.groupBy("blob").agg(F.sort_array(F.collect_list(F.when(apart, part))).alias("parts"), F.max("end").alias("last"))
    rest = F.struct(F.lit(2**31 - 1).alias("k"), F.col("last").alias("start"), F.lit(2**31 - 1).cast("long").alias("n"))
    return parts.select("blob", F.concat("parts", F.array(rest)).alias("parts"))


#: Characters of a text that are cut out at once: a place in a string is found by reading up to it.
_STRIDE = 1 << 14


def joined_parts(text: Column, parts: Column, mark: str) -> Column:
    """``mark`` between the ``parts`` (start, n) of a text.  The text is cut into strides first, and each part out of its few strides."""
    n = F.length(text)
    strides = F.transform(F.sequence(F.lit(0), F.floor(n / _STRIDE).cast("int")), lambda b: F.substring(text, b * _STRIDE + 1, F.lit(_STRIDE)))

    def part(p: Column, cut: Column) -> Column:
        end = F.least(p["start"] + p["n"], cut["n"].cast("long"))
        first, last = F.floor(p["start"] / _STRIDE).cast("int"), F.floor((end - 1) / _STRIDE).cast("int")
        pieces = F.transform(F.sequence(first, last), lambda b: F.substring(
            F.element_at(cut["strides"], b + 1), (F.greatest(p["start"] - b * _STRIDE, F.lit(0)) + 1).cast("int"),
            (F.least(end - b * _STRIDE, F.lit(_STRIDE)) - F.greatest(p["start"] - b * _STRIDE, F.lit(0))).cast("int"),
        ))
        return F.when(end > p["start"], F.array_join(pieces, "")).otherwise(F.lit(""))

    # an array of one: a lambda's variable is worked out once, an expression inside a lambda for each of its elements
    once = F.array(F.struct(strides.alias("strides"), n.alias("n"), parts.alias("parts")))
    return F.transform(once, lambda cut: F.array_join(F.transform(cut["parts"], lambda p: part(p, cut)), mark))[0]


def redact_documents(docs: DataFrame, mark: str = "[SECRET]", ledger: str | None = None) -> DataFrame:
    """The rows of ``docs`` (all columns) with their secrets marked; ``n_chars``, if there, follows the new text.
    A null text stays null."""
    found = scan_increment(docs.select("text"), ledger or scratch_ledger(docs.sparkSession))
    parts = kept_parts(found).select(F.col("blob").alias("_hearth_blob"), F.col("parts").alias("_hearth_parts"))
    joined = docs.join(parts, blob_of(docs["text"]) == parts["_hearth_blob"], "left")
    hit = F.col("text").isNotNull() & F.col("_hearth_parts").isNotNull()
    new = joined.withColumn("text", F.when(hit, joined_parts(F.col("text"), F.col("_hearth_parts"), mark)).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        new = new.withColumn("n_chars", F.when(F.col("_hearth_parts").isNotNull(), F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return new.select(*docs.columns)


def _sql_kind(rank: int, kind: str, pattern: str, group: int, least: int) -> str:
    quoted = pattern.replace("'", "''")
    return f"""k{rank} AS (
  SELECT doc_key, unnest(range(1, len(w) + 1)) AS i, w, c, g FROM (
    SELECT doc_key, regexp_extract_all(text, '{quoted}', 0) AS w, regexp_extract_all(text, '{quoted}', {group}) AS c,
           string_split_regex(text, '{quoted}') AS g FROM d)),
s{rank} AS (SELECT doc_key, {rank} AS rank, '{kind}' AS kind,
    list_sum([length(x) FOR x IN g[1:i]]) + coalesce(list_sum([length(x) FOR x IN w[1:i - 1]]), 0) AS start, length(w[i]) AS n
  FROM k{rank} WHERE length(c[i]) >= {least})"""


#: DuckDB SQL for ``document_findings`` over the table ``documents``.
SQL = f"""
WITH d AS (SELECT row_number() OVER () AS doc_key, doc_id, coalesce(text, '') AS text FROM documents),
{', '.join(_sql_kind(i, *k) for i, k in enumerate(KINDS))},
a AS ({' UNION ALL '.join(f'SELECT * FROM s{i}' for i in range(len(KINDS)))}),
j AS (SELECT doc_key, string_agg(kind || ':' || start::BIGINT || ':' || (start + n)::BIGINT, ',' ORDER BY start, rank) AS t,
  {', '.join(f"count(*) FILTER (WHERE rank = {i}) AS n_{k[0]}" for i, k in enumerate(KINDS))} FROM a GROUP BY doc_key)
SELECT doc_id, {', '.join(f'coalesce(n_{k[0]}, 0)::BIGINT AS n_{k[0]}' for k in KINDS)},
  sha256(coalesce(t, '')) AS base_sha256, coalesce(t, '') AS spans
FROM d LEFT JOIN j USING (doc_key)
"""
