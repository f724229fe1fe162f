"""Benchmark decontamination: size-partitioned MinHash containment search (native).

A benchmark item is contaminated by a document that holds at least
``THRESHOLD`` of the item's distinct five-word shingles.  Items are
partitioned by their number of shingles n; an item's sketch is its
``k = floor((1 - THRESHOLD) * n) + 1`` smallest shingle hashes, so k grows
with the size partition.  A document that holds the threshold's share of an
item misses fewer than k of its shingles, hence it holds one of any k of them:
a hit in the sketch is a necessary condition however long the document is, and
no pair is lost (a plain MinHash of a long document would drown a short item).
Pairs with a hit are verified by exact containment: the item's other shingles
ride along in the same scan, and the distinct ones found are counted.

Only item shingles are broadcast, and only below ``BROADCAST_ROWS`` fixed-size
rows (three longs each); a larger benchmark is joined by shuffle.  Hits are
counted per (document, text, item), so a passage that a third of the documents
share spreads over as many keys.

Words: A-Z lower-cased, separated by space and U+0009 to U+000D; with fewer
than five words the whole sequence is one shingle, without words there is none.

Defined cases: null or empty texts and items have no shingle and match
nothing; a repeated (doc_id, text) row counts once, rows that share a doc_id
but not the text are searched apart; repeated item_ids with the same text count
once; empty tables give no rows; other columns are ignored.  No Python runs on
the executors.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS_PER_SHINGLE = 5
#: In hundredths.
THRESHOLD = 80
BROADCAST_ROWS = 200_000
SEPARATOR = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.filter(F.split(lowered, SEPARATOR), lambda w: w != "")


def _with_hashes(rows: DataFrame, *keep: str) -> DataFrame:
    """Word hashes become a column of their own first: the windows then read them and not the words again.
    Callers explode with ``explode_outer``: ``explode`` would put a filter on the array's size under the scan,
    and the whole expression would be worked out there a second time for each window."""
    h = rows.select(*keep, F.transform(words(F.col("text")), lambda w: F.xxhash64(w)).alias("h"))
    n = WORDS_PER_SHINGLE
    few = F.when(F.size("h") > 0, F.array(F.xxhash64("h"))).otherwise(F.expr("cast(array() as array<bigint>)"))
    window = lambda i: F.xxhash64(*[F.get("h", i + k) for k in range(n)])
    many = F.transform(F.sequence(F.lit(0), F.size("h") - n), window)
    return h.select(*keep, F.when(F.size("h") < n, few).otherwise(many).alias("shingles"))


def item_sketches(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """``item_id n_shingles hash in_sketch``: an item's distinct shingles, the k smallest marked."""
    rows = benchmark.select(F.col(f"`{item_col}`").alias("item_id"), F.col(f"`{text_col}`").alias("text")).distinct()
    rows = rows.withColumn("item_text", F.xxhash64("text"))
    sets = _with_hashes(rows, "item_id", "item_text").select("item_id", "item_text", F.sort_array(F.array_distinct("shingles")).alias("s"))
    n = F.size("s")
    depth = F.floor((100 - threshold) * n / 100).cast("int") + 1
    return sets.select("item_id", "item_text", n.cast("long").alias("n_shingles"), depth.alias("depth"), F.posexplode_outer("s").alias("at", "hash")).where(F.col("hash").isNotNull()).select(
        "item_id", "item_text", "n_shingles", "hash", (F.col("at") < F.col("depth")).alias("in_sketch")
    )


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """``doc_id item_id n_shingles n_shared containment`` of every pair at or over the threshold.

    docs: ``doc_id text``; benchmark: ``item_id text``.  Runs one small job over
    the benchmark alone to see whether its shingles may be broadcast.
    """
    return _pairs(docs, benchmark, threshold).groupBy("doc_id", "item_id").agg(
        F.max(F.struct("containment", "n_shared", "n_shingles")).alias("m")
    ).select("doc_id", "item_id", "m.n_shingles", "m.n_shared", "m.containment")


def _pairs(docs: DataFrame, benchmark: DataFrame, threshold: int) -> DataFrame:
    items = item_sketches(benchmark, threshold=threshold)
    bounded = items.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    rows = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"))
    exploded = _with_hashes(rows, "doc_id", "text_key").select("doc_id", "text_key", F.explode_outer("shingles").alias("hash"))
    hits = exploded.join(F.broadcast(items) if bounded else items, "hash")
    return (
        hits.groupBy("doc_id", "text_key", "item_id", "item_text")
        .agg(F.size(F.collect_set("hash")).cast("long").alias("n_shared"), F.max("in_sketch").alias("candidate"), F.max("n_shingles").alias("n_shingles"))
        .where(F.col("candidate") & (F.col("n_shared") * 100 >= F.col("n_shingles") * threshold))
        .withColumn("containment", F.col("n_shared") / F.col("n_shingles"))
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` (all columns) that contaminate no item."""
    bad = _pairs(docs, benchmark, threshold).select(F.col("doc_id").alias("_bad_id"), F.col("text_key").alias("_bad_text")).distinct()
    here = F.xxhash64(F.coalesce("text", F.lit("")))
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["_bad_id"]) & (here == bad["_bad_text"]), "left_anti")


_LOWERED = r"translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def sql_shingles(table: str, key: str) -> str:
    """Rows ``key s`` of the distinct shingles of a table, as text."""
    return rf"""SELECT DISTINCT {key}, CASE WHEN n < 5 THEN all_words ELSE concat_ws(' ', w, w1, w2, w3, w4) END AS s FROM (
      SELECT {key}, w, pos, count(*) OVER r AS n, string_agg(w, ' ') FILTER (WHERE pos < 5) OVER r AS all_words,
             lead(w, 1) OVER o AS w1, lead(w, 2) OVER o AS w2, lead(w, 3) OVER o AS w3, lead(w, 4) OVER o AS w4
      FROM (SELECT {key}, rid, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS pos FROM (
              SELECT {key}, row_number() OVER () AS rid, regexp_extract_all({_LOWERED}, '[^\x20\x09-\x0D]+') AS ws FROM {table}))
      WINDOW o AS (PARTITION BY rid ORDER BY pos), r AS (PARTITION BY rid ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
      WHERE w4 IS NOT NULL OR n < 5"""


#: DuckDB SQL for ``contaminated`` over ``documents`` and ``benchmark``.
SQL = f"""
WITH i AS ({sql_shingles('benchmark', 'item_id')}), n AS (SELECT item_id, count(*) AS n_shingles FROM i GROUP BY item_id),
d AS ({sql_shingles('documents', 'doc_id')}),
m AS (SELECT doc_id, item_id, count(*) AS n_shared FROM d JOIN i USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_shingles::BIGINT AS n_shingles, n_shared::BIGINT AS n_shared, n_shared / n_shingles AS containment
FROM m JOIN n USING (item_id) WHERE n_shared * 100 >= {THRESHOLD} * n_shingles
"""
