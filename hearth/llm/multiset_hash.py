"""Document fingerprints by a homomorphic multiset hash (native).

A document is a multiset of paragraphs (here: pieces that end with a sentence
mark or a line break, so their concatenation is the text).  Every paragraph is
hashed with SHA-256 to a wide vector:

* eight 32-bit lanes, the digest itself, added modulo 2**32.  Two texts with
  equal multisets of paragraphs have equal lanes in any order; others differ
  but for a collision of the sums;
* ``BUCKETS`` signed counters (one of them moves by +1 or -1 per paragraph),
  added modulo 2**32.  Their inner product estimates how many paragraphs two
  documents share, so ``likeness`` needs the fingerprints alone.

Adding is all that happens, so ``insert`` and ``delete`` of a batch of
paragraphs are vector additions and subtractions on stored fingerprints.

Defined cases: null text counts as empty; an empty text has no paragraph and
the zero vector; two zero vectors are alike (1.0), a zero vector and another
are not (0.0); repeated paragraphs count as often as they occur; rows that
repeat a doc_id are kept as rows of their own; columns besides id and text are
ignored.  No Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LANES = 8
BUCKETS = 64
MODULUS = 1 << 32
#: A paragraph: up to and with sentence marks, line breaks and the spaces after them, or the rest of the text.
PARAGRAPH = r"[^.!?\n]*[.!?\n][.!?\n ]*|[^.!?\n]+"
#: Rows that one window partition of ``next_document`` holds at most, for distinct ids.
RUN = 256

_LANE = [f"l{i}" for i in range(LANES)]
_BUCKET = [f"b{i}" for i in range(BUCKETS)]


def paragraphs(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(PARAGRAPH), F.lit(0))


def _hex_number(digest: Column, start: int, digits: int) -> Column:
    return F.conv(F.substring(digest, start, digits), 16, 10).cast("long")


def vectors(pieces: DataFrame, keys: list[str], paragraph: str = "paragraph") -> DataFrame:
    """Sum the vectors of exploded paragraphs by ``keys`` (null paragraph: none).  The sums are built
    before the shuffle, so a document with very many paragraphs sends one row per task."""
    hashed = pieces.select(*keys, F.sha2(F.col(paragraph), 256).alias("digest"))
    lanes = [F.sum(_hex_number(F.col("digest"), 1 + 8 * i, 8)) for i in range(LANES)]
    place = hashed.select(
        *keys,
        "digest",
        (_hex_number(F.col("digest"), 1, 2) % BUCKETS).alias("_bucket"),
        F.when(_hex_number(F.col("digest"), 3, 1) < 8, F.lit(1)).otherwise(F.lit(-1)).cast("long").alias("_sign"),
    )
    buckets = [F.sum(F.when(F.col("_bucket") == i, F.col("_sign")).otherwise(F.lit(0).cast("long"))) for i in range(BUCKETS)]
    sums = place.groupBy(*keys).agg(
        *[F.coalesce(s, F.lit(0)).alias(n) for n, s in zip(_LANE, lanes)],
        *[F.coalesce(s, F.lit(0)).alias(n) for n, s in zip(_BUCKET, buckets)],
    )
    return sums.select(*keys, F.array(*[_mod(F.col(c)) for c in _LANE + _BUCKET]).alias("vector"))


def _mod(c: Column) -> Column:
    return F.pmod(c, F.lit(MODULUS).cast("long"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, vector)`` of every document, empty ones included.  Rows with the same id are added up, as the
    hash of the multiset of all their paragraphs."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    return vectors(rows.select("id", F.explode_outer(paragraphs(F.col("text"))).alias("paragraph")), ["id"])


def insert(vector: Column, added: Column) -> Column:
    """The fingerprint after the paragraphs of ``added`` came in."""
    return F.zip_with(vector, added, lambda a, b: _mod(a + b))


def delete(vector: Column, removed: Column) -> Column:
    """The fingerprint after the paragraphs of ``removed`` went out."""
    return F.zip_with(vector, removed, lambda a, b: _mod(a - b))


def as_text(vector: Column) -> Column:
    """Lanes as 64 hex digits, then the counters."""
    lanes = F.transform(F.slice(vector, 1, LANES), lambda x: F.lpad(F.lower(F.hex(x)), 8, "0"))
    return F.concat(F.array_join(lanes, ""), F.lit(":"), F.array_join(F.slice(vector, LANES + 1, BUCKETS), "."))


def _dot(a: Column, b: Column) -> Column:
    def signed(v: Column) -> Column:
        return F.when(v >= MODULUS // 2, v - MODULUS).otherwise(v).cast("double")

    products = F.zip_with(F.slice(a, LANES + 1, BUCKETS), F.slice(b, LANES + 1, BUCKETS), lambda x, y: signed(x) * signed(y))
    return F.aggregate(products, F.lit(0.0), lambda t, x: t + x)


def likeness(a: Column, b: Column) -> Column:
    """0 to 1 from the two fingerprints: 1 for equal ones, else the cosine of the signed counters, at least 0."""
    lanes_equal = F.slice(a, 1, LANES) == F.slice(b, 1, LANES)
    size = _dot(a, a) * _dot(b, b)
    cosine = F.when(size > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), _dot(a, b) / F.sqrt(size)))).otherwise(F.lit(0.0))
    return F.when(lanes_equal & (a == b), F.lit(1.0)).otherwise(cosine)


def next_document(docs: DataFrame) -> DataFrame:
    """``doc_id text`` with ``run pos`` (a key of the row) and the next row's ``next_text next_run next_pos``
    by descending doc_id (repeated ids: by descending text; a null id last); after the last row the first follows.

    Ids are cut into runs of ``RUN``; each run is ordered in its own window
    partition, and the last row of a run takes the head of the next run that
    has rows.  Texts are shuffled once, heads are one row per run.
    """
    run = F.coalesce(F.floor(F.col("doc_id") / RUN).cast("long"), F.lit(-(1 << 62)))
    rows = docs.select("doc_id", "text", run.alias("run"))
    heads = rows.groupBy("run").agg(F.max(F.struct(F.coalesce(F.col("doc_id"), F.lit(-(1 << 62))).alias("i"), F.col("text").alias("t")))["t"].alias("head"))
    order = Window.orderBy(F.col("run").desc())
    every = Window.partitionBy()
    runs = heads.select("run").withColumn("following", F.lead("run").over(order)).withColumn("following", F.coalesce("following", F.max("run").over(every)))
    joined = runs.join(heads.select(F.col("run").alias("following"), "head"), "following")
    in_run = Window.partitionBy("run").orderBy(F.col("doc_id").desc_nulls_last(), F.col("text").desc())
    placed = (
        rows.withColumn("pos", F.row_number().over(in_run))
        .withColumn("in_run_next", F.lead("text").over(in_run))
        .join(joined, "run")
    )
    inside = F.col("in_run_next").isNotNull()
    return placed.select(
        "doc_id", "text", "run", "pos",
        F.coalesce("in_run_next", "head").alias("next_text"),
        F.when(inside, F.col("run")).otherwise(F.col("following")).alias("next_run"),
        F.when(inside, F.col("pos") + 1).otherwise(F.lit(1)).alias("next_pos"),
    )


def edited_documents(docs: DataFrame) -> DataFrame:
    """One row per document: its fingerprint, that of its edited text, and both likenesses.

    Edited: the last ``floor(n_chars / 2)`` code points give way to the first
    as many (or all) of the next document's text.
    """
    half = F.floor(F.length("text") / 2).cast("int")
    near = next_document(docs).withColumn(
        "edited", F.concat(F.expr("left(text, length(text) - cast(floor(length(text) / 2) as int))"), F.substring(F.col("next_text"), F.lit(1), half))
    )
    keys = ["run", "pos", "doc_id", "next_run", "next_pos", "n_chars", "edited_sha256"]
    both = near.select(
        "run", "pos", "doc_id", "next_run", "next_pos",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        F.explode(F.array(F.struct(F.lit(False).alias("is_edited"), F.col("text").alias("t")), F.struct(F.lit(True).alias("is_edited"), F.col("edited").alias("t")))).alias("v"),
    )
    pieces = both.select(*keys, "v.is_edited", F.explode_outer(paragraphs(F.col("v.t"))).alias("paragraph"))
    sums = vectors(pieces, [*keys, "is_edited"])
    own = sums.groupBy(*keys).agg(
        F.max(F.when(~F.col("is_edited"), F.col("vector"))).alias("vector"),
        F.max(F.when(F.col("is_edited"), F.col("vector"))).alias("edited_vector"),
    )
    following = own.select(F.col("run").alias("next_run"), F.col("pos").alias("next_pos"), F.col("vector").alias("next_vector"))
    return own.join(following, ["next_run", "next_pos"]).select(
        "doc_id", "n_chars", "edited_sha256",
        as_text(F.col("vector")).alias("fingerprint"),
        as_text(F.col("edited_vector")).alias("edited_fingerprint"),
        likeness(F.col("vector"), F.col("edited_vector")).alias("near_edited"),
        likeness(F.col("vector"), F.col("next_vector")).alias("near_next"),
    )


#: DuckDB SQL for ``edited_documents`` over the table ``documents``.
SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER (ORDER BY doc_id DESC NULLS LAST, text DESC) AS r, count(*) OVER () AS c FROM documents),
n AS (SELECT d.r, d.r % d.c + 1 AS nr, d.doc_id, d.text, length(d.text) AS n_chars,
       left(d.text, length(d.text) - length(d.text) // 2) || left(e.text, length(d.text) // 2) AS edited
     FROM d JOIN d AS e ON e.r = d.r % d.c + 1),
p AS (SELECT r, 0 AS w, unnest(regexp_extract_all(text, '{PARAGRAPH}', 0)) AS p FROM n
      UNION ALL SELECT r, 1, unnest(regexp_extract_all(edited, '{PARAGRAPH}', 0)) FROM n),
h AS (SELECT r, w, sha256(p) AS s FROM p),
x AS (SELECT r, w, s, ('0x' || s[1:2])::BIGINT % {BUCKETS} AS b, CASE WHEN ('0x' || s[3:3])::BIGINT < 8 THEN 1 ELSE -1 END AS g FROM h),
lanes AS (SELECT r, w, {', '.join(f"sum(('0x' || s[{1 + 8 * i}:{8 + 8 * i}])::BIGINT)::HUGEINT % {MODULUS} AS l{i}" for i in range(LANES))},
          {', '.join(f'sum(CASE WHEN b = {i} THEN g ELSE 0 END)::BIGINT AS b{i}' for i in range(BUCKETS))} FROM x GROUP BY r, w),
f AS (SELECT n.r, k.w, [{', '.join(f'coalesce(l{i}, 0)::BIGINT' for i in range(LANES))}] AS l, [{', '.join(f'coalesce(b{i}, 0)' for i in range(BUCKETS))}] AS b
      FROM n CROSS JOIN (SELECT unnest([0, 1]) AS w) k LEFT JOIN lanes ON lanes.r = n.r AND lanes.w = k.w),
t AS (SELECT r, w, l, b, array_to_string([lpad(lower(to_hex(z)), 8, '0') FOR z IN l], '') || ':' || array_to_string([(z + {MODULUS}) % {MODULUS} FOR z IN b], '.') AS s, [z::DOUBLE FOR z IN b] AS v FROM f),
a AS (SELECT n.*, o.s AS fingerprint, e.s AS edited_fingerprint, o.v AS ov, e.v AS ev, q.v AS qv, q.s AS qs
      FROM n JOIN t AS o ON o.r = n.r AND o.w = 0 JOIN t AS e ON e.r = n.r AND e.w = 1 JOIN t AS q ON q.r = n.nr AND q.w = 0),
c AS (SELECT *, list_dot_product(ov, ov) AS oo, list_dot_product(ev, ev) AS ee, list_dot_product(qv, qv) AS qq, list_dot_product(ov, ev) AS oe, list_dot_product(ov, qv) AS oq FROM a)
SELECT doc_id, n_chars::BIGINT AS n_chars, sha256(edited) AS edited_sha256, fingerprint, edited_fingerprint,
  CASE WHEN fingerprint = edited_fingerprint THEN 1.0 WHEN oo * ee > 0 THEN greatest(0.0, least(1.0, oe / sqrt(oo * ee))) ELSE 0.0 END::DOUBLE AS near_edited,
  CASE WHEN fingerprint = qs THEN 1.0 WHEN oo * qq > 0 THEN greatest(0.0, least(1.0, oq / sqrt(oo * qq))) ELSE 0.0 END::DOUBLE AS near_next
FROM c
"""
