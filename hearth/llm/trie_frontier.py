"""Spelling variants by a relational trie frontier.

Words are the maximal runs of letters (``RUN``) of the lower-cased texts with at least ``LEAST`` code points and
``OFTEN`` occurrences.  Two words are near if one insertion, deletion or replacement of a code point turns one
into the other.  A word's form is its most frequent near word, if that is at least ``FIRMER`` times as frequent;
its root is where its forms end.

The vocabulary is a trie, kept as a distributed table of edges ``(depth, parent, ch, child | tail word n)``:

* words are sorted over range partitions, and each one names only the nodes that it does not share with the word
  before it, so every edge is made once and without a shuffle;
* below the last node that a word shares, its remaining letters are one ``tail``; the end of a word is an edge of
  its own (``ch = ''``).

States are ``(x, y)``: the word at its position and the node, where a word at a position is its prefix, so words that
share the prefix share the state.  The frontier goes down level by level.  At each level it takes in the states
that make their one edit there: pairs of sibling edges (replacement) and a child with its parent (deletion, which
read from the other side is an insertion).  Existing states have no edit left: both sides move along edges of the
same letter, two joins with the edges of that depth.  A state ends when both sides are single words, and
its words are neighbours if their tails are equal.  A node has as many edges as there are letters, and a
prefix as many states as edits of it, so no key grows with the corpus.  A letter that repeats the deleted one does not
follow it (``bar``): deleting the later one is the same edit.

There is one level for each letter of the longest prefix that two words share; levels are written tables.  Nodes
are named by 64-bit hashes of their prefixes, so neighbours are confirmed on the words themselves.

Defined cases: null, empty and letterless texts have no word; a null doc_id counts as the empty text in the damage rule;
repeated rows count again; ties of frequency go to the smallest word in code-point order; words may have any
length; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from operator import itemgetter
from os.path import commonprefix

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import checkpoint, id_text, rows_of, ship, stored

LEAST, OFTEN, FIRMER = 6, 5, 5
#: One of so many (document, word) pairs loses a letter, by crc32 of ``<doc_id>:<word>``.
DAMAGED = 199
#: Words that a task counts before it passes them on.
HELD = 200_000
RUN = re.compile(f"[a-zÀ-ÿ]{{{LEAST},}}")  # in text whose A-Z are lower-cased
SIDE = ("node", "tail", "word", "n")
STATE = [f"{s}_{c}" for s in "xy" for c in SIDE]


def damaged(word: str, crc: int) -> str:
    """The word, without one letter where the contract's rule says so."""
    if crc % DAMAGED:
        return word
    at = crc % len(word)
    return word[:at] + word[at + 1 :]


def word_counts(docs: DataFrame, change: Callable[[str, int], str] = damaged) -> DataFrame:
    """``word n`` of all words of ``docs`` (``doc_id text``) with their occurrences; ``change`` gives the word that counts
    from a run and its crc32 with the doc_id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}
        batch = lambda: pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])
        for b in rows_of(batches):
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                lowered = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")  # bytes: A-Z only
                seed = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for run_, n in Counter(map(itemgetter(0), RUN.finditer(lowered))).items():
                    w = change(run_, zlib.crc32(run_.encode(), seed))
                    if len(w) >= LEAST:
                        counts[w] = counts.get(w, 0) + n
                if len(counts) >= HELD:
                    yield batch()
                    counts = {}
        yield batch()

    ship(docs.sparkSession)
    return docs.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _node(prefix: xxhash.xxh64) -> int:
    """A node's number, signed."""
    v = prefix.intdigest()
    return v - (1 << 64) if v >> 63 else v


def _edges_of(word: str, n: int, before: int, after: int) -> Iterator[tuple]:
    """The word's edges that the word before it does not have.  ``before``, ``after``: letters shared with its neighbours."""
    own = max(before, after)
    name = xxhash.xxh64(word[:before].encode("utf-32-le"))
    parent = _node(name)
    for k in range(before, after):
        name.update(word[k].encode("utf-32-le"))
        child = _node(name)
        yield k, parent, word[k], child, None, None, None
        parent = child
    yield own, parent, word[own : own + 1], None, word[own + 1 :], word, n


def edges(vocabulary: DataFrame) -> DataFrame:
    """The trie's edges ``depth parent ch child tail word n`` of ``word n`` (each word once)."""
    spark = vocabulary.sparkSession
    ship(spark)
    ordered = vocabulary.repartitionByRange("word").sortWithinPartitions("word").select("word", "n", F.spark_partition_id().alias("part"))
    ordered = checkpoint(ordered, spark)
    # the first and last word of each partition: what its neighbours need to know
    ends = sorted(tuple(r) for r in ordered.groupBy("part").agg(F.min("word"), F.max("word")).collect())
    around = {p: (ends[k - 1][2] if k else "", ends[k + 1][1] if k + 1 < len(ends) else "") for k, (p, _, _) in enumerate(ends)}
    names = ["depth", "parent", "ch", "child", "tail", "word", "n"]
    types = [pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        last, before, part = None, 0, None
        for b in batches:
            for word, n, part in zip(*(b.column(c).to_pylist() for c in ("word", "n", "part"))):
                shared = len(commonprefix([last[0] if last else around[part][0], word]))
                if last:
                    out += _edges_of(*last, before, shared)
                last, before = (word, n), shared
            if len(out) >= 1 << 14:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
                out = []
        if last:
            out += _edges_of(*last, before, len(commonprefix([last[0], around[part][1]])))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    return ordered.mapInArrow(run, "depth int, parent long, ch string, child long, tail string, word string, n long")


def _ordered(states: DataFrame) -> DataFrame:
    """States with a single word, if they have one, on the x side; those of two words only if their tails are equal."""
    swap = F.col("x_node").isNotNull() & F.col("y_node").isNull()
    sides = [F.when(swap, F.col(f"{o}_{c}")).otherwise(F.col(f"{s}_{c}")).alias(f"{s}_{c}") for s, o in ("xy", "yx") for c in SIDE]
    return states.where("x_node is not null or y_node is not null or x_tail = y_tail").select(*sides, "bar")


def _side(s: str, e: DataFrame) -> list[Column]:
    return [F.col("child").alias(f"{s}_node"), *[F.col(c).alias(f"{s}_{c}") for c in SIDE[1:]]]


def neighbours(trie: DataFrame) -> DataFrame:
    """``word n near near_n``: all pairs of near words, both ways, each once.  ``trie``: a stored table of ``edges``."""
    spark = trie.sparkSession
    deepest = trie.agg(F.max("depth")).first()[0]
    no = lambda t: F.lit(None).cast(t)
    none = trie.limit(0).select(*_side("x", trie), *_side("y", trie), no("string").alias("bar"))
    frontier, found = none, none
    for depth in range(0 if deepest is None else deepest + 1):
        here = trie.where(F.col("depth") == depth)
        letters = here.where("ch <> ''")
        deleted = letters.select(*_side("x", here), F.col("parent").alias("y_node"), no("string").alias("y_tail"), no("string").alias("y_word"), no("long").alias("y_n"), F.col("ch").alias("bar"))
        left = letters.select("parent", F.col("ch").alias("x_ch"), *_side("x", here))
        right = letters.select("parent", F.col("ch").alias("y_ch"), *_side("y", here))
        replaced = left.join(right, "parent").where("x_ch < y_ch").select(*STATE, no("string").alias("bar"))
        states = frontier.union(deleted)
        # the side that lost a letter is one level deeper, and it may be either.  x moves: a shared node along each
        # of its edges, a single word along its tail
        below = trie.where(F.col("depth").isin(depth, depth + 1)).select(F.col("parent").alias("x_node"), "ch", F.col("child"), "tail", "word", "n")
        y = ["y_node", "bar"]
        many = states.where("x_node is not null").select("x_node", *y).join(below, "x_node").select("ch", *_side("x", below), *y)
        single = states.where("x_node is null").select(
            F.substring("x_tail", 1, 1).alias("ch"), no("long").alias("x_node"), F.expr("substring(x_tail, 2)").alias("x_tail"), "x_word", "x_n", *y
        )
        moved = many.union(single).where("bar is null or ch <> bar").drop("bar")
        # y follows along the same letter
        follow = trie.where(F.col("depth").isin(depth, depth + 1)).select(F.col("parent").alias("y_node"), "ch", *[F.col(c).alias(f"to_{c}") for c in ("child", *SIDE[1:])])
        moved = moved.join(follow, ["y_node", "ch"]).select(
            *STATE[:4], F.col("to_child").alias("y_node"), *[F.col(f"to_{c}").alias(f"y_{c}") for c in SIDE[1:]], no("string").alias("bar")
        )
        level = stored(_ordered(moved.union(replaced)), spark, "level")  # a table: a checkpoint keeps what Spark knows of its columns, which doubles by level
        found = found.union(level.where("x_node is null and y_node is null"))
        frontier = level.where("y_node is not null")
    one = found.where(F.levenshtein("x_word", "y_word", 1) == 1).select("x_word", "x_n", "y_word", "y_n")
    return one.union(one.select("y_word", "y_n", "x_word", "x_n")).distinct().toDF("word", "n", "near", "near_n")


def variants(vocabulary: DataFrame) -> DataFrame:
    """``word form root n n_near form_n`` of ``word n``: every word with its form and root."""
    spark = vocabulary.sparkSession
    trie = stored(edges(vocabulary).repartitionByRange("depth", "parent"), spark, "trie")
    best = neighbours(trie).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("best"))
    known = vocabulary.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.col("best.near").alias("near"), (-F.col("best.m")).alias("near_n"))
    firm = F.col("near_n") >= F.col("n") * FIRMER
    known = checkpoint(known.select("word", "n", "n_near", F.when(firm, F.col("near")).alias("form"), F.when(firm, F.col("near_n")).alias("form_n")), spark)
    # forms grow by FIRMER at each step, so chains are short and have no circle; each round doubles what a pointer spans
    root = known.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        step = checkpoint(root.join(root.toDF("root", "_next"), "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")), spark)
        root = step.select("word", "root")
        if step.where("moved").isEmpty():
            break
    return known.join(root, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", change: Callable[[str, int], str] = damaged) -> DataFrame:
    """``variants`` of the words of ``docs`` that occur at least ``OFTEN`` times."""
    docs = id_text(docs, id_col, text_col)
    return variants(stored(word_counts(docs, change).where(F.col("n") >= OFTEN), docs.sparkSession, "vocabulary"))


#: Unsigned crc32 in DuckDB of a list of byte values, bit by bit.
CRC32 = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform({bytes}, lambda b: [b, 0, 0, 0, 0, 0, 0, 0]))),
    lambda c, e: xor(xor(c, e) >> 1, 3988292384 * (xor(c, e) & 1))))"""
_BYTES = """flatten(list_transform(range(1, length(t) + 1), lambda i: CASE WHEN unicode(substring(t, i, 1)) < 128 THEN [unicode(substring(t, i, 1))::BIGINT]
    ELSE [195::BIGINT, (unicode(substring(t, i, 1)) - 64)::BIGINT] END))"""
#: DuckDB SQL for ``spelling_variants`` over the table ``documents``.
SQL = f"""
WITH RECURSIVE runs AS (SELECT coalesce(doc_id::VARCHAR, '') AS d,
    unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS w FROM documents),
pairs AS (SELECT d, w, count(*) AS n, d || ':' || w AS t FROM runs WHERE length(w) >= {LEAST} GROUP BY d, w),
marked AS (SELECT w, n, {CRC32.format(bytes=_BYTES)} AS h FROM pairs),
words AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM (SELECT n, CASE WHEN h % {DAMAGED} = 0
    THEN substring(w, 1, h % length(w)) || substring(w, h % length(w) + 2) ELSE w END AS word FROM marked)
  WHERE length(word) >= {LEAST} GROUP BY word HAVING sum(n) >= {OFTEN}),
cut AS MATERIALIZED (SELECT word, n, i, substring(word, 1, i - 1) || substring(word, i + 1) AS k FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.k = b.k AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM cut a JOIN words b ON a.k = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM cut a JOIN words b ON a.k = b.word),
ranked AS (SELECT *, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS r FROM near),
known AS MATERIALIZED (SELECT word, words.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN near_n >= {FIRMER} * words.n THEN near END AS form,
    CASE WHEN near_n >= {FIRMER} * words.n THEN near_n END AS form_n FROM words LEFT JOIN (SELECT * EXCLUDE (n) FROM ranked WHERE r = 1) USING (word)),
walk AS (SELECT word, coalesce(form, word) AS root FROM known UNION SELECT walk.word, known.form FROM walk JOIN known ON known.word = walk.root WHERE known.form IS NOT NULL)
SELECT known.word, known.form, walk.root, known.n, known.n_near, known.form_n
FROM known JOIN walk USING (word) JOIN known t ON t.word = walk.root WHERE t.form IS NULL
"""
