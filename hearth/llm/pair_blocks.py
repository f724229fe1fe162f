"""Links between the components of shared lists.

Joins by lists (buckets, prefix shingles) first link most of a list's members through few pairs.
What is left are pairs between components, and a list with one large component and many others
has as many of them as the product.  Here they are told apart inside tasks, and no pair becomes a row
unless it joins two components:

* bitmaps rule most pairs out: a set's bitmap has 2 to 4 places a hash and tells whether a place holds an odd number of hashes; a place
  where x and y differ holds a hash that one of them lacks, so they share at most half of ``|x| + |y|`` less the number of such places;
* a list's members come in blocks of ``BLOCK`` rows, every two blocks of a list once, so a list of any length
  is split over tasks;
* lists of two members are left out: the first round held one against the other;
* members of a list's largest component are not compared with each other, nor any two of one component;
* pairs that the bound allows tie their members into crowds: a task gives one row a member, not one a pair, and a
  member of many lists is in one crowd;
* in a crowd, members outside its largest component meet all others on whole sets, in blocks bounded by rows and bytes.
  A link that joins two components of a block becomes a row, others of the same components do not.

No link that would join two components is lost: the bound holds for every bitmap size, each pair that it allows has both
members in one crowd, and counts are of whole sets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import checkpoint, grouped, rows_of
from hearth.llm.components import components

BLOCK = 1024
#: Hashes of a block of whole sets, about (16 MB), where its rows are not fewer.
HASHES = 1 << 21
#: Least and most places of a bitmap: a block of the longest sets takes 32 MB.
LEAST, MOST = 64, 1 << 18


def bitmap(s: np.ndarray) -> bytes:
    """A set of 64-bit hashes as a bitmap of 2 to 4 places a hash, set where their number is odd (a power of two, ``MOST`` for very large sets, whose bound is weaker)."""
    places = min(MOST, max(LEAST, 2 << max(len(s) - 1, 0).bit_length()))
    held = np.bincount((s.view(np.uint64) & np.uint64(places - 1)).astype(np.int64), minlength=places)
    return np.packbits((held & 1).astype(np.uint8), bitorder="little").tobytes()


def _folded(rows: np.ndarray) -> np.ndarray:
    """Bitmaps of half the places, which hold the same hashes."""
    half = rows.shape[1] // 2
    return rows[:, :half] ^ rows[:, half:]


def may_link(x: np.ndarray, n: int, others: np.ndarray, sizes: np.ndarray, threshold: int) -> np.ndarray:
    """Whether the set of ``n`` hashes with the bitmap ``x`` can reach the threshold with each of ``others`` (rows of as many words)."""
    twice = n + sizes - np.bitwise_count(x ^ others).sum(axis=1, dtype=np.int64)  # twice the hashes that they can share
    return twice * (100 + threshold) >= 2 * (n + sizes) * threshold


class _Rows:
    """The bitmaps of a block's rows by their number of words, also folded to fewer."""

    def __init__(self, bits: list[bytes]):
        words = np.array([len(b) // 8 for b in bits])
        self.of = [np.frombuffer(b, dtype=np.uint64) for b in bits]
        self.words = words
        self.at = {int(w): np.flatnonzero(words == w) for w in np.unique(words)}
        self.rows = {(w, w): np.stack([self.of[i] for i in at]) for w, at in self.at.items()}

    def folded(self, w: int, to: int) -> np.ndarray:
        if (w, to) not in self.rows:
            self.rows[w, to] = _folded(self.folded(w, to * 2))
        return self.rows[w, to]


def _compare(t: pa.Table, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    node, c, n, block = (t.column(k).to_numpy() for k in ("node", "c", "n", "block"))
    rows = _Rows(t.column("bits").to_pylist())
    same_block = t.column("i")[0].as_py() == t.column("j")[0].as_py()
    left, right = [], []
    for x in np.flatnonzero(c != t.column("top").to_numpy()).tolist():
        mine = rows.of[x][None, :]
        for w, at in rows.at.items():
            ok = (c[at] != c[x]) & (n[at] * 100 >= n[x] * threshold) & (n[x] * 100 >= n[at] * threshold)
            if not same_block:
                ok &= block[at] != block[x]
            k = np.flatnonzero(ok)
            if not len(k):
                continue
            to = min(w, mine.shape[1])
            own = mine
            while own.shape[1] > to:
                own = _folded(own)
            y = at[k[may_link(own[0], int(n[x]), rows.folded(w, to)[k], n[at[k]], threshold)]]
            left.append(np.minimum(node[x], node[y]))
            right.append(np.maximum(node[x], node[y]))
    none = np.zeros(0, dtype=np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def may_reach(pairs: DataFrame, facts: DataFrame, threshold: int) -> DataFrame:
    """The pairs ``a b`` that may reach the threshold by the bound of their bitmaps.  ``facts``: ``node n bits``; where a node has several
    sets, a pair stays if any of them allow it."""
    side = lambda s: facts.select(F.col("node").alias(s), F.col("n").alias(f"n_{s}"), F.col("bits").alias(f"bits_{s}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows_of(batches, 8 << 20):
            keep = []
            for n, m, x, y in zip(*(b.column(c).to_pylist() for c in ("n_a", "n_b", "bits_a", "bits_b"))):
                p, q = (np.frombuffer(v, dtype=np.uint64)[None, :] for v in (x, y))
                while p.shape[1] > q.shape[1]:
                    p = _folded(p)
                while q.shape[1] > p.shape[1]:
                    q = _folded(q)
                keep.append(bool(may_link(p[0], n, q, np.array([m]), threshold)[0]))
            m = pa.array(keep, type=pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column("a").filter(m), b.column("b").filter(m)], ["a", "b"])

    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "n_b", "bits_a", "bits_b")
    return both.mapInArrow(run, "a long, b long").distinct()


def _roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node of the pairs ``a b`` but the smallest that it is tied with, and that one: a row a node, however many the pairs."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while (root[x] != root[y]).any():
        p, q = root[x], root[y]
        np.minimum.at(root, np.maximum(p, q), np.minimum(p, q))
        while (root[root] != root).any():
            root = root[root]
    other = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[other], nodes[root[other]]


def ties(lists: DataFrame, label: DataFrame, facts: DataFrame, threshold: int) -> DataFrame:
    """Pairs ``a b`` that tie all nodes whose pairs may reach the threshold, where these are members of one list but of different
    components: each such pair has its nodes in one component of the result.  A task gives fewer rows than it reads."""
    placed = _placed(lists, label)
    parts = placed.groupBy("key", "c").agg(F.count(F.lit(1)).alias("m"))
    mixed = parts.groupBy("key").agg(F.max(F.struct("m", "c"))["c"].alias("top"), F.count(F.lit(1)).alias("parts"), F.sum("m").alias("m")).where("parts > 1 and m > 2")
    rows = placed.join(mixed.select("key", "top", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks")), "key").join(facts.select("node", "n", "bits"), "node")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).withColumn("w", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("key", F.least("block", "w").alias("i"), F.greatest("block", "w").alias("j"), "block", "node", "c", "top", "n", "bits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in grouped(batches, ["key", "i", "j"]):
            a, b = _compare(t, threshold)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in _roots(a, b)], ["a", "b"])

    return rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(run, "a long, b long").distinct()


def _placed(lists: DataFrame, label: DataFrame) -> DataFrame:
    """``key node c``: the members of lists with their components."""
    return lists.join(label.select("node", F.col("component").alias("_c")), "node", "left").select("key", "node", F.coalesce("_c", "node").alias("c"))


def _joining(t: pa.Table, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of components ``c`` that links between the rows of ``outer`` and the others, on whole sets, join: as few as join them all."""
    node, of, inner, outer = (t.column(k).to_numpy() for k in ("node", "c", "inner", "outer"))
    sets = [np.frombuffer(x, dtype=np.int64) for x in t.column("bytes").to_pylist()]
    n = np.array([len(s) for s in sets])
    _, c = np.unique(of, return_inverse=True)
    others = np.flatnonzero(~outer)
    if not len(others):
        return node[:0], node[:0]
    hashes, at = np.unique(np.concatenate([sets[y] for y in others]), return_inverse=True)
    at = dict(zip(others.tolist(), np.split(at.astype(np.int32), np.cumsum(n[others])[:-1])))
    left, right, has = [], [], np.zeros(len(hashes), dtype=bool)
    for x in np.flatnonzero(outer).tolist():
        ok = (c[others] != c[x]) & (inner[others] | (node[others] > node[x]))  # two outer rows meet in two blocks
        ok &= (n[others] * 100 >= n[x] * threshold) & (n[x] * 100 >= n[others] * threshold)
        y = others[ok]
        if not len(y):
            continue
        own = np.minimum(np.searchsorted(hashes, sets[x]), len(hashes) - 1)
        own = own[hashes[own] == sets[x]]
        has[own] = True
        both = np.array([np.count_nonzero(has[at[k]]) for k in y.tolist()])
        has[own] = False
        y = y[(100 * both >= threshold * (n[x] + n[y] - both)) & (both > 0)]
        joined, first = np.unique(c[y], return_index=True)
        left.append(np.full(len(first), of[x]))
        right.append(of[y[first]])
        c[np.isin(c, joined)] = c[x]
    none = np.zeros(0, dtype=np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def between_components(
    lists: DataFrame, label: DataFrame, facts: DataFrame, sets_of: Callable[[DataFrame], DataFrame], threshold: int, by: tuple[str, ...] = ("node",)
) -> DataFrame:
    """Pairs ``a b`` of components that links of members of one list join: those that it takes to join all of them (see ``components.joined``).
    ``lists``: ``key node``; ``label``: ``node component``, where a node without a row is its own component;
    lists of two members were tested by the caller's first round; ``facts``: ``node n bits``, the set's size and ``bitmap``, and the columns ``by``;
    ``sets_of``: ``bytes`` of the sets of some nodes (and maybe of others), one row for each value of ``by``."""
    near = checkpoint(ties(lists, label, facts, threshold), lists.sparkSession)
    if near.isEmpty():
        return near
    crowds = components(near).toDF("node", "key")
    placed = checkpoint(_placed(crowds, label).join(facts.select("node", "n", *(c for c in by if c != "node")), "node"), lists.sparkSession)
    top = placed.groupBy("key", "c").agg(F.count(F.lit(1)).alias("m")).groupBy("key").agg(F.max(F.struct("m", "c"))["c"].alias("top"))
    rows = placed.join(top, "key").withColumn("inner", F.col("c") == F.col("top"))
    blocks = lambda rows, hashes: F.ceil(F.greatest(rows / BLOCK, hashes / HASHES)).cast("int")
    one, size = F.lit(1), F.col("n")
    split = rows.groupBy("key").agg(
        blocks(F.count(one), F.sum(size)).alias("all"), blocks(F.count(F.when(~F.col("inner"), one)), F.sum(F.when(~F.col("inner"), size))).alias("some")
    )
    # each row meets every block of outer rows, and each outer row every block of all rows
    block = lambda k: F.pmod(F.xxhash64("node"), F.col(k)).cast("int")
    every = F.transform(F.sequence(F.lit(0), F.col("some") - 1), lambda w: F.struct(w.alias("i"), block("all").alias("j"), F.lit(False).alias("outer")))
    outer = F.transform(F.sequence(F.lit(0), F.col("all") - 1), lambda w: F.struct(block("some").alias("i"), w.alias("j"), F.lit(True).alias("outer")))
    rows = rows.join(split, "key").join(sets_of(crowds.select("node")), list(by))
    rows = rows.withColumn("at", F.explode(F.when(F.col("inner"), every).otherwise(F.concat(every, outer)))).select("key", "at.i", "at.j", "at.outer", "node", "c", "inner", "bytes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in grouped(batches, ["key", "i", "j"]):
            a, b = _joining(t, threshold)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return checkpoint(rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(run, "a long, b long"), lists.sparkSession)
