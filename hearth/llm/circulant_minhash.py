"""Near-duplicate removal by circulant MinHash.

A document's set are its distinct four-word shingles as 64-bit hashes.  Two
permutations make every coordinate of its signature: the first one (an odd
multiplication, a permutation of the 64-bit words) scatters the shingles over a
circle of ``DOMAIN`` places, the second one, ``pi``, orders the places, and
coordinate k is the least ``pi(place - k)``: the same order, turned by k.  So all
coordinates of a shingle are neighbours in one table and a signature is the
minimum of a few contiguous rows.

1. Equal sets are one class (96-bit digest of the sorted set); its smallest doc_id stands for it.
2. ``BANDS`` bands of ``ROWS`` coordinates put classes into buckets.  Two sets of similarity 0.8 miss
   all of them with probability ``(1 - 0.8 ** 5) ** 40``, about 1e-7.
3. Round one holds each member of a bucket against the bucket's centre (the member that shares the
   most buckets), on whole sets.  Links make components.
4. Round two looks between components: in a bucket of several, members outside the largest one meet
   all others in blocks inside tasks, and those whose bitmaps' exact bound allows a pair meet again on whole
   sets inside tasks (``pair_blocks``).  Members of one component are not compared
   again, so neither copies nor pairs that miss the threshold are ever expanded into rows, and no bucket is capped.

Sets of documents that share a bucket are the only ones that move, one row a document.

Defined cases: null, empty or blank texts have no shingle, link with nothing and are kept; fewer than
four words are one shingle; rows that repeat a doc_id are one node with the links of each of its texts
and keep a row each; rows without a doc_id take the component of the texts that theirs links with and are
kept if that has no doc_id; ties go to the smaller doc_id; an empty table gives no rows; other columns are ignored; texts
of any length are read whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import checkpoint, id_text, in_filter, key_filter, rows_of, ship, stored
from hearth.llm.components import components, joined
from hearth.llm.group_join import shingle_sets
from hearth.llm.pair_blocks import between_components, bitmap

SHINGLE = 4
#: In hundredths.
THRESHOLD = 80
BANDS, ROWS = 40, 5
#: Places of the circle.
DOMAIN = 1 << 20
_SCATTER = np.uint64(0x9E3779B97F4A7C15)
_PLACE_BITS = DOMAIN.bit_length() - 1


def _turned(width: int, known: dict[int, np.ndarray] = {}) -> np.ndarray:  # noqa: B006
    """Row i: the second permutation at place i and the ``width - 1`` places before it; kept between calls."""
    if width not in known:
        pi = np.random.default_rng(20).permutation(DOMAIN).astype(np.uint32)
        known[width] = np.lib.stride_tricks.sliding_window_view(np.r_[pi[DOMAIN - width + 1 :], pi], width)
    return known[width]


def signature(s: np.ndarray, width: int) -> np.ndarray:
    """``width`` coordinates (uint32) of a set of hashes; all ones for the empty set."""
    table = _turned(width)
    out = np.full(width, np.iinfo(np.uint32).max, dtype=np.uint32)
    with np.errstate(over="ignore"):
        places = ((s.view(np.uint64) * _SCATTER) >> np.uint64(64 - _PLACE_BITS)).astype(np.int64)
    step = max(1, (1 << 20) // width)  # some megabytes of rows at once, however long the text
    for at in range(0, len(places), step):
        np.minimum(out, table[places[at : at + step]].min(axis=0), out=out)
    return out


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """One 64-bit key (int64) for each band of each signature (rows)."""
    with np.errstate(over="ignore"):
        x = signatures.reshape(len(signatures), BANDS, ROWS).astype(np.uint64)
        h = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (len(signatures), BANDS)) * _SCATTER
        for r in range(ROWS):
            h = (h ^ x[:, :, r]) * np.uint64(0xD6E8FEB86659FD93)
            h = h ^ (h >> np.uint64(32))
    return h.view(np.int64)


def _digest(s: np.ndarray) -> tuple[int, int]:
    d = hashlib.blake2b(s.tobytes(), digest_size=12).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def _signed(docs: DataFrame) -> DataFrame:
    """``doc_id n k1 k2 bands`` of every row: set size, the set's digest, its band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows_of(batches):
            sets = shingle_sets(b.column("text").to_pylist(), width=SHINGLE)
            digests = [_digest(s) for s in sets]
            keys = band_keys(np.stack([signature(s, BANDS * ROWS) for s in sets]))
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("doc_id"), pa.array([len(s) for s in sets], type=pa.int64()), pa.array([k for k, _ in digests], type=pa.int64()),
                    pa.array([k for _, k in digests], type=pa.int32()), pa.array(list(keys), type=pa.list_(pa.int64())),
                ],
                ["doc_id", "n", "k1", "k2", "bands"],
            )

    return docs.mapInArrow(run, "doc_id long, n long, k1 long, k2 int, bands array<long>")


def _sets_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node k1 k2 bytes bits`` of the texts of the doc_ids ``nodes`` (and of a few others that share a place in a filter of
    fixed size, which joins drop): the sorted hashes, 8 bytes each, and their bitmap."""
    shared = docs.sparkSession.sparkContext.broadcast(key_filter(nodes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows_of(batches):
            b = b.filter(pa.array(in_filter(shared.value, b.column("x").to_numpy())))
            sets = shingle_sets(b.column("text").to_pylist(), width=SHINGLE)
            digests = [_digest(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("doc_id"), pa.array([k for k, _ in digests], type=pa.int64()), pa.array([k for _, k in digests], type=pa.int32()),
                    pa.array([s.tobytes() for s in sets], type=pa.binary()), pa.array([bitmap(s) for s in sets], type=pa.binary()),
                ],
                ["node", "k1", "k2", "bytes", "bits"],
            )

    place = F.pmod(F.xxhash64("doc_id"), F.lit(key_filter.bits)).alias("x")
    return docs.select("doc_id", "text", place).mapInArrow(run, "node long, k1 long, k2 int, bytes binary, bits binary")


def _linked(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The pairs ``a b`` of classes whose whole sets reach the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows_of(batches, 8 << 20):
            keep = []
            for x, y in zip(b.column("x").to_pylist(), b.column("y").to_pylist()):
                p, q = np.frombuffer(x, dtype=np.int64), np.frombuffer(y, dtype=np.int64)
                both = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(100 * both >= threshold * (len(p) + len(q) - both) and both > 0)
            m = pa.array(keep, type=pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column("a").filter(m), b.column("b").filter(m)], ["a", "b"])

    by = lambda a, x: sets.select(F.col("node").alias(a), F.col("bytes").alias(x))
    return pairs.join(by("a", "x"), "a").join(by("b", "y"), "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _links(docs: DataFrame, classes: DataFrame, threshold: int, tied: DataFrame) -> DataFrame:
    """``node component`` of the classes (``node first n k1 k2 bands``) that link; ``tied`` are links that hold anyway."""
    spark = docs.sparkSession
    posted = classes.select("node", F.explode_outer("bands").alias("key"))
    buckets = posted.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    shared = stored(posted.join(buckets, "key"), spark, "buckets")
    degree = shared.groupBy("node").agg(F.sum(F.col("m") - 1).alias("degree"))
    paired = classes.select("node", "first", "n", "k1", "k2").join(degree, "node", "left_semi")
    sets = _sets_of(docs, paired.select(F.col("first").alias("node"))).drop("node").join(paired, ["k1", "k2"])
    sets = stored(sets.select("node", "n", "bytes", "bits").dropDuplicates(["node"]), spark, "sets")

    ranked = shared.join(degree, "node")
    centres = ranked.groupBy("key").agg(F.max(F.struct("degree", (-F.col("node")).alias("node")))["node"].alias("centre"))
    spokes = shared.join(centres.select("key", (-F.col("centre")).alias("centre")), "key").where("node <> centre")
    spokes = spokes.select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct()
    size = lambda s: sets.select(F.col("node").alias(s), F.col("n").alias(f"n_{s}"))
    spokes = spokes.join(size("a"), "a").join(size("b"), "b").where((F.col("n_a") * 100 >= F.col("n_b") * threshold) & (F.col("n_b") * 100 >= F.col("n_a") * threshold))
    first = checkpoint(spokes.select("a", "b"), spark)
    links = checkpoint(_linked(first, sets, threshold).union(tied), spark)

    label = components(links)
    more = between_components(shared.select("key", "node"), label, sets, lambda nodes: sets.select("node", "bytes").join(nodes, "node", "left_semi"), threshold)
    return joined(label, more)


def near_duplicates(docs: DataFrame, threshold: int = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id n_shingles component_id kept`` of every row; component: the smallest doc_id reachable by links."""
    spark = docs.sparkSession
    ship(spark)
    docs = id_text(docs, id_col, text_col)
    rows = stored(_signed(docs), spark, "signatures")
    classes = rows.where("n > 0").groupBy("k1", "k2").agg(F.min("doc_id").alias("first"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()), spark, "classes")
    # a doc_id with several texts ties their classes together
    texts = rows.where("n > 0 and doc_id is not null").groupBy("doc_id").agg(F.min(F.struct("k1", "k2")).alias("lo"), F.max(F.struct("k1", "k2")).alias("hi")).where("lo <> hi")
    nodes = rows.where("n > 0").join(texts.select("doc_id"), "doc_id").join(classes.select("k1", "k2", "node"), ["k1", "k2"]).select("doc_id", "node").distinct()
    tied = nodes.join(nodes.groupBy("doc_id").agg(F.min("node").alias("b")), "doc_id").where("node <> b").select(F.col("node").alias("a"), "b")
    label = _links(docs, classes, threshold, tied)
    labelled = classes.select("k1", "k2", "node", "first").join(label, "node", "left").withColumn("c", F.coalesce("component", "node"))
    ids = labelled.groupBy("c").agg(F.min("first").alias("component"))
    of_class = labelled.select("k1", "k2", "c").join(ids, "c").select("k1", "k2", "component")
    found = rows.select("doc_id", "n", "k1", "k2").join(of_class, ["k1", "k2"], "left")
    component = F.coalesce(F.when(F.col("n") > 0, F.col("component")), F.col("doc_id"))
    return found.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def keep_one(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` (all columns) whose doc_id is their component's smallest, and those without a doc_id."""
    gone = near_duplicates(docs, threshold).where("not kept").select(F.col("doc_id").alias("_hearth_gone")).distinct()
    return docs.join(gone, F.col("doc_id").cast("long") == F.col("_hearth_gone"), "left_anti")
