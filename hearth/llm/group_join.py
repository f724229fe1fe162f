"""N-gram Jaccard join by a grouped prefix join.

A document's set are its distinct five-word shingles as 64-bit hashes.  Two
sets of sizes x and y with a Jaccard similarity of at least t share one of the
first ``x - ceil(t x) + 1`` and ``y - ceil(t y) + 1`` shingles in any common
order.  The order puts very frequent shingles last (a list of at most
``FREQUENT`` of them, which changes the work and never the result).

1. Equal sets are one class (by a 96-bit digest of the sorted set); its smallest doc_id stands for it.
2. Classes with identical prefix and size are one group; only groups are listed by prefix shingle (the shingles are
   exchanged once, and one that no other group has goes no further), and lists of the same groups are one list.
3. A list's pairs are bounded without their sets: with ``u`` prefix shingles
   that no other list member has, the set whose prefix ends earlier in the order can
   share at most ``size - u`` shingles.
4. Round one verifies few pairs per list: every group against the list's
   centre (the group with the fewest shingles of its own), and members of a group
   against the group's first; bitmaps rule pairs out before their sets are fetched.  Links make components.
5. Round two looks for links that join two components:
   in each list, members outside its largest component meet all others in blocks inside tasks,
   and those whose bitmaps' exact bound allows a pair meet again on whole sets inside tasks (``pair_blocks``).
   Pairs inside a component can no longer
   change it, so all components are exact although copies are not compared
   with each other.

Verification counts shared hashes of both whole sets.  Lists, pairs and sets
are joined by shuffle, hot lists are split into blocks; only the frequent shingles
(fixed size) go through the driver.

Defined cases: null, empty or blank texts have no shingle, link with nothing
and are their own component; fewer than five words are one shingle; rows that
repeat a doc_id are one node with the links of each of its texts and keep a row
each; ties go to the smaller doc_id; an empty table gives no rows; other
columns are ignored.  ``keep_one`` judges rows by their text instead: there a
shared doc_id links nothing, and rows without a doc_id count like others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearth.llm.common import checkpoint, id_text, in_filter, key_filter, rows_of, ship, stored
from hearth.llm.components import components, joined
from hearth.llm.pair_blocks import between_components, bitmap, may_reach

SHINGLE = 5
#: In hundredths.
THRESHOLD = 80
#: Frequent shingles that the order puts last, at most (8 bytes each), and how often one task must see a shingle to report it.
FREQUENT, REPORTED = 1 << 17, 4
#: Shingles that a task counts together (8 MB), about.
COUNTED = 1 << 20
_MULTIPLIER = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)
#: Bytes as they count: A-Z lower-cased, separators 0, others one more than they are (UTF-8 keeps words apart by these bytes alone).
_BYTE = np.array([0 if c == 0x20 or 9 <= c <= 13 else (c + 32 if 65 <= c <= 90 else c) + 1 for c in range(256)], dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(_MULTIPLIER[3])
    return x ^ (x >> np.uint64(29))


def _powers(n: int, known: list[np.ndarray] = []) -> np.ndarray:  # noqa: B006
    """Powers of the word hash's base modulo 2**64; kept between calls."""
    if not known or len(known[0]) < n:
        known[:] = [np.cumprod(np.r_[np.uint64(1), np.full(max(n, 1 << 10), _MULTIPLIER[0], dtype=np.uint64)], dtype=np.uint64)]
    return known[0]


def shingle_sets(texts: list[str], at_once: int = 1 << 18, width: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct hashes (int64) of each text's shingles of ``width`` words; texts are worked on in whole arrays of about
    ``at_once`` characters (or one longer text), which bounds the memory."""
    out: list[np.ndarray] = []
    part: list[str] = []
    size = 0
    for t in texts:
        part.append(t)
        size += len(t)
        if size >= at_once:
            out += _shingle_sets(part, width)
            part, size = [], 0
    return out + _shingle_sets(part, width) if part else out


def _shingle_sets(texts: list[str], width: int) -> list[np.ndarray]:
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    c = _BYTE[np.frombuffer(b" ".join(raw) + b" ", dtype=np.uint8)]
    text_end = np.cumsum([len(r) + 1 for r in raw])
    inside = c > 0
    first = np.flatnonzero(inside & np.r_[True, ~inside[:-1]])
    if not len(first):
        return [np.zeros(0, dtype=np.int64) for _ in texts]
    after = np.flatnonzero(~inside & np.r_[False, inside[:-1]])
    at = np.flatnonzero(inside)
    size = after - first
    ends = np.cumsum(size)
    place = np.arange(len(at)) - np.repeat(ends - size, size)
    with np.errstate(over="ignore"):
        word = _mixed(np.add.reduceat(c[at] * _powers(int(size.max()))[place], ends - size) + size.astype(np.uint64))
        owner = np.searchsorted(text_end, first, side="right")
        n_words = np.bincount(owner, minlength=len(texts))
        window = _rolled(word, width)
    start = np.cumsum(n_words) - n_words
    out = []
    for s, n in zip(start.tolist(), n_words.tolist()):
        if n >= width:
            h = window[s : s + n - width + 1]
        else:
            h = _rolled(word[s : s + n], n) if n else word[:0]
        out.append(np.unique(h.view(np.int64)))
    return out


def _rolled(word: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k words."""
    n = max(0, len(word) - k + 1)
    with np.errstate(over="ignore"):
        s = np.full(n, k, dtype=np.uint64)
        for i in range(k):
            s = _mixed(s + word[i : i + n] * np.uint64(_MULTIPLIER[i]))
    return s


def _prefix_length(n: np.ndarray | int, t: int) -> np.ndarray | int:
    return n - (-(-n * t // 100)) + 1


def _frequent(docs: DataFrame) -> np.ndarray:
    """Hashes of the most frequent shingles by rising count, at most ``FREQUENT``."""

    def counted(every: list[np.ndarray]) -> pa.RecordBatch:
        h, c = np.unique(np.concatenate(every), return_counts=True)
        often = c >= REPORTED
        return pa.RecordBatch.from_arrays([pa.array(h[often]), pa.array(c[often].astype(np.int64))], ["hash", "c"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every, held = [], 0
        for b in rows_of(batches):
            sets = shingle_sets(b.column("text").to_pylist())
            every, held = every + sets, held + sum(map(len, sets))
            if held >= COUNTED:
                yield counted(every)
                every, held = [], 0
        if every:
            yield counted(every)

    counts = docs.select("text").mapInArrow(run, "hash long, c long").groupBy("hash").agg(F.sum("c").alias("c"))
    top = counts.orderBy(F.col("c").desc(), "hash").limit(FREQUENT).toPandas()
    return top["hash"].to_numpy(dtype=np.int64)[::-1].copy()


def _digest(s: np.ndarray) -> tuple[int, int]:
    """A set's 96 bits."""
    d = hashlib.blake2b(s.tobytes(), digest_size=12).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def _with_prefix(docs: DataFrame, frequent: np.ndarray, t: int) -> DataFrame:
    """``doc_id n k1 k2 prefix last_rank last_hash bits`` of every row, and ``text_hash`` if ``docs`` has it."""
    extra = [c for c in docs.columns if c == "text_hash"]
    order = np.argsort(frequent)
    hot, hot_rank = frequent[order], (order + 1).astype(np.int64)
    shared = docs.sparkSession.sparkContext.broadcast((hot, hot_rank))

    def one(s: np.ndarray) -> tuple:
        hot, hot_rank = shared.value
        n = len(s)
        k1, k2 = _digest(s)
        if not n:
            return n, k1, k2, [], 0, 0, b""
        rank = np.zeros(n, dtype=np.int64)
        if len(hot):
            at = np.minimum(np.searchsorted(hot, s), len(hot) - 1)
            rank = np.where(hot[at] == s, hot_rank[at], 0)
        first = np.lexsort((s, rank))[: _prefix_length(n, t)]
        return n, k1, k2, s[first], int(rank[first[-1]]), int(s[first[-1]]), bitmap(s)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows_of(batches):
            cols = list(zip(*map(one, shingle_sets(b.column("text").to_pylist()))))
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("doc_id"), pa.array(cols[0], type=pa.int64()), pa.array(cols[1], type=pa.int64()), pa.array(cols[2], type=pa.int32()),
                    pa.array(cols[3], type=pa.list_(pa.int64())), pa.array(cols[4], type=pa.int64()), pa.array(cols[5], type=pa.int64()),
                    pa.array(cols[6], type=pa.binary()), *[b.column(c) for c in extra],
                ],
                ["doc_id", "n", "k1", "k2", "prefix", "last_rank", "last_hash", "bits", *extra],
            )

    schema = "doc_id long, n long, k1 long, k2 int, prefix array<long>, last_rank long, last_hash long, bits binary"
    return docs.mapInArrow(run, ", ".join([schema, *[f"{c} binary" for c in extra]]))


def _sets_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node k1 k2 bytes`` (doc_id, the set's digest, its sorted hashes of 8 bytes each) of the texts of ``nodes``, and
    of a few others that share a place in the filter; joins drop those.  The filter spares the exchange of all texts."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(key_filter(nodes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows_of(batches):
            b = b.filter(pa.array(in_filter(shared.value, b.column("x").to_numpy())))
            sets = shingle_sets(b.column("text").to_pylist())
            keys = [_digest(x) for x in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("doc_id"), pa.array([k for k, _ in keys], type=pa.int64()), pa.array([k for _, k in keys], type=pa.int32()),
                    pa.array([x.tobytes() for x in sets], type=pa.binary()),
                ],
                ["node", "k1", "k2", "bytes"],
            )

    place = F.pmod(F.xxhash64("doc_id"), F.lit(key_filter.bits)).alias("x")
    return docs.select("doc_id", "text", place).mapInArrow(run, "node long, k1 long, k2 int, bytes binary")


def _with_sets(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """``a b x y``: pairs of doc_ids with the sets of all their texts."""
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b"))
    sets = stored(_sets_of(docs.where("doc_id is not null"), nodes).select("node", "bytes"), pairs.sparkSession, "sets")
    return pairs.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b")


def _with_class_sets(pairs: DataFrame, docs: DataFrame, members: DataFrame) -> DataFrame:
    """``a b x y``: pairs of classes with the set of each, made from the text of its first row."""
    side = lambda s: members.select(F.col("node").alias(s), F.struct("first", "k1", "k2").alias(f"{s}_key"))
    keyed = stored(pairs.join(side("a"), "a").join(side("b"), "b"), pairs.sparkSession, "pairs")
    nodes = keyed.select(F.col("a_key.first").alias("node")).union(keyed.select("b_key.first"))
    sets = stored(_sets_of(docs, nodes), pairs.sparkSession, "sets")
    # rows without a doc_id can be the first of a class together
    sets = sets.where("node is not null").union(sets.where("node is null").dropDuplicates(["k1", "k2"]))
    key = F.struct(F.col("node").alias("first"), "k1", "k2")
    return keyed.join(sets.select(key.alias("a_key"), F.col("bytes").alias("x")), "a_key").join(
        sets.select(key.alias("b_key"), F.col("bytes").alias("y")), "b_key"
    )


def _linked(with_sets: DataFrame, t: int) -> DataFrame:
    """The pairs ``a b`` whose whole sets reach the threshold.  Sets are made from the texts of the pairs' documents alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows_of(batches, 8 << 20):
            keep = []
            for x, y in zip(b.column("x").to_pylist(), b.column("y").to_pylist()):
                p, q = np.frombuffer(x, dtype=np.int64), np.frombuffer(y, dtype=np.int64)
                both = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(100 * both >= t * (len(p) + len(q) - both) and both > 0)
            m = pa.array(keep, type=pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column("a").filter(m), b.column("b").filter(m)], ["a", "b"])

    return with_sets.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _classes(docs: DataFrame, threshold: int, tied: bool) -> tuple[DataFrame, DataFrame]:
    """``doc_id n k1 k2`` (and ``text_hash``) of every row, and ``k1 k2 component`` of every class of equal sets.
    ``tied``: a class goes by its smallest doc_id, and a doc_id ties the classes of its texts; else each class has a number of its own."""
    spark = docs.sparkSession
    ship(spark)
    rows = stored(_with_prefix(docs, _frequent(docs), threshold).withColumn("group", F.xxhash64("n", "prefix")).withColumn("p", F.size("prefix")), spark, "documents")
    members = rows.where("n > 0").groupBy("k1", "k2").agg(F.min("doc_id").alias("first"), F.first("group").alias("group"), F.first("n").alias("n"), F.first("bits").alias("bits"))
    members = stored(members.withColumn("node", F.col("first") if tied else F.monotonically_increasing_id()), spark, "classes")

    def linked(pairs: DataFrame) -> DataFrame:
        return _linked(_with_sets(pairs, docs) if tied else _with_class_sets(pairs, docs, members), threshold)

    # a group goes by its smallest node; what all its rows share is taken from any of them
    hubs = members.groupBy("group").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("m"))
    shared_by = [F.first(c).alias(c) for c in ("n", "p", "last_rank", "last_hash")]
    groups = stored(rows.where("n > 0").groupBy("group").agg(*shared_by).join(hubs, "group"), spark, "groups")
    # prefixes are exchanged once by their shingles; a shingle that no other group's prefix has ends there
    prefixes = rows.where("n > 0").groupBy("group").agg(F.first("prefix").alias("prefix")).join(groups.select("group", "hub"), "group")
    every = prefixes.select("hub", F.explode("prefix").alias("token")).repartition("token")
    posted = stored(every.withColumn("c", F.count(F.lit(1)).over(Window.partitionBy("token"))).where("c > 1").select("hub", "token"), spark, "postings")
    # a list is told by its length, its ends and 128 bits of its members; equal lists are kept once
    same = [F.count(F.lit(1)).alias("c"), F.min("hub").alias("lo"), F.max("hub").alias("hi"), F.bit_xor(F.xxhash64("hub")).alias("h"), F.bit_xor(F.xxhash64("hub", F.lit(1))).alias("g")]
    chosen = posted.groupBy("token").agg(*same).groupBy("c", "lo", "hi", "h", "g").agg(F.min("token").alias("token")).select("token")
    shared = posted.groupBy("hub").agg(F.count(F.lit(1)).alias("shared"))
    facts = groups.join(shared, "hub").select(
        "group", "hub", "n", "last_rank", "last_hash", (F.col("n") - F.col("p") + F.col("shared")).alias("most")
    )  # most: shingles that the group's sets can share with a set whose prefix ends later
    lists = stored(posted.join(chosen, "token").join(facts, "hub"), spark, "lists")

    def possible(a: str, b: str):
        x, y = (F.col(f"{s}.n") for s in (a, b))
        earlier = F.struct(f"{a}.last_rank", f"{a}.last_hash") <= F.struct(f"{b}.last_rank", f"{b}.last_hash")
        most = F.when(earlier, F.col(f"{a}.most")).otherwise(F.col(f"{b}.most"))
        return (x * 100 >= y * threshold) & (y * 100 >= x * threshold) & (most * (100 + threshold) >= (x + y) * threshold)

    # round one: each group with the centre of its lists, each member with the first of its group
    entry = F.struct("most_missing", "hub", "n", "last_rank", "last_hash", "most")
    l = lists.withColumn("most_missing", F.col("n") - F.col("most"))  # noqa: E741
    centre = l.groupBy("token").agg(F.min(entry).alias("centre"))
    spokes = l.join(centre, "token").select(F.struct("hub", "n", "last_rank", "last_hash", "most").alias("p"), F.col("centre").alias("q"))
    spokes = spokes.where((F.col("p.hub") != F.col("q.hub")) & possible("p", "q")).select(F.col("p.hub").alias("a"), F.col("q.hub").alias("b"))
    inner = members.join(hubs.where("m > 1"), "group").where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b"))
    near = spokes.union(inner).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    first = checkpoint(near, spark)
    # whole sets are fetched for those alone that their bitmaps allow
    links = checkpoint(linked(checkpoint(may_reach(first, members.select("node", "n", "bits"), threshold), spark)), spark)

    # a doc_id with several texts is one node: it ties their classes together
    several = links.limit(0) if not tied else rows.where("n > 0").join(members.select("k1", "k2", "node"), ["k1", "k2"]).groupBy("doc_id").agg(
        F.collect_set("node").alias("nodes")
    ).where(F.size("nodes") > 1).select(F.col("doc_id").alias("a"), F.explode("nodes").alias("b"))

    # round two: what is left between components, in lists and in groups of several classes
    label = components(links.union(several))
    alone = members.select("group", "node")
    everyone = lists.select(F.col("token").alias("key"), "group").join(alone, "group").select("key", "node")
    crowds = alone.join(hubs.where("m > 1").select("group"), "group").select(F.col("group").alias("key"), "node")

    def class_sets(nodes: DataFrame) -> DataFrame:
        wanted = members.join(nodes, "node", "left_semi").select(F.col("first").alias("node"))
        return _sets_of(docs, wanted).select("k1", "k2", "bytes").dropDuplicates(["k1", "k2"])

    more = between_components(everyone.union(crowds), label, members.select("node", "n", "bits", "k1", "k2"), class_sets, threshold, by=("k1", "k2"))
    label = joined(label, more)
    return rows, members.select("k1", "k2", "node").join(label, "node", "left").select("k1", "k2", F.coalesce("component", "node").alias("component"))


def jaccard_components(docs: DataFrame, threshold: int = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id n_shingles component_id`` of every row; component: the smallest doc_id reachable by links."""
    rows, of_class = _classes(id_text(docs, id_col, text_col), threshold, tied=True)
    return rows.select("doc_id", "n", "k1", "k2").join(of_class, ["k1", "k2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce(F.when(F.col("n") > 0, F.col("component")), F.col("doc_id")).alias("component_id")
    )


def keep_one(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` (all columns) without those that another text of their component stands for: of a
    component the row with the smallest doc_id stays.  Components are of texts, so a row goes only if a text linked
    with its own stays, whatever other texts its doc_id has; of rows that repeat a doc_id and its text one stays."""
    text_hash = F.unhex(F.md5(F.col("text").cast("string")))
    rows, component = _classes(id_text(docs).withColumn("text_hash", text_hash), threshold, tied=False)
    rows = rows.where("n > 0").withColumn("row", F.struct("doc_id", "text_hash"))
    of_class = rows.groupBy("k1", "k2").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "row")).alias("first")).join(component, ["k1", "k2"])
    stays = of_class.groupBy("component").agg(F.min("first")["row"].alias("stays"))
    stands = of_class.join(stays, "component").select("k1", "k2", "stays")
    found = rows.join(stands, ["k1", "k2"]).where("row <> stays").select(F.col("row").alias("_hearth_row")).distinct()
    marked = docs.withColumn("_hearth_row", F.struct(F.col("doc_id").cast("long").alias("doc_id"), text_hash.alias("text_hash")))
    return marked.join(found, "_hearth_row", "left_anti").dropDuplicates(["_hearth_row"]).drop("_hearth_row")
