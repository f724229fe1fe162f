"""Removal of long repeated byte strings by prefix-free parsing.

A byte is removed when a string of ``LENGTH`` bytes covers it that also starts
anywhere else in the corpus.  The parse follows the text alone: a place is a
trigger when the rolling hash of the ``PROBE`` bytes from it falls into one of
``SPACINGS`` classes, so equal strings are cut at equal places wherever they
stand, and no phrase is the start of another (each ends where a trigger begins).

Every string of ``LENGTH`` bytes is told by its first trigger: the end of a
phrase before it and the parse after it.  Strings whose first trigger lies in
the same block of ``BLOCK`` bytes of the same phrase end form a unit, with

* ``k``: the hash of the bytes that all of its strings share, and
* ``e``: a 96-bit hash of the bytes that they cover together.

Sorting units by (k, e) puts the corpus in the order that the dictionary's
and the parse's suffix arrays would give as far as equality over ``LENGTH``
bytes needs it: units with a ``k`` of their own hold no repeat, units with the
same ``e`` repeat whole, and only units that share ``k`` but not ``e`` (the
borders of repeats) are told apart string by string, once for each distinct
``e``.  Strings without a trigger (runs of few different bytes) are sorted by their
own hashes.  (Lexicographic suffix arrays are not built: they would move every
suffix of the dictionary, which for text that is mostly unlike is the corpus.)

All of it is Spark: units and strings are rows, sorted and counted by window
functions after one hash exchange each; the text itself is exchanged once, to
meet its removed intervals.

Defined cases: null and empty texts have no bytes (digest of none); texts
shorter than ``LENGTH`` stay whole; repeated rows repeat each other, so their long
strings go; rows that share a doc_id but not the text are judged apart; other
columns are ignored; matches never cross documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearth.llm.common import id_text, rows_of, ship, stored

LENGTH = 400
#: Bytes that decide a trigger, bytes between triggers on average (by tier), and starts that a unit holds at most.
PROBE, SPACINGS, BLOCK = 12, (96, 12), 100
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_MIX = np.uint64(0xD6E8FEB86659FD93)


class _Powers:
    """Powers of the bases and of their inverses modulo 2**64, as long as asked for so far."""

    def __init__(self) -> None:
        self.up: list[np.ndarray] = []
        self.down: list[np.ndarray] = []

    def of(self, n: int) -> _Powers:
        if not self.up or len(self.up[0]) < n:
            size = max(n, 1 << 17)
            self.up = [_run_of(b, size) for b in _BASES]
            self.down = [_run_of(pow(b, -1, 1 << 64), size) for b in _BASES]
        return self


def _run_of(base: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.r_[np.uint64(1), np.full(n, base, dtype=np.uint64)], dtype=np.uint64)


_POWERS = _Powers()


class Hashes:
    """Rolling hashes of any substring of one byte string."""

    def __init__(self, data: np.ndarray):
        p = _POWERS.of(len(data) + 1)
        c = data.astype(np.uint64) + np.uint64(1)
        self.down = p.down
        with np.errstate(over="ignore"):
            self.sums = [np.r_[np.uint64(0), np.cumsum(c * up[: len(c)], dtype=np.uint64)] for up in p.up]

    def of(self, start: np.ndarray, end: np.ndarray, which: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (self.sums[which][end] - self.sums[which][start]) * self.down[which][start]


def _first_triggers(h: Hashes, n: int, starts: np.ndarray, tier: int) -> np.ndarray:
    """Bytes from each start to its first trigger of a tier (very many if there is none)."""
    at = np.arange(max(0, n - PROBE + 1))
    with np.errstate(over="ignore"):
        part = (h.of(at, at + PROBE, 0) * _MIX) >> np.uint64(40 - 20 * tier)
    q = at[part % np.uint64(SPACINGS[tier]) == 0]
    return np.r_[q, 2 * n + LENGTH][np.searchsorted(q, starts)] - starts


def units(data: np.ndarray) -> tuple[Hashes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, anchors, first and last starts of the units, and the starts of strings without a trigger.

    Strings without a trigger of the first tier are told by the closer triggers of the second; which tier a
    string belongs to and where its trigger is depend on its own bytes alone."""
    h, left = Hashes(data), np.arange(len(data) - LENGTH + 1)
    found = []
    for tier in range(len(SPACINGS)):
        ahead = _first_triggers(h, len(data), left, tier)
        bare = ahead > LENGTH - PROBE
        starts, anchor = left[~bare], (left + ahead % BLOCK)[~bare]
        left = left[bare]
        if len(starts):  # starts run upward, so each anchor's starts are together
            first = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (np.diff(starts) != 1)])
            last = np.r_[first[1:], len(anchor)] - 1
            found.append((anchor[first], starts[first], starts[last], np.full(len(first), tier)))
        if not len(left):
            break
    if not found:
        z = np.zeros(0, dtype=np.int64)
        return h, z, z, z, left
    anchor, lo, hi, tier = (np.concatenate(x) for x in zip(*found))
    return h, anchor, lo, hi, left


def unit_keys(h: Hashes, anchor: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    k = h.of(anchor, anchor + LENGTH - BLOCK, 0)
    with np.errstate(over="ignore"):
        shape = ((anchor - lo) * 1009 + (anchor - hi)).astype(np.int64).astype(np.uint64) * _MIX
        return k.view(np.int64), (h.of(lo, hi + LENGTH, 0) + shape).view(np.int64), (h.of(lo, hi + LENGTH, 1) ^ shape).view(np.int64)


def _bytes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)


_UNIT = "doc_id long, text_key int, kind int, k long, e1 long, e2 int, lo int, hi int"
_UNIT_TYPES = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
_UNIT_NAMES = [c.split()[0] for c in _UNIT.split(", ")]


def _combined(row: np.ndarray, cols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A slice's units before they are exchanged: of units alike one stays as kind 0, for the others of the corpus
    to meet; that all of them repeat is known here, as ranges of kind 2 with adjoining ranges made one."""
    kind, k, e1, e2, lo, hi = cols
    unit = np.flatnonzero(kind == 0)
    order = unit[np.lexsort((e2[unit], e1[unit], k[unit]))]
    if len(order) < 2:
        return row, cols
    same = (k[order][1:] == k[order][:-1]) & (e1[order][1:] == e1[order][:-1]) & (e2[order][1:] == e2[order][:-1])
    later = np.r_[False, same]
    alike = order[later | np.r_[same, False]]
    if not len(alike):
        return row, cols
    alike = alike[np.lexsort((lo[alike], row[alike]))]
    r, a, z = row[alike], lo[alike], hi[alike]
    first = np.flatnonzero(np.r_[True, (r[1:] != r[:-1]) | (a[1:] != z[:-1] + 1)])
    last = np.r_[first[1:], len(alike)] - 1
    known = np.array([np.full(len(first), 2), r[first] * 7919 + a[first], np.zeros(len(first)), np.zeros(len(first)), a[first], z[last]]).astype(np.int64)
    keep = np.ones(len(kind), dtype=bool)
    keep[order[later]] = False
    return np.r_[row[keep], r[first]], np.concatenate([cols[:, keep], known], axis=1)


def parse(docs: DataFrame) -> DataFrame:
    """Units of every text (kind 0), starts without a trigger (kind 1: ``e1 e2`` are the string's hashes), and
    starts that repeat within such a stretch of their own text (kind 2)."""

    def rows(doc_id, text_key, text) -> list[np.ndarray] | None:
        data = _bytes(text)
        if len(data) < LENGTH:
            return None
        h, anchor, lo, hi, bare = units(data)
        k, e1, e2 = unit_keys(h, anchor, lo, hi)
        parts = [np.array([np.zeros(len(k), np.int64), k, e1, e2 >> 32, lo, hi])]
        if len(bare):
            b1, b2 = h.of(bare, bare + LENGTH, 0).view(np.int64), h.of(bare, bare + LENGTH, 1).view(np.int64)
            _, first, count = np.unique(np.stack([b1, b2]), axis=1, return_index=True, return_counts=True)
            parts.append(np.array([np.full(len(first), 1), b1[first], b1[first], b2[first] >> 32, bare[first], bare[first]]))
            if (count > 1).any():
                _, back = np.unique(np.stack([b1, b2]), axis=1, return_inverse=True)
                own = bare[(count > 1)[back.reshape(-1)]]
                cut = np.flatnonzero(np.r_[True, np.diff(own) != 1])
                lo2, hi2 = own[cut], own[np.r_[cut[1:], len(own)] - 1]
                z = np.zeros(len(cut), np.int64)
                parts.append(np.array([z + 2, lo2, z, z, lo2, hi2]))
        return np.concatenate(parts, axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows_of(batches):
            ids, keys, found, row = [], [], [], []
            for at, (i, t, x) in enumerate(zip(*(b.column(c).to_pylist() for c in ("doc_id", "text_key", "text")))):
                r = rows(i, t, x)
                if r is not None:
                    ids.append(i)
                    keys.append(t)
                    row.append(np.full(r.shape[1], len(ids) - 1))
                    found.append(r)
            if found:
                row, cols = _combined(np.concatenate(row), np.concatenate(found, axis=1))
                arrays = [pa.array(np.array(ids, dtype=np.int64)[row]), pa.array(np.array(keys, dtype=np.int32)[row])]
                arrays += [pa.array(c).cast(t) for c, t in zip(cols, _UNIT_TYPES[2:])]
                yield pa.RecordBatch.from_arrays(arrays, _UNIT_NAMES)

    return docs.mapInArrow(run, _UNIT)


_STRING = "doc_id long, text_key int, h1 long, h2 int, start int, wanted boolean"


def _strings(rows: DataFrame) -> DataFrame:
    """Hashes of the single strings of ``doc_id text_key text borders`` (borders: lo, hi, wanted)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows_of(batches, 1 << 20):
            for i, t, x, borders in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text_key", "text", "borders"))):
                h = Hashes(_bytes(x))
                s = np.concatenate([np.arange(u["lo"], u["hi"] + 1) for u in borders])
                wanted = np.concatenate([np.full(u["hi"] - u["lo"] + 1, u["wanted"]) for u in borders])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([i] * len(s), type=pa.int64()), pa.array([t] * len(s), type=pa.int32()),
                        pa.array(h.of(s, s + LENGTH, 0).view(np.int64)), pa.array((h.of(s, s + LENGTH, 1).view(np.int64) >> 32).astype(np.int32)),
                        pa.array(s.astype(np.int32)), pa.array(wanted),
                    ],
                    ["doc_id", "text_key", "h1", "h2", "start", "wanted"],
                )

    return rows.mapInArrow(run, _STRING)


def repeated_starts(texts: DataFrame) -> DataFrame:
    """``doc_id text_key lo hi``: starts of repeated strings of ``texts`` (``doc_id text_key text``), as ranges."""
    parsed = parse(texts)
    same_k, same_e = Window.partitionBy("kind", "k"), Window.partitionBy("kind", "k", "e1", "e2")
    ranked = Window.partitionBy("kind", "k", "e1", "e2").orderBy("doc_id", "text_key", "lo")
    counted = stored(
        parsed.repartition("k")
        .withColumn("n_k", F.count(F.lit(1)).over(same_k)).where("n_k > 1 or kind = 2")
        .withColumn("n_e", F.count(F.lit(1)).over(same_e))
        .withColumn("mixed", F.col("n_e") < F.col("n_k"))
        .withColumn("nth", F.row_number().over(ranked))
        .select(
            "doc_id", "text_key", "lo", "hi",
            ((F.col("n_e") > 1) | (F.col("kind") == 2)).alias("whole"),
            (F.col("mixed") & (F.col("nth") == 1) & (F.col("kind") == 0)).alias("border"),
        )
        .where("whole or border"),
        texts.sparkSession, "repeats",
    )
    whole = counted.where("whole").select("doc_id", "text_key", "lo", "hi")
    borders = counted.where("border").groupBy("doc_id", "text_key").agg(
        F.collect_list(F.struct("lo", "hi", (~F.col("whole")).alias("wanted"))).alias("borders")
    )
    strings = _strings(texts.join(borders, ["doc_id", "text_key"]).select("doc_id", "text_key", "text", "borders"))
    single = (
        strings.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("h1", "h2")))
        .where("n > 1 and wanted").select("doc_id", "text_key", F.col("start").alias("lo"), F.col("start").alias("hi"))
    )
    return whole.union(single)


def _kept(data: bytes, ranges: list) -> tuple[int, int, bytes]:
    """Removed bytes, removed runs and the remaining bytes."""
    if not ranges:
        return 0, 0, data
    r = np.array(sorted((x["lo"], x["hi"] + LENGTH) for x in ranges), dtype=np.int64)
    reach = np.maximum.accumulate(r[:, 1])
    new = np.r_[True, r[1:, 0] > reach[:-1]]
    lo, hi = r[new, 0], reach[np.r_[np.flatnonzero(new)[1:], len(r)] - 1]
    edges = [0, *np.stack([lo, hi], axis=1).reshape(-1).tolist(), len(data)]
    return int((hi - lo).sum()), len(lo), b"".join(data[edges[i] : edges[i + 1]] for i in range(0, len(edges), 2))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id n_bytes n_removed n_spans kept_sha256 kept`` of every row (``kept``: the remaining bytes)."""
    ship(docs.sparkSession)
    texts = id_text(docs, id_col, text_col).withColumn("text_key", F.hash("text")).select(F.coalesce("doc_id", F.lit(-(1 << 62))).alias("doc_id"), "text_key", "text")
    ranges = repeated_starts(texts).distinct().groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges"))
    joined = texts.join(ranges, ["doc_id", "text_key"], "left").select("doc_id", "text", "ranges")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows_of(batches):
            ids, out = b.column("doc_id").to_pylist(), []
            for text, r in zip(b.column("text").to_pylist(), b.column("ranges").to_pylist()):
                data = text.encode("utf-8", "surrogatepass")
                removed, spans, kept = _kept(data, r or [])
                out.append((len(data), removed, spans, hashlib.sha256(kept).hexdigest(), kept))
            cols = list(zip(*out))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([None if i == -(1 << 62) else i for i in ids], type=pa.int64()),
                    *(pa.array(c, type=pa.int64()) for c in cols[:3]), pa.array(cols[3]), pa.array(cols[4], type=pa.binary()),
                ],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
            )

    return joined.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
