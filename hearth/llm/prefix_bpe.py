"""Byte-level BPE encoding and decoding by prefix dynamic programming.

For a byte string, every prefix has exactly one valid last token: the token t
that ends the prefix and follows the last token s of the prefix before it such
that merging ``s + t`` on its own gives back ``[s, t]``.  Keeping that token
for each prefix

* encodes a string in one pass (read the tokens back from the end),
* makes an append exact: earlier entries never change,
* makes an edit local: entries before it stay, and entries after it are taken
  over as soon as the table agrees with the old one over a longest token.

Whether two tokens may stand side by side is found by taking their merges back
in reverse order, latest first: a merge across the border that would have come
earlier rules the pair out.

``PrefixTable`` holds one string's table.  ``Encoder.encode_many`` fills the
tables of a batch of short strings together, prefix length by prefix length,
with numpy.  Texts are cut by the pattern of the vocabulary first; each match
is a string of its own.  Work is spread by Spark over rows (``mapInArrow``):
a task holds one Arrow slice, and a cache of strings seen that is emptied at a
fixed size, so no result depends on it.

Defined cases: null and empty texts have no tokens (the digest of no bytes);
repeated rows and ids are kept; other columns are ignored; texts of any length
are taken whole.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from hearth.llm.common import id_text, rows_of, ship

#: Strings longer than this are filled one by one (their tables in the batch would be wide and mostly empty).
SHORT = 48
#: Strings that a worker remembers before it starts anew.
REMEMBERED = 300_000
#: Bytes of text that are cut into pieces at once: each piece is a string of its own, about ten times its bytes.
SLICE = 1 << 20
_NONE = np.int64(1 << 40)
#: Odd multipliers of the rolling hash and of the places in small tables.
_BASE, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


class Vocabulary:
    """Ranks by token bytes, and the merge that made each token."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        n = max(ranks.values()) + 1
        self.tokens: list[bytes] = [b""] * n
        for t, i in ranks.items():
            self.tokens[i] = t
        self.length = np.array([len(t) for t in self.tokens], dtype=np.int64)
        self.left = np.arange(n, dtype=np.int64)
        self.right = np.arange(n, dtype=np.int64)
        self.reachable = np.zeros(n, dtype=bool)
        merged: dict[tuple[int, int], int] = {}
        for t, i in sorted(ranks.items(), key=lambda x: x[1]):
            if len(t) == 1:
                self.reachable[i] = True
                continue
            parts = self._parts(t, i)
            if len(parts) == 2:  # else plain merging never makes this token
                a, b = ranks[parts[0]], ranks[parts[1]]
                self.left[i], self.right[i], self.reachable[i] = a, b, True
                merged[a, b] = i
        # any two tokens whose bytes make a token merge with its rank, whatever made it first
        for t, i in ranks.items():
            for cut in range(1, len(t)):
                a, b = ranks.get(t[:cut]), ranks.get(t[cut:])
                if a is not None and b is not None:
                    merged[a, b] = i
        keys = np.array([a << 32 | b for a, b in merged], dtype=np.int64)
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = keys[order], np.array(list(merged.values()), dtype=np.int64)[order]
        self.longest = int(self.length.max())

    def _parts(self, token: bytes, below: int) -> list[bytes]:
        """The parts of a token's bytes when all merges of lower rank are done."""
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            best, at = below, -1
            for i in range(len(parts) - 1):
                r = self.ranks.get(parts[i] + parts[i + 1])
                if r is not None and r < best:
                    best, at = r, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _combined(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = a << 32 | b
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], _NONE)

    def side_by_side(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging the bytes of a[i] and b[i] gives back exactly those two tokens."""
        ok = np.zeros(len(a), dtype=bool)
        row, limit = np.arange(len(a)), np.full(len(a), _NONE, dtype=np.int64)
        a, b = a.astype(np.int64), b.astype(np.int64)
        while len(row):
            keep = self._combined(a, b) >= limit
            row, a, b, limit = row[keep], a[keep], b[keep], limit[keep]
            a_is_byte, b_is_byte = self.right[a] == a, self.left[b] == b
            done = a_is_byte & b_is_byte
            ok[row[done]] = True
            row, a, b, a_is_byte, b_is_byte = (x[~done] for x in (row, a, b, a_is_byte, b_is_byte))
            undo_a = ~a_is_byte & ((a > b) | b_is_byte)  # the later merge is taken back first
            limit = np.where(undo_a, a, b + 1)  # of equal ranks the merge further left came first
            a, b = np.where(undo_a, self.right[a], a), np.where(undo_a, b, self.left[b])
        return ok


class PrefixTable:
    """The last token of every prefix of one byte string."""

    def __init__(self, encoder: Encoder, data: bytes = b""):
        self.encoder, self.data, self.last = encoder, b"", []
        self.append(data)

    def append(self, more: bytes) -> PrefixTable:
        """Exact: nothing that is in the table changes."""
        start, self.data = len(self.data), self.data + more
        for end in range(start + 1, len(self.data) + 1):
            self.last.append(self._last(end))
        return self

    def replace(self, start: int, end: int, new: bytes) -> int:
        """Put ``new`` in place of the bytes from start to end; returns how many entries were filled anew."""
        old_last, shift = self.last, len(new) - (end - start)
        self.data = self.data[:start] + new + self.data[end:]
        self.last, agree, made = old_last[:start], 0, 0
        span = self.encoder.vocabulary.longest
        for at in range(start + 1, len(self.data) + 1):
            token = self._last(at)
            self.last.append(token)
            made += 1
            before = at - shift - 1
            inside = at - start > len(new)
            agree = agree + 1 if inside and old_last[before] == token else 0
            if agree >= span:  # later entries look back no further than this
                self.last.extend(old_last[before + 1 :])
                break
        return made

    def _last(self, end: int) -> int:
        e = self.encoder
        for n in e.lengths:
            if n > end:
                continue
            token = e.usable.get(self.data[end - n : end])
            if token is not None and (n == end or e.fits(self.last[end - n - 1], token)):
                return token
        raise ValueError("a byte is not in the vocabulary")

    def ids(self) -> list[int]:
        out, at = [], len(self.data)
        while at:
            out.append(self.last[at - 1])
            at -= len(self.encoder.vocabulary.tokens[out[-1]])
        return out[::-1]


class Encoder:
    """Encoding and decoding with one vocabulary and pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.vocabulary = v = Vocabulary(ranks)
        self.usable = {t: i for t, i in ranks.items() if v.reachable[i]}
        self.lengths = sorted({len(t) for t in self.usable}, reverse=True)
        self._fits: dict[tuple[int, int], bool] = {}
        self._known_keys = np.full(1 << 20, -1, dtype=np.int64)
        self._known = np.zeros(1 << 20, dtype=bool)
        self._by_length: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        with np.errstate(over="ignore"):
            self._power = np.cumprod(np.full(SHORT + 1, _BASE, dtype=np.uint64))
            for n in self.lengths:
                if n <= SHORT:
                    own = [(t, i) for t, i in self.usable.items() if len(t) == n]
                    h = np.zeros(len(own), dtype=np.uint64)
                    raw = np.frombuffer(b"".join(t for t, _ in own), dtype=np.uint8).reshape(len(own), n)
                    for k in range(n):
                        h = h * _BASE + raw[:, k].astype(np.uint64) + np.uint64(1)
                    order = np.argsort(h)
                    seen = np.zeros(1 << 16, dtype=bool)
                    seen[(h * _MIX) >> np.uint64(48)] = True
                    self._by_length[n] = seen, h[order], np.array([i for _, i in own], dtype=np.int64)[order]
        self.split = _splitter(pattern)
        self._cache: dict[str, bytes] = {}

    # -- single strings -------------------------------------------------
    def fits(self, a: int, b: int) -> bool:
        got = self._fits.get((a, b))
        if got is None:
            if len(self._fits) >= REMEMBERED:
                self._fits.clear()
            got = self._fits[a, b] = bool(self.vocabulary.side_by_side(np.array([a]), np.array([b]))[0])
        return got

    # -- batches ----------------------------------------------------------
    def _fit_many(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """As ``fits`` for arrays; answers are remembered in a table of fixed size."""
        keys = a << 32 | b
        place = ((keys.astype(np.uint64) * _BASE) >> np.uint64(44)).astype(np.int64)
        ok = self._known[place]
        new = np.flatnonzero(self._known_keys[place] != keys)
        if len(new):
            fresh, back = np.unique(keys[new], return_inverse=True)
            found = self.vocabulary.side_by_side(fresh >> 32, fresh & 0xFFFFFFFF)
            ok[new] = found[back]
            self._known_keys[place[new]] = keys[new]
            # two keys can share a place: the answer stored must be that of the key stored
            at = np.searchsorted(fresh, self._known_keys[place[new]])
            self._known[place[new]] = found[at]
        return ok

    def encode_many(self, strings: list[bytes]) -> list[bytes]:
        """Ids of each string as little-endian unsigned 32-bit integers."""
        out: list[bytes] = [b""] * len(strings)
        short = sorted((i for i, s in enumerate(strings) if 0 < len(s) <= SHORT), key=lambda i: -len(strings[i]))
        for i, s in enumerate(strings):
            if len(s) > SHORT:
                out[i] = np.array(PrefixTable(self, s).ids(), dtype="<u4").tobytes()
        for at in range(0, len(short), 32_768):
            part = short[at : at + 32_768]
            for i, ids in zip(part, self._batch([strings[i] for i in part])):
                out[i] = ids
        return out

    def _batch(self, strings: list[bytes]) -> list[bytes]:
        """strings: longest first, none empty."""
        size = np.array([len(s) for s in strings], dtype=np.int64)
        w, top = len(strings), int(size[0])
        raw = np.zeros((w, top), dtype=np.uint8)
        raw[np.arange(top) < size[:, None]] = np.frombuffer(b"".join(strings), dtype=np.uint8)
        with np.errstate(over="ignore"):
            h = np.zeros((top + 1, w), dtype=np.uint64)
            for k in range(top):
                h[k + 1] = h[k] * _BASE + raw[:, k].astype(np.uint64) + np.uint64(1)
            last = np.zeros((top + 1, w), dtype=np.int64)
            rows_at = np.searchsorted(-size, -np.arange(top + 1), side="right")  # strings of at least that length
            for end in range(1, top + 1):
                open_ = np.arange(rows_at[end])
                for n in self.lengths:
                    if n > end or not len(open_):
                        continue
                    seen, keys, ids = self._by_length[n]
                    sub = h[end][open_] - h[end - n][open_] * self._power[n - 1]
                    hit = np.flatnonzero(seen[(sub * _MIX) >> np.uint64(48)])  # few strings pass that are no token
                    sub = sub[hit]
                    at = np.minimum(np.searchsorted(keys, sub), len(keys) - 1)
                    same = keys[at] == sub
                    hit, at = hit[same], at[same]
                    if not len(hit):
                        continue
                    rows, token = open_[hit], ids[at]
                    if n < end:
                        ok = self._fit_many(last[end - n][rows], token)
                        rows, token, hit = rows[ok], token[ok], hit[ok]
                    last[end][rows] = token
                    left = np.ones(len(open_), dtype=bool)
                    left[hit] = False
                    open_ = open_[left]
                if len(open_):
                    raise ValueError("a byte is not in the vocabulary")
        steps, at, rows = [], size.copy(), np.arange(w)
        count = np.zeros(w, dtype=np.int64)
        while len(rows):
            token = last[at[rows], rows]
            steps.append((rows, token))
            count[rows] += 1
            at[rows] -= self.vocabulary.length[token]
            rows = rows[at[rows] > 0]
        ends = np.cumsum(count)
        flat = np.empty(int(ends[-1]), dtype="<u4")
        for back, (rows, token) in enumerate(steps):
            flat[ends[rows] - 1 - back] = token
        data, starts = flat.tobytes(), (ends - count) * 4
        return [data[s:e] for s, e in zip(starts.tolist(), (ends * 4).tolist())]

    # -- texts --------------------------------------------------------------
    def encode_texts(self, texts: Iterable[str]) -> list[bytes]:
        pieces = [self.split(t) for t in texts]
        cache = self._cache
        if len(cache) >= REMEMBERED:
            cache.clear()
        new = list(set().union(*pieces).difference(cache))
        cache.update(zip(new, self.encode_many([p.encode() for p in new])))
        return [b"".join(map(cache.__getitem__, ps)) for ps in pieces]

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_texts([text])[0], dtype="<u4").tolist()

    def decode_bytes(self, ids: bytes) -> bytes:
        """The bytes of ids given as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.vocabulary.tokens.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


def _splitter(pattern: str):
    """A function that cuts a text into the pattern's matches.

    The vocabularies' pattern is run by ``re`` where its classes agree with
    Unicode's ``L``, ``N`` and ``White_Space`` on all characters of the text,
    which is several times as fast, and by ``regex`` elsewhere and for other
    patterns.
    """
    exact = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
    parts = (r" ?\p{L}+", r" ?\p{N}+", r" ?[^\s\p{L}\p{N}]+")
    if not all(p in pattern for p in parts):
        return exact.findall
    quick = pattern
    for part, same in zip(parts, (r" ?[^\W\d_]+", r" ?\d+", r" ?(?:[^\s\w]|_)+")):
        quick = quick.replace(part, same)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    odd: set[str] = set()
    for a, b in ((r"[^\W\d_]", r"\p{L}"), (r"\d", r"\p{N}"), (r"\s", r"\p{White_Space}")):
        odd |= set(re.findall(a, every)) ^ set(regex.findall(b, every))
    fast = re.compile(quick).findall
    return lambda text: fast(text) if odd.isdisjoint(set(text)) else exact.findall(text)


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    """The encoder of a rank file (lines of base64 bytes and rank), made once in a worker."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return Encoder(ranks, pattern)


DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id ids`` (array of int) for every row."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, pattern)
        for b in rows_of(batches, SLICE):
            ids = [np.frombuffer(x, dtype="<u4").astype(np.int32) for x in enc.encode_texts(b.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(ids, type=pa.list_(pa.int32()))], ["doc_id", "ids"])

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every text, decode the ids again, and return counts and digests of both."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, pattern)
        for b in rows_of(batches, SLICE):
            ids = enc.encode_texts(b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("doc_id"),
                    pa.array([len(x) // 4 for x in ids], type=pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
                    pa.array([hashlib.sha256(enc.decode_bytes(x)).hexdigest() for x in ids]),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return id_text(docs, id_col, text_col).mapInArrow(run, DIGESTS)
