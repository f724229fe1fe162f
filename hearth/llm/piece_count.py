"""Token counts for a sentencepiece BPE vocabulary by rank-synchronous array merging.

Texts are cut where no piece can reach across (before a run of space marks, at
line breaks when no piece holds one), the cuts' symbols lie one after another
in a ragged numpy array, and every round merges the best-scored pair (the
leftmost of equals) of every sequence at once.  A sequence leaves the arrays
when none of its pairs is a piece; the symbols it has then are its tokens.
Characters that no piece holds count as their UTF-8 bytes (byte fallback).

Only one pair of a sequence is merged in a round because merging all places of
a pair together can differ from the library's order (overlaps such as ``ABAB``
and the equal scores of the space runs).  Sequences longer than ``LONG`` are
merged one by one with a heap in the same order, so they cost n log n.

Spark spreads the rows (``mapInArrow``); a worker holds one slice of texts and
a cache of counts that is emptied at a fixed size and never changes a result.

Defined cases: null and empty texts have 0 bytes and 0 tokens; repeated rows
are kept; other columns are ignored; texts are counted whole.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from hearth.llm.common import id_text, rows_of, ship

LONG = 96
#: Cuts that a worker remembers before it starts anew.
REMEMBERED = 400_000
_NEVER = np.int64(1 << 40)
SPACE = "▁"


class PieceCounter:
    def __init__(self, model_file: str):
        m = sentencepiece.SentencePieceProcessor(model_file=model_file)
        score = {
            m.id_to_piece(i): m.get_score(i)
            for i in range(m.get_piece_size())
            if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i) or m.is_unused(i))
        }
        symbols = sorted(set(score) | {c for p in score for c in p})
        number = {s: i for i, s in enumerate(symbols)}
        rank = {s: i for i, s in enumerate(sorted(set(score.values()), reverse=True))}
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for p, s in score.items():
            for cut in range(1, len(p)):
                if p[:cut] in number and p[cut:] in number:
                    self.pairs[number[p[:cut]], number[p[cut:]]] = rank[s], number[p]
        keys = np.array([a << 32 | b for a, b in self.pairs], dtype=np.int64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.ranks, self.merged = np.array(list(self.pairs.values()), dtype=np.int64)[order].T.copy()
        self.of_char = np.full(0x110000, -1, dtype=np.int32)
        for s, i in number.items():
            if len(s) == 1:
                self.of_char[ord(s)] = i
        inner = any(SPACE in p.lstrip(SPACE) for p in score)  # a piece that holds a space mark after a letter
        lines = any("\n" in p for p in score)
        self.cut = (lambda t: [t]) if inner else re.compile(f"{SPACE}+[^{SPACE}]*" if lines else f"{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+|\n").findall
        self.cache: dict[str, int] = {}

    def _look(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        return np.where(hit, self.ranks[at], _NEVER), self.merged[at]

    def count_cuts(self, cuts: list[str]) -> np.ndarray:
        """Tokens of each cut."""
        size = np.array([len(c) for c in cuts], dtype=np.int64)
        code = np.frombuffer("".join(cuts).encode("utf-32-le"), dtype="<u4").astype(np.int64)
        owner = np.repeat(np.arange(len(cuts)), size)
        sym = self.of_char[code].astype(np.int64)
        known = sym >= 0
        out = np.bincount(
            owner[~known], weights=1 + (code[~known] > 0x7F) + (code[~known] > 0x7FF) + (code[~known] > 0xFFFF), minlength=len(cuts)
        ).astype(np.int64)
        # sequences: runs of known characters of one cut
        starts = known & np.r_[True, ~known[:-1] | (owner[1:] != owner[:-1])]
        seq = (np.cumsum(starts) - 1)[known]
        sym, owner = sym[known], owner[known]
        if not len(sym):
            return out
        first = np.flatnonzero(np.r_[True, seq[1:] != seq[:-1]])
        of_cut, length = owner[first], np.diff(np.r_[first, len(seq)])
        long = length > LONG
        for s in np.flatnonzero(long):
            out[of_cut[s]] += self._one(sym[first[s] : first[s] + length[s]].tolist())
        stay = ~long[seq]
        np.add.at(out, of_cut[~long], self._rounds(sym[stay], np.repeat(np.arange((~long).sum()), length[~long])))
        return out

    def _rounds(self, sym: np.ndarray, seq: np.ndarray) -> np.ndarray:
        """Symbols left of each sequence; seq: 0, 1, ... in order, the sequence of each symbol."""
        count = np.bincount(seq)
        last = np.r_[seq[1:] != seq[:-1], True] if len(seq) else np.zeros(0, dtype=bool)
        rank, made = np.full(len(sym), _NEVER), np.zeros(len(sym), dtype=np.int64)
        pair = np.flatnonzero(~last)
        rank[pair], made[pair] = self._look(sym[pair], sym[pair + 1])
        while len(sym):
            first = np.flatnonzero(np.r_[True, seq[1:] != seq[:-1]])
            run = np.diff(np.r_[first, len(seq)])
            best = np.repeat(np.minimum.reduceat(rank, first), run)
            at = np.flatnonzero((rank == best) & (best < _NEVER))
            at = at[np.r_[True, seq[at[1:]] != seq[at[:-1]]]] if len(at) else at
            sym[at] = made[at]
            last[at] = last[at + 1]
            count[seq[at]] -= 1
            keep = best < _NEVER  # done sequences leave
            keep[at + 1] = False
            place = np.cumsum(keep) - 1
            sym, seq, rank, made, last, at = sym[keep], seq[keep], rank[keep], made[keep], last[keep], place[at]
            before = at[at > 0] - 1
            changed = np.concatenate([at, before[~last[before]]])
            ends = changed[last[changed]]
            rank[ends] = _NEVER
            changed = changed[~last[changed]]
            rank[changed], made[changed] = self._look(sym[changed], sym[changed + 1])
        return count

    def _one(self, sym: list[int]) -> int:
        n = len(sym)
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j >= 0 and (found := self.pairs.get((sym[i], sym[j]))):
                heapq.heappush(heap, (found[0], i, j, sym[i], sym[j], found[1]))

        for i in range(n - 1):
            offer(i, i + 1)
        count = n
        while heap:
            _, i, j, a, b, whole = heapq.heappop(heap)
            if sym[i] != a or sym[j] != b or right[i] != j:
                continue
            sym[i], sym[j], right[i] = whole, -1, right[j]
            if right[i] >= 0:
                left[right[i]] = i
            count -= 1
            offer(left[i], i)
            offer(i, right[i])
        return count

    def count_texts(self, texts: list[str]) -> list[int]:
        """A mark goes before every text that is not empty, as the vocabulary's normalizer puts it."""
        cuts = [self.cut(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        cache = self.cache
        if len(cache) >= REMEMBERED:
            cache.clear()
        new = list(set().union(*cuts).difference(cache)) if cuts else []
        for at in range(0, len(new), 65_536):
            part = new[at : at + 65_536]
            cache.update(zip(part, self.count_cuts(part).tolist()))
        return [sum(map(cache.__getitem__, c)) for c in cuts]


@lru_cache(maxsize=2)
def counter(model_file: str) -> PieceCounter:
    return PieceCounter(model_file)


def token_counts(docs: DataFrame, model_file: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id n_bytes n_tokens over_limit`` for every row."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(model_file)
        for b in rows_of(batches):
            texts = b.column("text").to_pylist()
            n = np.array(c.count_texts(texts), dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([len(t.encode()) for t in texts], type=pa.int64()), pa.array(n), pa.array(n > limit)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
