"""Chat formatting with offset-aligned loss masks.

A conversation is rendered as one string, a turn after the other::

    <s>ROLE[INST]TEXT</s>

Control strings inside roles and texts are escaped: a backslash goes after the
first character of ``</s>``, ``[INST]`` and the others of ``CONTROL``, and of
every such string that already has backslashes there, so the escape is undone
exactly and a control string in the output is always the template's own.

The rendered string is encoded once, with offsets, by a tokenizer to which the
template's marks are added as whole tokens.  Turn spans and token spans are
sorted, so the tokens of each assistant text are found by two binary searches;
the loss mask is a flag per token.  All that a query returns is read back from
the rendered string, the offsets and the mask.

Rows are brought together and sorted by (conv_id, turn, role, text) and then
streamed (``mapInArrow``): a worker holds one Arrow slice and the turns of one
conversation up to ``FLUSH`` characters.  A longer conversation is rendered and
encoded in pieces cut between turns; as marks are whole tokens, the pieces'
tokens are those of the whole string.

Defined cases: null roles and texts are empty, a null turn sorts first, a null
conv_id is a conversation of its own; ties are ordered by role, then text;
repeated rows are turns of their own; an empty table has no conversations;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import AddedToken, Tokenizer

from hearth.llm.common import rows_of, ship

OPEN, TEXT, CLOSE = "<s>", "[INST]", "</s>"
#: Strings that have a meaning in chat templates.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|endoftext|>")
LEARNED = "assistant"
#: Characters of a conversation that are rendered and encoded together.
FLUSH = 1 << 20

_RAW = re.compile("|".join(rf"{re.escape(c[0])}\\*{re.escape(c[1:])}" for c in CONTROL))
_ESCAPED = re.compile("|".join(rf"{re.escape(c[0])}\\+{re.escape(c[1:])}" for c in CONTROL))


def escape(text: str) -> str:
    return _RAW.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[0][0] + m[0][2:], text)


def render(turns: list[tuple[str, str]]) -> str:
    return "".join(f"{OPEN}{escape(r)}{TEXT}{escape(t)}{CLOSE}" for r, t in turns)


_TURN = re.compile(f"{re.escape(OPEN)}(.*?){re.escape(TEXT)}(.*?){re.escape(CLOSE)}", re.S)


def parse(rendered: str) -> list[tuple[str, int, int]]:
    """Role and text span of every turn of a rendered string."""
    return [(unescape(m[1]), m.start(2), m.end(2)) for m in _TURN.finditer(rendered)]


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Tokenizer:
    t = Tokenizer.from_file(path)
    t.add_tokens([AddedToken(x, normalized=False, special=False) for x in (OPEN, TEXT, CLOSE)])
    t.no_truncation()
    t.no_padding()
    return t


def loss_mask(rendered: str, offsets: np.ndarray, learned: str = LEARNED) -> np.ndarray:
    """A flag for each token: whether its span meets the text of a learned turn.

    Turn spans are sorted and apart and token spans are sorted, so a span's
    tokens are those between two binary searches.  A token's span is never
    empty, and as marks are tokens of their own it never meets two turns.
    """
    spans = np.array([(s, e) for role, s, e in parse(rendered) if role == learned and e > s], dtype=np.int64).reshape(-1, 2)
    first = np.searchsorted(offsets[:, 1], spans[:, 0], side="right")
    last = np.searchsorted(offsets[:, 0], spans[:, 1], side="left")
    steps = np.zeros(len(offsets) + 1, dtype=np.int64)
    np.add.at(steps, first, 1)
    np.add.at(steps, last, -1)
    return np.cumsum(steps[:-1]) > 0


def masked_text(rendered: str, offsets: np.ndarray, mask: np.ndarray) -> list[str]:
    """The text under the mask, one string for each run of covered characters (tokens of one character's bytes overlap)."""
    chosen, out = offsets[mask], []
    if not len(chosen):
        return out
    starts = np.r_[True, chosen[1:, 0] > np.maximum.accumulate(chosen[:, 1])[:-1]]
    ends = np.r_[np.flatnonzero(starts)[1:], len(chosen)] - 1
    reach = np.maximum.accumulate(chosen[:, 1])
    return [unescape(rendered[a:b]) for a, b in zip(chosen[starts, 0].tolist(), reach[ends].tolist())]


class Conversation:
    """What the query returns of one conversation, gathered piece by piece from the output."""

    def __init__(self, conv_id: int | None, path: str):
        self.conv_id, self.path = conv_id, path
        self.n_turns = self.loss_chars = self.formatted_chars = self.n_tokens = self.loss_tokens = 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.waiting: list[tuple[str, str]] = []
        self.size = 0

    def add(self, role: str, text: str) -> None:
        self.waiting.append((role, text))
        self.size += len(text)
        if self.size >= FLUSH:
            self.flush()

    def flush(self) -> None:
        rendered = render(self.waiting)
        self.waiting, self.size = [], 0
        encoded = tokenizer(self.path).encode(rendered, add_special_tokens=False)
        offsets = np.array(encoded.offsets, dtype=np.int64).reshape(-1, 2)
        mask = loss_mask(rendered, offsets)
        for role, s, e in parse(rendered):
            self.turns.update(f"{role}\n{unescape(rendered[s:e])}\n".encode())
            self.n_turns += 1
        for text in masked_text(rendered, offsets, mask):
            self.loss.update(text.encode())
            self.loss_chars += len(text)
        self.formatted_chars += len(rendered)
        self.n_tokens += len(offsets)
        self.loss_tokens += int(mask.sum())

    def row(self) -> tuple:
        if self.waiting:
            self.flush()
        return (self.conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.formatted_chars, self.n_tokens, self.loss_tokens)


ROW = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_tokens long, loss_tokens long"
_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
_NAMES = [c.split()[0] for c in ROW.split(", ")]


def _ordered(conversations: DataFrame) -> DataFrame:
    rows = conversations.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def format_digests(conversations: DataFrame, path: str) -> DataFrame:
    """One row per conversation, all of it read back from its rendered string, offsets and mask."""
    ship(conversations.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: Conversation | None = None
        for b in rows_of(batches):
            done = []
            for conv_id, role, text in zip(*(b.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if open_ is None or open_.conv_id != conv_id:
                    if open_ is not None:
                        done.append(open_.row())
                    open_ = Conversation(conv_id, path)
                open_.add(role, text)
            if done:
                yield _batch(done)
        if open_ is not None:
            yield _batch([open_.row()])

    return _ordered(conversations).mapInArrow(run, ROW)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows), _TYPES)], _NAMES)


def format_conversations(conversations: DataFrame, path: str) -> DataFrame:
    """The pieces themselves: ``conv_id part formatted ids loss_mask`` (a conversation under ``FLUSH`` characters has one)."""
    ship(conversations.sparkSession)

    def out(conv_id, part, turns):
        rendered = render(turns)
        e = tokenizer(path).encode(rendered, add_special_tokens=False)
        mask = loss_mask(rendered, np.array(e.offsets, dtype=np.int64).reshape(-1, 2))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([conv_id], type=pa.int64()), pa.array([part], type=pa.int64()), pa.array([rendered]),
                pa.array([e.ids], type=pa.list_(pa.int32())), pa.array([mask.tolist()], type=pa.list_(pa.bool_())),
            ],
            ["conv_id", "part", "formatted", "ids", "loss_mask"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun, now, part, turns, size = False, None, 0, [], 0
        for b in rows_of(batches):
            for conv_id, role, text in zip(*(b.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if not begun or conv_id != now or size >= FLUSH:
                    if turns:
                        yield out(now, part, turns)
                    part = part + 1 if begun and conv_id == now else 0
                    begun, now, turns, size = True, conv_id, [], 0
                turns.append((role, text))
                size += len(text)
        if turns:
            yield out(now, part, turns)

    return _ordered(conversations).mapInArrow(run, "conv_id long, part long, formatted string, ids array<int>, loss_mask array<boolean>")
