"""Conversation structure repair by generalised LR parsing.

The role grammar is ``C -> e | S``, ``S -> s L | L``, ``L -> L P | P``, ``P -> u a``: an optional system turn, then pairs of
user and assistant.  A parser with this grammar's shift table reads a conversation's turns and branches at each
one: it keeps the turn (0), reroles it to user or assistant (1), deletes it (2; the only way for blank and
duplicate turns) and inserts empty user or assistant turns anywhere (5); truncated turns that stay cost 5 more.
All branches live in one graph-structured stack.  What lies below a top never decides what may follow (a pair
is reduced as soon as its ``a`` is shifted), so stacks with equal tops merge, and the one of the least (cost, audit)
stays.  Of equal costs neither audit is a prefix of the other, so the order of audits does not change by what follows.

What a run of turns does to the stack is therefore a table from top to top, and tables of consecutive runs combine
to the table of both.  That makes the parse a distributed one: turns are range-partitioned by conversation
and turn, each task parses its pieces (from every top where a conversation goes on from another task), and a
conversation's few pieces combine in order.  Facts of turns move without their texts; texts move once, to be repaired.

Defined cases: null conv_id is a conversation of its own; other nulls read as one space; an empty text is blank; repeated
rows are duplicates from the second on; rows of one turn go by role and text (first 64 code points, then
digest); roles count by their first code point; conversations without a turn have zeros, an empty audit and the
empty string's digest; an empty table gives no rows; other columns are ignored; texts and conversations may have
any length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearth.llm.common import checkpoint, rows_of, ship

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Top of the stack after a shift (and the reduction that it allows): bottom, system, user, pairs.
SHIFT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("P", "u"): "u", ("u", "a"): "P"}
TOPS, ACCEPTED = ("", "s", "u", "P"), ("", "P")
ROLES = {"u": "user", "a": "assistant"}
#: Turns that are parsed one by one; longer runs combine tables.
RUN = 256
SPACE = " \t\n\x0b\x0c\r"
SORT = ["conv_id", "turn", "r64", "t64", "key"]

Best = tuple[int, str]  # cost, audit
Table = dict[str, dict[str, Best]]


def _offer(tops: dict[str, Best], top: str | None, cost: int, audit: str) -> bool:
    if top is None or (top in tops and tops[top] <= (cost, audit)):
        return False
    tops[top] = (cost, audit)
    return True


def inserted(tops: dict[str, Best]) -> dict[str, Best]:
    """The stack with all turns that may be inserted here."""
    out = dict(tops)
    again = True
    while again:
        again = False
        for top, (cost, audit) in list(out.items()):
            for role in ROLES:
                again |= _offer(out, SHIFT.get((top, role)), cost + INSERT, audit + "I")
    return out


def read_turn(tops: dict[str, Best], initial: str, fault: str) -> dict[str, Best]:
    """The stack after one turn of the role ``initial``; ``fault``: ``b``, ``d``, ``t`` or empty."""
    out: dict[str, Best] = {}
    more = TRUNCATED if fault == "t" else 0
    for top, (cost, audit) in inserted(tops).items():
        _offer(out, top, cost + DELETE, audit + "D")
        if fault not in ("b", "d"):
            _offer(out, SHIFT.get((top, initial)), cost + KEEP + more, audit + "K")
            for role in ROLES:
                _offer(out, SHIFT.get((top, role)), cost + REROLE + more, audit + "R")
    return out


def combine(first: Table, second: Table) -> Table:
    """The table of two runs of turns, one after the other."""
    out: Table = {}
    for start, tops in first.items():
        row: dict[str, Best] = {}
        for middle, (cost, audit) in tops.items():
            for end, (c, a) in second.get(middle, {}).items():
                _offer(row, end, cost + c, audit + a)
        out[start] = row
    return out


class Parse:
    """The table of a run of turns that grows; its parts double in size, so no audit is copied more than log(n) times."""

    def __init__(self, starts: Iterable[str] = TOPS):
        self.starts, self.parts, self.n, self.open = tuple(starts), [], 0, {}
        self._begin(self.starts)

    def _begin(self, starts: Iterable[str]) -> None:
        self.open, self.n = {s: {s: (0, "")} for s in starts}, 0

    def turn(self, initial: str, fault: str) -> None:
        if self.n == RUN:
            self._close()
            self._begin(TOPS)
        self.open = {s: read_turn(tops, initial, fault) for s, tops in self.open.items()}
        self.n += 1

    def _close(self) -> None:
        self.append(self.open, 1)

    def append(self, table: Table, size: int) -> None:
        self.parts.append((table, size))
        while len(self.parts) > 1 and self.parts[-2][1] <= self.parts[-1][1]:
            (a, m), (b, n) = self.parts[-2:]
            self.parts[-2:] = [(combine(a, b), m + n)]

    def table(self) -> Table:
        parts = [t for t, _ in self.parts] + ([self.open] if self.n or not self.parts else [])
        while len(parts) > 1:
            parts[-2:] = [combine(*parts[-2:])]
        return parts[0]


def cheapest(table: Table) -> Best:
    """Cost and audit of a whole conversation's table."""
    tops = inserted(table[""])
    return min(tops[t] for t in ACCEPTED if t in tops)


def repaired(audit: str, turns: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """``edit role text`` of every turn that the audit leaves or inserts, from the turns (role, text) in order."""
    top = ""
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(turns)
        if edit == "D":
            continue
        if edit != "K":
            initial = next(r for r in ROLES if (top, r) in SHIFT)
            role = ROLES[initial]
        top = SHIFT[top, role[:1]]
        yield edit, role, text


def damage(turns: DataFrame) -> DataFrame:
    """``conv_id turn role text`` after the contract's damage, by crc32 of ``conv_id:turn`` modulo 20."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    t = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), space("role").alias("role"), space("text").alias("text"))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    t = t.withColumn("kind", kind).where("kind <> 0")
    text = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role"))
    times = F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return t.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("copy")).drop("copy")


def _keyed(turns: DataFrame) -> DataFrame:
    """``turns`` with what orders the rows of one turn, and a digest that tells equal rows of a conversation."""
    key = F.unhex(F.md5(F.concat_ws(":", F.length("role"), "role", "text")))
    return turns.withColumns({"r64": F.substring("role", 1, 64), "t64": F.substring("text", 1, 64), "key": key})


def faults(turns: DataFrame) -> DataFrame:
    """``conv_id turn r64 t64 key initial fault`` of every row of ``turns`` (``conv_id turn role text``), without the texts."""
    rest = F.rtrim("text", F.lit(SPACE))
    facts = _keyed(turns).select(
        *SORT, F.substring("role", 1, 1).alias("initial"),
        F.when(rest == "", "b").when(~F.right(rest, F.lit(1)).isin(".", "!", "?"), "t").otherwise("").alias("own"),
    )
    # a row was seen earlier if it is not its conversation's first of that role and text; equal rows of one turn come next to each other
    firsts = facts.groupBy("conv_id", "key").agg(F.min(F.struct(F.col("turn").isNotNull().alias("later"), F.col("turn").alias("at"))).alias("first"))
    firsts = firsts.select(F.col("conv_id").alias("_conv"), F.col("key").alias("_key"), F.col("first.at").alias("at"))
    met = facts.join(firsts, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("key") == F.col("_key")))
    late = ~F.col("turn").eqNullSafe(F.col("at"))
    return met.select(*SORT, "initial", F.when(F.col("own") == "b", "b").when(late, "d").otherwise(F.col("own")).alias("fault"))


_MOVES = pa.list_(pa.struct([("start", pa.string()), ("end", pa.string()), ("cost", pa.int64()), ("audit", pa.string())]))
_PIECE = pa.schema(
    [("conv_id", pa.int64()), ("part", pa.int32()), ("rows", pa.int64()), ("first", pa.string()), ("last", pa.string())]
    + [(k, pa.int64()) for k in ("illegal", "blank", "duplicate", "truncated", "lo", "hi", "turns")]
    + [("moves", _MOVES)]
)
_PIECE_SQL = (
    "conv_id long, part int, rows long, first string, last string, illegal long, blank long, duplicate long, truncated long, "
    "lo long, hi long, turns long, moves array<struct<start: string, end: string, cost: long, audit: string>>"
)
_LEGAL = {"su", "ua", "au"}


def _piece(conv: int | None, part: int, rows: Iterator[tuple], starts: Iterable[str]) -> dict:
    """One task's part of a conversation: counts, what its ends show, and its table.  ``rows``: turn, key, initial, fault."""
    parse, n, first, last, illegal, lo, hi, turns = Parse(starts), 0, None, None, 0, None, None, 0
    count = {"b": 0, "d": 0, "t": 0, "": 0}
    before = None
    for turn, key, initial, fault in rows:
        if fault != "b" and before == (turn, key):
            fault = "d"  # the row before is equal
        before = (turn, key)
        parse.turn(initial, fault)
        count[fault] += 1
        illegal += n > 0 and last + initial not in _LEGAL
        first, last, n = initial if n == 0 else first, initial, n + 1
        if turn is not None and turn != hi:
            lo, hi, turns = turn if lo is None else lo, turn, turns + 1
    moves = [{"start": s, "end": e, "cost": c, "audit": a} for s, tops in parse.table().items() for e, (c, a) in tops.items()]
    return {
        "conv_id": conv, "part": part, "rows": n, "first": first, "last": last, "illegal": illegal, "blank": count["b"], "duplicate": count["d"],
        "truncated": count["t"], "lo": lo, "hi": hi, "turns": turns, "moves": moves,
    }


def _pieces(facts: DataFrame) -> DataFrame:
    """One row for each conversation in each partition of ``facts`` (a checkpoint, in order, with ``part``)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for b in batches:
            yield from zip(*(b.column(c).to_pylist() for c in ("conv_id", "part", "turn", "key", "initial", "fault")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        starts: Iterable[str] = TOPS  # the first one may go on from another task
        for (conv, part), group in groupby(rows(batches), key=lambda r: r[:2]):
            held.append(_piece(conv, part, (r[2:] for r in group), starts))
            starts = ("",)
            if len(held) >= 1 << 10:
                yield pa.RecordBatch.from_pylist(held, schema=_PIECE)
                held = []
        if held:
            yield pa.RecordBatch.from_pylist(held, schema=_PIECE)

    return facts.mapInArrow(run, _PIECE_SQL)


_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _whole(conv: int | None, pieces: list[dict]) -> dict:
    """A conversation from its pieces in order."""
    out = {"conv_id": conv, **{k: sum(p[k] for p in pieces) for k in ("blank", "duplicate", "truncated", "illegal")}}
    parse = Parse()
    turns, lo, hi, last = 0, None, None, None
    for k, p in enumerate(pieces):
        table: Table = {}
        for m in p["moves"]:
            table.setdefault(m["start"], {})[m["end"]] = (m["cost"], m["audit"])
        parse.append(table, 1)
        out["illegal"] += k > 0 and last + p["first"] not in _LEGAL
        last = p["last"]
        if p["lo"] is not None:
            turns += p["turns"] - (p["lo"] == hi)
            lo, hi = p["lo"] if lo is None else lo, p["hi"]
    cost, audit = cheapest(parse.table())
    return out | {"gaps": hi - lo + 1 - turns if turns else 0, "cost": cost, "audit": audit}


def audits(turns: DataFrame, original: DataFrame) -> DataFrame:
    """``conv_id gaps blank duplicate truncated illegal cost audit``: one row for every conv_id of ``original``, from the rows of ``turns``."""
    spark = turns.sparkSession
    ship(spark)
    facts = faults(turns).repartitionByRange(*SORT).sortWithinPartitions(*SORT)  # ascending: nulls first
    facts = checkpoint(facts.select("conv_id", "turn", "key", "initial", "fault", F.spark_partition_id().alias("part")), spark)
    pieces = _pieces(facts).unionByName(original.select(F.col("conv_id").cast("long").alias("conv_id")).distinct(), allowMissingColumns=True)
    fields = [f for f in _PIECE.names if f != "conv_id"]
    # a conversation has a piece in each of a few neighbouring partitions, and the row that names it
    together = pieces.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("pieces"))
    schema = pa.schema([("conv_id", pa.int64()), *[(k, pa.int64()) for k in _COUNTS], ("audit", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows_of(batches):
            found = [_whole(c, [p for p in ps if p["part"] is not None]) for c, ps in zip(b.column("conv_id").to_pylist(), b.column("pieces").to_pylist())]
            yield pa.RecordBatch.from_pylist(found, schema=schema)

    return together.mapInArrow(run, f"conv_id long, {', '.join(f'{k} long' for k in _COUNTS)}, audit string")


def _with_turns(turns: DataFrame, found: DataFrame) -> DataFrame:
    """The turns of each conversation in order, after one row with its audit."""
    rows = _keyed(turns).withColumn("of", F.lit(1)).unionByName(found.withColumn("of", F.lit(0)), allowMissingColumns=True)
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "of", *SORT[1:])


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, Iterator[tuple[str, str]]]]:
    """Each conversation's audit row and its turns (role, text), read as they come."""

    def rows() -> Iterator[dict]:
        for b in rows_of(batches):
            yield from b.to_pylist()

    for _, group in groupby(rows(), key=lambda r: r["conv_id"]):
        yield next(group), ((r["role"], r["text"]) for r in group)


def repair(turns: DataFrame) -> DataFrame:
    """``conv_id position edit role text``: the repaired turns of every conversation, in order."""
    names, types = ["conv_id", "position", "edit", "role", "text"], [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for row, stream in _streams(batches):
            for position, (edit, role, text) in enumerate(repaired(row["audit"], stream)):
                held.append((row["conv_id"], position, edit, role, text))
                size += len(text) + 64
                if size >= 1 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)

    t = turns.select("conv_id", "turn", "role", "text")
    return _with_turns(t, audits(t, t)).mapInArrow(run, "conv_id long, position long, edit string, role string, text string")


def repair_digests(turns: DataFrame) -> DataFrame:
    """One row for each conv_id of ``turns``, whose rows are damaged first: counts of faults, the audit and the digest of the
    repaired turns, which are hashed as they are read."""
    hurt = damage(turns)
    found = audits(hurt, turns)
    schema = pa.schema([("conv_id", pa.int64()), *[(k, pa.int64()) for k in _COUNTS], ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for row, stream in _streams(batches):
            digest, between = hashlib.sha256(), b""
            for _, role, text in repaired(row["audit"], stream):
                digest.update(between + f"{role}:{text}".encode("utf-8", "surrogatepass"))
                between = b"\n"
            held.append({**{k: row[k] for k in ("conv_id", *_COUNTS, "audit")}, "repaired_sha256": digest.hexdigest()})
            if len(held) >= 1 << 10:
                yield pa.RecordBatch.from_pylist(held, schema=schema)
                held = []
        if held:
            yield pa.RecordBatch.from_pylist(held, schema=schema)

    return _with_turns(hurt, found).mapInArrow(run, f"conv_id long, {', '.join(f'{k} long' for k in _COUNTS)}, audit string, repaired_sha256 string")
