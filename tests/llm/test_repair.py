import hashlib
import heapq
import random
import re
import zlib

import pytest

from hearth.llm import glr_repair as G

SCHEMA = "conv_id long, turn long, role string, text string"
WHITE = " \t\n\x0b\x0c\r"


def _damage(rows):
    out = []
    for conv, turn, role, text in rows:
        show = lambda v: " " if v is None else str(v)
        kind = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        role, text = show(role), show(text)
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def _faults(rows):
    seen, out = set(), []
    for role, text in rows:
        rest = text.rstrip(WHITE)
        out.append("b" if not rest else "d" if (role, text) in seen else "t" if rest[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def _cheapest(turns):
    """Least (cost, audit) over all edits, by uniform-cost search over (turns read, roles so far as a state of the pattern)."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "", ("p", "u"): "u"}
    go = lambda state, r: "p" if (state, r) == ("u", "a") else step.get((state, r))
    heap, done = [(0, "", 0, "")], set()
    while heap:
        cost, audit, at, state = heapq.heappop(heap)
        if (at, state) in done:
            continue
        if at == len(turns) and state in ("", "p"):
            return cost, audit
        done.add((at, state))
        for r in "ua":
            if go(state, r) is not None:
                heapq.heappush(heap, (cost + 5, audit + "I", at, go(state, r)))
        if at < len(turns):
            initial, fault = turns[at]
            heapq.heappush(heap, (cost + 2, audit + "D", at + 1, state))
            if fault not in ("b", "d"):
                more = 5 * (fault == "t")
                for r, c, e in ((initial, 0, "K"), ("u", 1, "R"), ("a", 1, "R")):
                    if go(state, r) is not None:
                        heapq.heappush(heap, (cost + c + more, audit + e, at + 1, go(state, r)))


def _expected(rows, hurt):
    out = {}
    for conv in {r[0] for r in rows}:
        mine = sorted([r for r in hurt if r[0] == conv], key=lambda r: (r[1] is not None, r[1] or 0, r[2][:64], r[3][:64], hashlib.md5(f"{len(r[2])}:{r[2]}:{r[3]}".encode()).digest()))
        fault = _faults([r[2:] for r in mine])
        turns = [r[1] for r in mine if r[1] is not None]
        roles = [r[2][:1] for r in mine]
        cost, audit = _cheapest(list(zip(roles, fault)))
        left, stream, state = [], iter(mine), ""
        for e in audit:
            role, text = ("", "") if e == "I" else next(stream)[2:]
            if e == "D":
                continue
            role = role if e == "K" else "assistant" if state == "u" else "user"
            state = role[:1]
            left.append(f"{role}:{text}")
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, fault.count("b"), fault.count("d"), fault.count("t"),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:])), cost, audit, hashlib.sha256("\n".join(left).encode()).hexdigest(),
        )
    return out


def _conversations(seed, n=120):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(rng.randrange(9)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None])
            rows.append((conv, rng.choice([turn, turn + 2, None]) if rng.random() < 0.2 else turn, role, rng.choice(["Yes.", "no", "", " \n", "Well? ", "a b c!", None, "one. two", "x" * 70 + rng.choice("ab")])))
    return rows


def _got(df):
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    rows = df.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r[k] for k in names) for r in rows}


@pytest.mark.parametrize("seed", [1, 2])
def test_query_matches_search(spark, seed):
    rows = _conversations(seed) + [(None, 1, "user", "Hi."), (None, None, "assistant", "Ho!"), (500, None, "user", "A.")]
    table = spark.createDataFrame(rows, SCHEMA).withColumns({"key": G.F.lit(1), "fault": G.F.lit("x"), "audit": G.F.lit("K"), "of": G.F.lit(0)})
    assert _got(G.repair_digests(table)) == _expected(rows, _damage(rows))


def test_a_conversation_over_many_tasks(spark):
    rng = random.Random(9)
    rows = [(7, t, rng.choice(["user", "assistant", "user", "assistant", "system"]), rng.choice([f"Text {t}.", f"cut {t}", "Same."])) for t in range(4000)]
    rows += [(8, None, rng.choice(["user", "assistant"]), f"All null {t}.") for t in range(1500)] + [(c, 0, "user", "Alone.") for c in range(9, 40)]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        table = spark.createDataFrame(rows, SCHEMA).repartition(5)
        got = _got(G.repair_digests(table))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert got == _expected(rows, _damage(rows))


def test_tables_of_parts_combine():
    rng = random.Random(4)
    for _ in range(200):
        turns = [(rng.choice("suat"), rng.choice(["", "", "t", "b", "d"])) for _ in range(rng.randrange(14))]
        cut = sorted(rng.randrange(len(turns) + 1) for _ in range(2))
        whole = G.Parse()
        for part in (turns[: cut[0]], turns[cut[0] : cut[1]], turns[cut[1] :]):
            p = G.Parse()
            for t in part:
                p.turn(*t)
            whole.append(p.table(), 1)
        assert G.cheapest(whole.table()) == _cheapest(turns)


def test_repaired_turns_fit_the_grammar(spark):
    rows = _conversations(5, 60)
    table = spark.createDataFrame([(c, t, r or " ", x or " ") for c, t, r, x in rows], SCHEMA)
    by = {}
    for r in G.repair(table).orderBy("conv_id", "position").collect():
        by.setdefault(r.conv_id, []).append(r)
    assert by and all(re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in rs)) for rs in by.values())
    assert all([r.position for r in rs] == list(range(len(rs))) for rs in by.values())
    assert all(r.text == "" for rs in by.values() for r in rs if r.edit == "I")
    same = spark.createDataFrame([(1, 0, "user", "Hi."), (1, 1, "assistant", "Yes."), (2, 0, "system", "S."), (2, 1, "user", "Q?"), (2, 2, "assistant", "A!")], SCHEMA)
    assert {r.edit for r in G.repair(same).collect()} == {"K"}


def test_nothing_left(spark):
    assert G.repair_digests(spark.createDataFrame([], SCHEMA)).count() == 0
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = _got(G.repair_digests(spark.createDataFrame([(gone, 0, "user", "Hi.")], SCHEMA)))
    assert got == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_long_texts_and_many_turns_of_one_kind(spark):
    rows = [(1, t, "user", "w" * 200_000 + ".") for t in range(3)] + [(2, t, "assistant", "Same.") for t in range(600)]
    assert _got(G.repair_digests(spark.createDataFrame(rows, SCHEMA))) == _expected(rows, _damage(rows))
