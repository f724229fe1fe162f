"""Pairs between components that miss the threshold closely: they are told apart inside tasks and never become rows."""

import random

import numpy as np
import pyarrow as pa
import pytest

from hearth.llm import circulant_minhash, group_join, pair_blocks
from hearth.llm.components import joined

MEMBERS, OUTSIDERS = 90, 40


def _rows(edits):
    """Copies with one edit each, which link, and copies with ``edits`` more, which link with none of them; the last one links with one copy."""
    rng = random.Random(8)
    base = [f"w{k}" for k in range(200)]

    def edited(words, n, free):
        words = list(words)
        for at in rng.sample(free, n):
            words[at] = f"e{rng.randrange(10**9)}"
        return words

    low, high = list(range(6, 60, 6)), list(range(66, 196, 6))
    copies = [edited(base, 1, low) for _ in range(MEMBERS)]
    rows = copies + [edited(base, edits, high) for _ in range(OUTSIDERS)] + [edited(copies[0], edits, high)]
    return [(k + 1, " ".join(words)) for k, words in enumerate(rows)]


def _components(rows, width):
    sets = {k: {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} for k, w in ((k, t.split()) for k, t in rows)}
    root = {k: k for k in sets}
    near = 0
    for b in sorted(sets):
        for a in sorted(sets):
            if a < b and root[a] != root[b]:
                both, every = len(sets[a] & sets[b]), len(sets[a] | sets[b])
                near += 75 * every <= 100 * both < 80 * every
                if 100 * both >= 80 * every:
                    lo, hi = sorted((root[a], root[b]))
                    root = {k: lo if r == hi else r for k, r in root.items()}
    return root, near


@pytest.mark.parametrize(("module", "run", "edits", "width", "block"), [
    (group_join, "jaccard_components", 4, 5, 1024), (group_join, "jaccard_components", 4, 5, 16), (circulant_minhash, "near_duplicates", 5, 4, 1024),
])
def test_pairs_that_miss_the_threshold_are_no_rows(docs_of, monkeypatch, module, run, edits, width, block):
    monkeypatch.setattr(pair_blocks, "BLOCK", block)
    made, between = [], module.between_components

    def counted(*a, **k):
        found = between(*a, **k)
        made.append(found.count())
        return found

    monkeypatch.setattr(module, "between_components", counted)
    rows = _rows(edits)
    expected, near = _components(rows, width)
    assert near > 10 * len(rows)
    assert {r["doc_id"]: r["component_id"] for r in getattr(module, run)(docs_of(rows)).collect()} == expected
    assert made[0] <= len(rows)


def test_links_between_components_match_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(pair_blocks, "BLOCK", 8)
    rng = np.random.default_rng(4)
    base = rng.integers(-(2**62), 2**62, 300)
    sets = {k: np.unique(np.r_[base[rng.random(300) < p], rng.integers(-(2**62), 2**62, 10)]) for k, p in enumerate([0.98] * 30 + [0.86] * 40)}
    sets[70] = np.zeros(0, dtype=np.int64)
    label = {k: 0 for k in range(20)}  # 20 of them are known to be one
    root = {k: label.get(k, k) for k in sets}
    for a in sets:
        for b in sets:
            both = len(np.intersect1d(sets[a], sets[b]))
            if a < b and both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                lo, hi = sorted((root[a], root[b]))
                root = {k: lo if r == hi else r for k, r in root.items()}
    lists = spark.createDataFrame([(key, k) for key in (1, 2, 3) for k in sets], "key long, node long")
    facts = spark.createDataFrame([(k, len(s), bytearray(pair_blocks.bitmap(s))) for k, s in sets.items()], "node long, n long, bits binary")
    whole = spark.createDataFrame([(k, bytearray(s.tobytes())) for k, s in sets.items()], "node long, bytes binary")
    known = spark.createDataFrame(list(label.items()), "node long, component long")
    assert 0 < pair_blocks.ties(lists, known, facts, 80).count() < len(sets) * 8
    found = [tuple(r) for r in pair_blocks.between_components(lists, known, facts, lambda nodes: whole, 80).collect()]
    mine = {k: label.get(k, k) for k in sets}
    for a, b in found:
        lo, hi = sorted((mine[a], mine[b]))
        mine = {k: lo if r == hi else r for k, r in mine.items()}
    assert mine == root and len(set(root.values())) > 2


def test_components_are_joined_by_few_pairs(spark):
    label = spark.createDataFrame([(1, 1), (4, 1), (3, 3), (5, 3), (6, 6), (7, 6)], "node long, component long")
    pairs = lambda rows: spark.createDataFrame(rows, "a long, b long")
    after = {r["node"]: r["component"] for r in joined(label, pairs([(3, 1), (2, 6), (9, 8)])).collect()}
    assert after == {1: 1, 4: 1, 3: 1, 5: 1, 6: 2, 7: 2, 2: 2, 9: 8, 8: 8}
    assert joined(label, pairs([])).count() == 6


def test_a_task_ties_nodes_by_fewer_rows_than_it_reads():
    a, b = (x.reshape(-1) for x in np.meshgrid(np.arange(5, 100), np.arange(100, 180)))
    node, first = pair_blocks._roots(np.r_[a, 7], np.r_[b, 300])
    assert len(node) == 95 + 80 and set(first) == {5}
    node, first = pair_blocks._roots(np.array([1, 3, 8, 4]), np.array([2, 2, 9, 3]))
    assert dict(zip(node.tolist(), first.tolist())) == {2: 1, 3: 1, 4: 1, 9: 8}


def test_sets_of_one_component_are_joined_once():
    s = np.arange(100, dtype=np.int64)
    rows = [(1, 5, False, True, s), (2, 0, True, False, s), (3, 0, True, False, s), (4, 6, False, False, s[:90]), (6, 7, False, False, s[:10]), (7, 8, False, False, s[:0])]
    t = pa.table({**{k: [r[i] for r in rows] for i, k in enumerate(("node", "c", "inner", "outer"))}, "bytes": [r[4].tobytes() for r in rows]})
    a, b = pair_blocks._joining(t, 80)
    assert sorted(zip(a.tolist(), b.tolist())) == [(5, 0), (5, 6)]
