import random

import numpy as np
import pyarrow as pa
import pytest

from hearth.llm import circulant_minhash as cm
from hearth.llm import pair_blocks
from hearth.llm.group_join import shingle_sets
from tests.llm.test_duplicates import _near_copies, _words


def _shingles(text):
    w = _words(text)
    return frozenset(" ".join(w[i : i + 4]) for i in range(len(w) - 3)) if len(w) >= 4 else frozenset([" ".join(w)] if w else [])


def _brute(rows):
    sets = [(i, _shingles(t)) for i, t in rows]
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (a, x) in enumerate(sets):
        for b, y in sets[:k]:
            if a != b and x and y and 100 * len(x & y) >= 80 * len(x | y):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {i: find(i) for i, _ in rows}


@pytest.mark.parametrize("seed", [3, 4])
def test_components_match_all_pairs(docs_of, seed):
    rows = _near_copies(seed, 80)
    expect = _brute(rows)
    got = cm.near_duplicates(docs_of(rows)).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: r.component_id for r in got} == expect
    text = dict(rows)
    assert all(r.n_shingles == len(_shingles(text[r.doc_id])) and r.kept == (r.doc_id == r.component_id) for r in got)
    assert 1 < len(set(expect.values())) < len(rows)


def test_blocks_of_a_large_bucket(docs_of, monkeypatch):
    """Two chains of copies that the bucket's centre does not reach, with buckets of several blocks."""
    monkeypatch.setattr(pair_blocks, "BLOCK", 8)
    rng = random.Random(6)
    words = [f"w{i}" for i in range(120)]
    rows, chain = [], list(words)
    for k in range(30):  # each a step from the one before, the ends far apart
        chain = list(chain)
        chain[rng.randrange(len(chain))] = f"x{k}"
        rows.append((100 - k, " ".join(chain)))
    rows += [(200 + k, " ".join(words[: 80 + k])) for k in range(20)]
    expect = _brute(rows)
    assert {r.doc_id: r.component_id for r in cm.near_duplicates(docs_of(rows)).collect()} == expect


def test_odd_rows(docs_of, odd_rows):
    rows = odd_rows + [(11, "ONE two"), (5, "another text of the same id now"), (None, "one two"), (12, "another text of the same id now")]
    got = cm.near_duplicates(docs_of(rows)).collect()
    assert len(got) == len(rows)
    by = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in got if r.doc_id is not None}
    assert by[1, 0] == (1, True) and by[3, 0] == (3, True) and by[2, 0] == (2, True)
    assert by[11, 1] == (4, False) and by[4, 1] == (4, True)
    assert by[12, 4] == (5, False) and by[5, 3] == (5, True)
    assert sorted((r.component_id, r.kept) for r in got if r.doc_id is None and r.component_id) == [(4, False)]
    assert [r.kept for r in got if r.doc_id is None and r.component_id is None] == [True]
    assert cm.near_duplicates(docs_of(rows).limit(0)).count() == 0
    kept = cm.keep_one(docs_of(rows))
    assert kept.columns == docs_of(rows).columns and 11 not in {r.doc_id for r in kept.collect()}


def test_coordinates_turn_one_permutation():
    pi = np.random.default_rng(20).permutation(cm.DOMAIN)
    s = shingle_sets(["a b c d e f g h i j k l m n"], width=4)[0]
    with np.errstate(over="ignore"):
        places = ((s.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(int)
    expect = [min(int(pi[(p - k) % cm.DOMAIN]) for p in places) for k in range(50)]
    assert cm.signature(s, 50)[::-1].tolist() == expect


def test_bands_find_links():
    """Of random pairs at the threshold no one misses all bands."""
    rng = np.random.default_rng(5)
    missed = 0
    for _ in range(300):
        both, own = rng.integers(-(2**62), 2**62, 240), rng.integers(-(2**62), 2**62, 60)
        a, b = np.sort(np.r_[both, own[:30]]), np.sort(np.r_[both, own[30:]])
        keys = cm.band_keys(np.stack([cm.signature(a, cm.BANDS * cm.ROWS), cm.signature(b, cm.BANDS * cm.ROWS)]))
        missed += not (keys[0] == keys[1]).any()
    assert missed == 0


def test_bitmaps_lose_no_pair():
    """The bound lets every pair at the threshold through, also of sets whose bitmaps differ in size, and rules most others out."""
    rng = np.random.default_rng(1)
    through, ruled_out = {True: 0, False: 0}, 0
    for _ in range(600):
        n = int(rng.integers(1, 500))
        both = rng.integers(-(2**62), 2**62, n)
        a, b = (np.r_[both, rng.integers(-(2**62), 2**62, int(rng.integers(0, n // 3 + 2)))] for _ in range(2))
        t = pa.table({"node": [1, 2], "c": [1, 2], "n": [len(a), len(b)], "block": [0, 0], "top": [2, 2], "i": [0, 0], "j": [0, 0], "bits": [pair_blocks.bitmap(a), pair_blocks.bitmap(b)]})
        found = len(pair_blocks._compare(t, 80)[0]) == 1
        link = 100 * n >= 80 * (len(a) + len(b) - n)
        assert found or not link
        through[link] += found
        ruled_out += not found
    assert ruled_out > 9 * through[False]
