import collections
import hashlib
import random

import numpy as np

from hearth.llm import group_join, repeat_removal
from hearth.llm.components import components


def _words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for s in "\t\n\v\f\r":
        low = low.replace(s, " ")
    return [w for w in low.split(" ") if w]


def _shingles(text):
    w = _words(text)
    return frozenset(" ".join(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([" ".join(w)] if w else [])


def _near_copies(seed=3, copies=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    rows, base, line = [], text(80), text(9)
    for k in range(copies):
        words = list(base)
        for _ in range(rng.randrange(5)):
            words[rng.randrange(len(words))] = f"edit{rng.randrange(10**6)}"
        rows.append(words)
    rows += [text(rng.randrange(1, 60)) + line for _ in range(40)]  # unlike texts that share a line
    rows += [rows[0], rows[-1], ["one", "two"], ["One", "two"], text(4)]
    rows += [r + text(3) for r in rows[60:75]]
    rng.shuffle(rows)
    return [(i * 3 + 1, "  ".join(r)) for i, r in enumerate(rows)]


def _brute(rows):
    sets = {}
    for i, t in rows:
        sets.setdefault(i, []).append(_shingles(t))
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and any(x and y and 100 * len(x & y) >= 80 * len(x | y) for x in sets[a] for y in sets[b]):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {i: find(i) for i in ids}


def test_components_match_all_pairs(docs_of):
    rows = _near_copies()
    expect = _brute(rows)
    got = group_join.jaccard_components(docs_of(rows)).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: r.component_id for r in got} == expect
    text = dict(rows)
    assert all(r.n_shingles == len(_shingles(text[r.doc_id])) for r in got)
    assert 1 < len(set(expect.values())) < len(rows)


def test_join_over_odd_rows(docs_of, odd_rows):
    rows = odd_rows + [(11, "ONE two"), (5, "another text of the same id now")]
    got = group_join.jaccard_components(docs_of(rows)).collect()
    assert len(got) == len(rows)
    component = {(r.doc_id, r.n_shingles): r.component_id for r in got}
    assert component[11, 1] == 4 and component[4, 1] == 4
    assert component[1, 0] == 1 and component[3, 0] == 3
    assert component[5, 2] == 5
    assert group_join.jaccard_components(docs_of(rows).limit(0)).count() == 0


def test_keep_one_keeps_clean_documents(docs_of):
    rows = _near_copies(5, 30)
    expect = _brute(rows)
    kept = group_join.keep_one(docs_of(rows))
    assert kept.columns == docs_of(rows).columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for c in expect.values()})


def test_keep_one_keeps_other_texts_of_a_doc_id(docs_of):
    rng = random.Random(8)
    a, b, c, d = (" ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") + str(rng.randrange(50)) for _ in range(60)) for _ in range(4))
    near = b + " end"
    rows = [(1, a), (2, a), (2, b), (3, near), (2, c), (2, c), (4, d), (4, d + " end"), (4, d.upper()), (None, near + " more"), (None, a + " x"), (None, "alone without an id"), (5, None), (5, "")]
    rows += [(10, a + " one"), (10, d + " two"), (6, c + " three")]
    kept = sorted(((r.doc_id, r.text) for r in group_join.keep_one(docs_of(rows)).collect()), key=str)
    stays = [t for i, t in kept if i == 4]
    assert len(stays) == 1 and stays[0] in (d, d + " end", d.upper())
    assert kept == sorted([(1, a), (2, b), (2, c), (4, stays[0]), (None, "alone without an id"), (5, None), (5, "")], key=str)


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    got = {r.node: r.component for r in components(links).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def _removed(rows):
    n = repeat_removal.LENGTH
    count = collections.Counter((t or "").encode()[s : s + n] for _, t in rows for s in range(len((t or "").encode()) - n + 1))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        steps = np.zeros(len(b) + 1, dtype=int)
        for s in range(len(b) - n + 1):
            if count[b[s : s + n]] > 1:
                steps[s] += 1
                steps[s + n] -= 1
        gone = np.cumsum(steps[:-1]) > 0
        kept = bytes(np.frombuffer(b, np.uint8)[~gone]) if b else b""
        out.append((i, len(b), int(gone.sum()), int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def _repeats():
    rng = random.Random(11)
    text = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    passage, long = text(420), text(2500)
    rows = [text(rng.randrange(50, 900)) for _ in range(12)]
    rows += [text(k) + passage + text(50) for k in range(0, 300, 37)]  # just over the length, at all offsets
    rows += [text(30) + passage[:399] + "#" + text(20), text(10) + passage[10:409]]  # one byte short
    rows += [long, long[:1200] + "X" + long[1201:], long[300:2000], long + long, "-" * 1500, "=" * 380, "ab" * 700, "-" * 450]
    return [(i, t) for i, t in enumerate(rows)]


def test_removed_bytes_match_brute_force(docs_of):
    rows = _repeats()
    got = repeat_removal.remove_repeats(docs_of(rows))
    assert sorted((tuple(r)[:5] for r in got.collect()), key=str) == _removed(rows)


def test_removal_over_odd_rows(docs_of, odd_rows):
    rows = odd_rows[:8] + odd_rows[9:] + [(12, "Größe ½ naïve 日本語 \U0001f600 " * 30), (12, "word " * 300)]
    got = repeat_removal.remove_repeats(docs_of(rows))
    assert sorted((tuple(r)[:5] for r in got.collect()), key=str) == _removed(rows)
    assert repeat_removal.remove_repeats(docs_of(rows).limit(0)).count() == 0
