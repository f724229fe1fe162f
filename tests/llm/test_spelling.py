import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from hearth.llm import trie_frontier as T
from hearth.llm.common import stored


def _words(rows):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}


def _near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def _brute(n):
    form, out = {}, {}
    near = {w: [v for v in n if _near(w, v)] for w in n}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None)
    return out


def _got(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = df.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: tuple(r)[1:] for r in rows}


def _vocabulary(seed, size):
    """Words close to each other: few letters, shared beginnings, runs of one letter, words inside words."""
    rng = random.Random(seed)
    words = {"".join(rng.choice("abé") for _ in range(rng.randrange(6, 10))) for _ in range(size)}
    words |= {"a" * k for k in range(6, 14)} | {"aaaaaa" + "b" * k for k in range(4)} | {"station", "stations", "stationss", "statoin", "sstation", "ststation", "Ünlike", "unlikeÿ"}
    return {w: rng.choice([5, 6, 30, 31, 200, 1200]) for w in words}


@pytest.mark.parametrize("seed", [1, 2])
def test_neighbours_of_a_dense_vocabulary(spark, seed):
    n = _vocabulary(seed, 150)
    table = stored(spark.createDataFrame(list(n.items()), "word string, n long").repartition(3), spark, "words")
    assert _got(T.variants(table)) == _brute(n)


def test_edges_are_made_once(spark):
    n = _vocabulary(3, 120)
    table = spark.createDataFrame(list(n.items()), "word string, n long").repartition(4)
    edges = T.edges(table).collect()
    assert len({(e.parent, e.ch) for e in edges}) == len(edges)
    assert sorted(e.word for e in edges if e.word) == sorted(n)
    assert all((e.word is None) == (e.child is not None) == (e.tail is None) for e in edges)


def test_documents_with_damage(docs_of):
    rng = random.Random(7)
    vocabulary = ["station", "Station", "garden", "gardens", "ÜBERGANG", "übergang", "straße", "strasse", "running", "runing", "short", "a", "naïve", "naïvely"]
    rows = [(i, " ".join(rng.choice(vocabulary) + rng.choice(["", ",", "7", "-x"]) for _ in range(rng.randrange(60)))) for i in range(1, 900)]
    got = _got(T.spelling_variants(docs_of(rows)))
    assert got == _brute(_words(rows))
    assert any(w not in {v.lower() for v in vocabulary} for w in got) or got["runing"][0] in (None, "running")


def test_odd_rows(docs_of, odd_rows):
    rows = odd_rows + [(20 + k, "a" * 300_000 + " " + "b" * 90) for k in range(5)] + [(None, "letters " * 6)]
    assert _got(T.spelling_variants(docs_of(rows))) == _brute(_words(rows))
    assert T.spelling_variants(docs_of(rows).limit(0)).count() == 0
    assert T.spelling_variants(docs_of([(1, None), (2, "")])).count() == 0


def test_counts_do_not_depend_on_passing_on(docs_of, monkeypatch):
    rows = [(i, f"common words{'x' * (i % 5)} letters{'y' * (i % 7)}") for i in range(1, 400)]
    whole = {r.word: r.n for r in T.word_counts(docs_of(rows).select("doc_id", "text")).collect()}
    expect = {w: c for w, c in _all(rows).items()}
    assert whole == expect


def _all(rows):
    out = Counter()
    for doc, text in rows:
        for w in re.findall("[a-z]+", text):
            h = zlib.crc32(f"{doc}:{w}".encode())
            w = w[: h % len(w)] + w[h % len(w) + 1 :] if h % 199 == 0 else w
            out[w] += len(w) >= 6
    return +out


def test_sql_matches(spark):
    import duckdb

    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    expect = {r[0]: (r[1], r[2], r[3], r[4], r[5]) for r in con.execute(f"SELECT word, form, root, n, n_near, form_n FROM ({T.SQL})").fetchall()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").withColumn("word", F.lit("x"))
    assert _got(T.spelling_variants(docs)) == expect and len(expect) > 100
