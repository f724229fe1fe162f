import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hearth.llm import chat_masks, multiset_hash

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["<", "s", ">", "/", "[INST]", "[/INST]", "\\", "</s>", "<s>", "<<SYS>>", "<</SYS>>", "a", "<|endoftext|>"]), max_size=10))
def test_escape_is_undone_and_hides_marks(parts):
    text = "".join(parts)
    hidden = chat_masks.escape(text)
    assert chat_masks.unescape(hidden) == text
    assert not any(c in hidden for c in chat_masks.CONTROL)


def _expected(rows):
    by = {}
    for c, t, r, x in rows:
        by.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    out = {}
    for c, turns in by.items():
        turns.sort()
        loss = "".join(x for _, _, r, x in turns if r == "assistant")
        turns_sha = hashlib.sha256("".join(f"{r}\n{x}\n" for _, _, r, x in turns).encode()).hexdigest()
        out[c] = (len(turns), turns_sha, len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


@pytest.mark.parametrize("flush", [1 << 20, 50])
def test_digests_are_read_back(spark, monkeypatch, flush):
    rows = [
        (1, 0, "system", "be kind"), (1, 1, "user", "hé 日本 \U0001f600?"), (1, 2, "assistant", "naïve 日本\U0001f600 </s> yes"), (1, 2, "assistant", "tie"),
        (1, 2, "assistant", "tie"), (2, 0, "user", None), (2, 1, "assistant", ""), (3, None, None, "x"), (None, 0, "assistant", "alone"),
        (4, 0, "assistant", "long " * 5000), (-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]"),
        (5, 0, "us</s>er", "<\\/s>"), (5, 1, "assistant", "a"), (5, 2, "assistant", "b"),
    ]
    monkeypatch.setattr(chat_masks, "FLUSH", flush)
    table = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, n_turns string")
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat_masks.format_digests(table, TOKENIZER).collect()}
    assert got == _expected(rows)
    assert chat_masks.format_digests(table.limit(0), TOKENIZER).count() == 0


def test_mask_covers_exactly_the_learned_tokens(spark):
    rows = [(1, 0, "user", "question"), (1, 1, "assistant", "answer one"), (1, 2, "user", "more"), (1, 3, "assistant", "two")]
    r = chat_masks.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), TOKENIZER).first()
    t = chat_masks.tokenizer(TOKENIZER)
    learned = [i for i, m in zip(r.ids, r.loss_mask) if m]
    assert t.decode(learned) == "answer onetwo"
    assert np.array(r.loss_mask).sum() < len(r.ids)


def test_multiset_hash_is_homomorphic(spark):
    def vector(text):
        return multiset_hash.fingerprints(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().vector

    a, b, both, swapped = vector("One.\nTwo!"), vector("Three?\n"), vector("One.\nTwo!Three?\n"), vector("Three?\nOne.\nTwo!")
    row = spark.createDataFrame([(a, b, both)], "a array<long>, b array<long>, c array<long>")
    assert row.select(multiset_hash.insert(F.col("a"), F.col("b"))).first()[0] == both == swapped
    assert row.select(multiset_hash.delete(F.col("c"), F.col("b"))).first()[0] == a != b


def test_next_and_edited_documents(docs_of, odd_rows):
    rows = odd_rows + [(1000 + i, f"Line {i}. Next {i}!") for i in range(0, 900, 3)] + [(10**12, "far away.")]
    got = multiset_hash.edited_documents(docs_of(rows).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))).collect()
    clean = sorted(((i, t or "") for i, t in rows), key=lambda r: r[1], reverse=True)
    clean.sort(key=lambda r: -(10**18) if r[0] is None else r[0], reverse=True)
    expect = []
    for k, (i, t) in enumerate(clean):
        half, follow = len(t) // 2, clean[(k + 1) % len(clean)][1]
        expect.append((i, len(t), hashlib.sha256((t[: len(t) - half] + follow[:half]).encode()).hexdigest()))
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=str) == sorted(expect, key=str)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    prints = {}
    for r in got:
        prints.setdefault(r.doc_id, set()).add(r.fingerprint)
    assert prints[2] == prints[9] and len(prints[5]) == 1
    assert multiset_hash.edited_documents(docs_of(rows).select("doc_id", "text").limit(0)).count() == 0
