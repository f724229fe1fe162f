import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import sentencepiece
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from hearth.llm import piece_count, prefix_bpe

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
MODEL = public_tokenizers.path("piece_bpe_32k.model")


def _reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


REFERENCE = _reference()
PIECES = sentencepiece.SentencePieceProcessor(model_file=MODEL)
HARD = [
    "", " ", "  a", "a½b ²x Ⅷ\x1c\x1d y　z", " " * 500 + "x", "a" * 3000, "!?" * 500, "日本語のテキスト" * 20, "\r\n\t \n  x", "'ll 'LL don't",
    "\x85\xa0 a", "١٢٣ ৪", "</s>[INST] <unk> <0x0A> <|endoftext|>", "▁▁a ▁b", "ab\0c",
]


def _mixed(n):
    rng = random.Random(n)
    pick = lambda: chr(rng.choice([rng.randrange(32, 127), rng.randrange(0xA0, 0x3000), rng.randrange(0x10000, 0x1F900), 32, 10]))
    return ["".join(pick() for _ in range(200)) for _ in range(n)]


def test_byte_bpe_equals_library():
    e = prefix_bpe.encoder(RANKS, public_tokenizers.PATTERN)
    for text in HARD + _mixed(80):
        ids = e.encode(text)
        assert ids == REFERENCE.encode_ordinary(text)
        assert e.decode_bytes(np.array(ids, dtype="<u4").tobytes()) == text.encode()


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=60), st.text(max_size=20), st.integers(0, 60), st.integers(0, 60))
def test_prefix_table_append_and_replace_are_exact(text, new, a, b):
    e = prefix_bpe.encoder(RANKS, public_tokenizers.PATTERN)
    data = (text * 3).encode()
    table = prefix_bpe.PrefixTable(e, data)
    table.append(new.encode())
    assert table.last == prefix_bpe.PrefixTable(e, data + new.encode()).last
    start, end = sorted((min(a, len(data)), min(b, len(data))))
    table.replace(start, end, b"edit")
    assert table.last == prefix_bpe.PrefixTable(e, table.data).last


def test_edit_fills_few_entries_anew():
    e = prefix_bpe.encoder(RANKS, public_tokenizers.PATTERN)
    table = prefix_bpe.PrefixTable(e, b"the quick brown fox jumps over the lazy dog. " * 100)
    assert table.replace(200, 205, b"slow") < 600


def test_piece_counts_equal_library():
    c = piece_count.counter(MODEL)
    texts = HARD + _mixed(80) + [" " * k + "a" for k in range(40)] + ["ab" * k for k in range(120)]
    assert c.count_texts(texts) == [len(x) for x in PIECES.encode(texts)]


def test_queries_over_odd_rows(docs_of, odd_rows):
    docs = docs_of(odd_rows)
    counts = piece_count.token_counts(docs, MODEL).collect()
    expect = sorted(((i, len((t or "").encode()), len(PIECES.encode(t or ""))) for i, t in odd_rows), key=str)
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in counts), key=str) == expect
    assert all(r.over_limit == (r.n_tokens > 4096) for r in counts)
    trips = prefix_bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN).collect()
    sha = lambda b: hashlib.sha256(b).hexdigest()
    expect = sorted(
        ((i, len(ids), sha(np.array(ids, dtype="<u4").tobytes()), sha((t or "").encode())) for i, t in odd_rows for ids in [REFERENCE.encode_ordinary(t or "")]),
        key=str,
    )
    assert sorted((tuple(r) for r in trips), key=str) == expect
    assert piece_count.token_counts(docs.limit(0), MODEL).count() == 0
    assert prefix_bpe.encode_documents(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0
