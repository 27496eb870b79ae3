from __future__ import annotations

import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgermill.llm import packing, tokens
from ledgermill.llm.tokens import Encoder


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 1024), st.integers(0, 500), max_size=60))
def test_plan_places_every_item(counts):
    bins = packing.plan(counts)
    placed = Counter()
    for n, content in bins:
        assert n > 0 and sum(s * k for s, k in content.items()) <= 1024
        assert sum(k for s, k in content.items() if 3 * s > 1024) <= 2
        for s, k in content.items():
            placed[s] += n * k
    assert placed == Counter({s: n for s, n in counts.items() if n})


def test_plan_is_tight_and_does_not_grow_with_counts():
    uniform = {s: 1000 for s in range(1, 1025)}
    bins = packing.plan(uniform)
    tokens = sum(s * n for s, n in uniform.items())
    assert sum(n for n, _ in bins) <= 1.005 * tokens / 1024
    assert len(packing.plan({s: 10**9 for s in range(1, 1025)})) == len(packing.plan({s: 1000 for s in range(1, 1025)}))
    assert packing.plan({}) == []
    with pytest.raises(ValueError):
        packing.plan({1025: 1})


def full_ids(text):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_files()["tokenizer_file"])
    return tokenizer.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("aB1.'s \n\téß中𝔸  <|>")), max_size=60))
def test_pieces_encode_as_whole_texts(text):
    got = np.frombuffer(ENCODER.packed(text), "<u4").tolist()
    assert got == FULL.encode(text, add_special_tokens=False).ids


ENCODER = Encoder(**packing.tokenizer_files())
FULL = ENCODER.full


def test_special_token_string():
    text = "before <|endoftext|> after"
    assert np.frombuffer(ENCODER.packed(text), "<u4").tolist() == full_ids(text)


def test_packed_documents(spark, documents, odd_rows):
    rows = odd_rows
    out = packing.pack_documents(documents(rows), keep_ids=True).collect()
    want = Counter()
    for r in rows:
        ids = full_ids(r[1]) + [2]
        cuts = [0, *([len(ids) % 1024] if len(ids) % 1024 else [])]
        while cuts[-1] < len(ids):
            cuts.append(cuts[-1] + 1024)
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            crc = zlib.crc32(np.array(ids[a:b], "<u4").tobytes())
            want[r[0], piece, a, b - a, crc] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == want
    assert all(len(r.ids) == r.length for r in out)
    held = defaultdict(list)
    for r in out:
        held[r.sequence_id].append((r.offset, r.length))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024


def test_empty_table(spark, documents):
    assert packing.pack_documents(documents([])).count() == 0


def test_caches_are_bounded_by_bytes(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_BYTES", 50_000)
    some = tokens.Encoder(**packing.tokenizer_files())
    whole = lambda t: some.full.encode(t, add_special_tokens=False).ids
    for i in range(300):
        text = f"{'ab' * 300}{i} {'字' * 300}{i} {'xy' * 2000}{i} tail"
        if i % 50 == 0:
            assert np.frombuffer(some.packed(text), "<u4").tolist() == whole(text)
        else:
            some.packed(text)
        for cache in (some.first, some.rest):
            assert cache.held <= 50_000 and sum(map(sys.getsizeof, cache)) <= cache.held
            assert max(map(len, cache), default=0) <= tokens.LONG_PIECE
