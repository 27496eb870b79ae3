from __future__ import annotations

import math
from collections import Counter, defaultdict

import pytest

from ledgermill.llm import mixing


def corpus(documents, sizes, words=10):
    rows = []
    for source, n in sizes.items():
        rows += [(len(rows) + i, " ".join(["w"] * (words + i % 3)), source) for i in range(n)]
    return documents(rows)


def test_every_document_is_read_and_none_too_often(spark, documents):
    docs = corpus(documents, {"a": 300, "b": 40, "c": 5})
    mixture, decided = mixing.mix(docs, repetition=3.0)
    rows = mixture.collect()
    times = Counter(r.row for r in rows)
    assert set(times) == {r.doc_id for r in docs.collect()}
    by_source = defaultdict(list)
    for r in rows:
        by_source[r.source].append(r)
    tokens = {s: sum(r.tokens for r in rs if r["pass"] == 0) for s, rs in by_source.items()}
    readings = {s: sum(r.tokens for r in rs) / tokens[s] for s, rs in by_source.items()}
    assert readings["a"] == 1 and max(readings.values()) <= 3.0 + 12 / min(tokens.values())
    assert decided.repetition == pytest.approx(3.0, rel=1e-6) and 0 < decided.exponent < 1


def test_weights_follow_the_exponent_and_the_budget(spark, documents):
    docs = corpus(documents, {"a": 200, "b": 50, None: 20})
    mixture, decided = mixing.mix(docs, entropy=1.0, budget=2000.0, block_tokens=250)
    plan = {r.source: r for r in decided.sources.collect()}
    total = sum(r.tokens for r in plan.values())
    z = sum((r.tokens / total) ** decided.exponent for r in plan.values())
    for r in plan.values():
        assert r.weight == pytest.approx((r.tokens / total) ** decided.exponent / z)
    assert -sum(r.weight * math.log(r.weight) for r in plan.values()) == pytest.approx(1.0, abs=1e-6)
    rows = mixture.collect()
    spent = Counter()
    for r in rows:
        spent[r.source] += r.tokens
    for source, r in plan.items():
        assert r.quota <= spent[source] + 1e-6 < r.quota + 12 + 1e-6
    # Passes are permutations: whole before the next begins, each document once in each.
    for source, r in plan.items():
        mine = [x for x in rows if x.source == source]
        for p in range(r.passes):
            assert len({x.row for x in mine if x["pass"] == p}) == r.n
    # Every block holds the sources in their weights, up to a document or two each.
    blocks = defaultdict(Counter)
    for r in rows:
        blocks[r.block][r.source] += r.tokens
    assert set(blocks) == set(range(decided.blocks))
    for held in blocks.values():
        for source, r in plan.items():
            assert abs(held[source] - r.weight * 250) <= 2 * 12
    for b in blocks:
        assert sorted(r.position for r in rows if r.block == b) == list(range(sum(r.block == b for r in rows)))


def test_limits_out_of_reach(spark, documents):
    docs = corpus(documents, {"a": 50, "b": 10})
    _, plain = mixing.mix(docs, repetition=1.0)
    assert plain.exponent == 1.0
    _, flat = mixing.mix(docs, entropy=5.0)
    assert flat.exponent == 0.0
    with pytest.raises(ValueError):
        mixing.mix(docs)


def test_odd_rows_and_columns(spark, documents, odd_rows):
    docs = documents(odd_rows)
    out = mixing.repeat_documents(docs, repetition=2.0)
    assert out.columns == docs.columns
    rows, want = Counter(map(tuple, out.collect())), Counter(map(tuple, docs.collect()))
    assert all(rows[r] >= n for r, n in want.items()) and set(rows) == set(want)


def test_sources_without_tokens_and_empty_table(spark, documents):
    mixture, _ = mixing.mix(documents([(1, ""), (2, None)]), repetition=2.0)
    assert sorted(r.row for r in mixture.collect()) == [1, 2]
    assert mixing.mix(documents([]), repetition=2.0)[0].count() == 0
    assert mixing.repeat_documents(documents([]), repetition=2.0).count() == 0


def test_rows_without_tokens_are_dealt_over_the_blocks(spark, documents):
    docs = documents([*((i, "w " * 20, "full") for i in range(400)), *((1000 + i, None, "bare") for i in range(2000))])
    mixture, decided = mixing.mix(docs, repetition=1.0, block_tokens=800)
    rows = mixture.collect()
    bare = Counter(r.block for r in rows if r.source == "bare")
    assert sum(bare.values()) == 2000 and set(bare) == set(range(decided.blocks))
    assert max(bare.values()) < 2 * 2000 / decided.blocks
    for b in bare:
        assert sorted(r.position for r in rows if r.block == b) == list(range(sum(r.block == b for r in rows)))
