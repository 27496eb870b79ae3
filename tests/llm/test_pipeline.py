from __future__ import annotations

from collections import Counter

import corpus_pipeline
from ledgermill.llm import jaccard, packing, pii, rules
from ledgermill.llm.common import staged
from ledgermill.llm.queries import LLM_QUERIES

SF = "/root/testdata/sf0.001"


def test_stages_are_in_order_and_registered():
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "near_duplicates", "personal_data", "mix_sources", "pack"]
    assert LLM_QUERIES["pipeline"] is corpus_pipeline.run
    assert sorted(int(n[2:].split("_")[0]) for n in LLM_QUERIES if n != "pipeline") == list(range(1, 14))


def masked(text, spans):
    """The text with spans (kind, start, end) as ``<KIND>``, overlapping ones as the first."""
    parts, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            parts += [text[at:start], f"<{pii.KINDS[kind].upper()}>"]
        at = max(at, end)
    return "".join(parts) + text[at:]


def stages(spark, docs):
    """What each stage hands on, by name."""
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = out[name] = staged(stage(spark, docs, SF))
    return out


def test_each_stage_follows_the_decisions_of_its_operator(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = stages(spark, docs)
    texts = {r.doc_id: r.text for r in docs.collect()}
    passed = {r.doc_id for r in rules.rule_ledger(docs).filter(rules.passes("v1")).collect()}
    assert {r.doc_id: r.text for r in out["quality_rules"].collect()} == {i: texts[i] for i in passed}

    firsts = {r["first"].doc_id for r in jaccard.near_duplicates(out["quality_rules"]).collect()}
    assert {r.doc_id: r.text for r in out["near_duplicates"].collect()} == {i: texts[i] for i in firsts}
    assert len(firsts) < len(passed)

    found, _ = pii.find_personal_data(out["near_duplicates"])
    added = {r.doc_id: r.spans for r in pii.span_digest(found).collect()}
    kept = {r.doc_id: r for r in out["personal_data"].collect()}
    assert kept.keys() == firsts
    hits = 0
    for i, row in kept.items():
        spans = [(pii.KINDS.index(k), int(a), int(b)) for k, a, b in (s.split(":") for s in added[i].split(",") if s)]
        assert set(pii.base_spans(texts[i])) <= set(spans)
        assert row.text == masked(texts[i], spans) and row.n_chars == len(row.text)
        hits += bool(spans)
    assert hits > 3 and len(firsts) > 2 * hits

    mixed = Counter((r.doc_id, r.text) for r in out["mix_sources"].collect())
    assert set(mixed) == {(i, row.text) for i, row in kept.items()}

    encode = packing.encoder(**packing.tokenizer_files()).packed
    packed, pieces = Counter(), Counter()
    for r in out["pack"].collect():
        packed[r.doc_id] += r.length
        pieces[r.doc_id] += r.start == 0
    for (i, text), times in mixed.items():
        assert packed[i] == times * (len(encode(text)) // 4 + 1) and pieces[i] == times

    again = corpus_pipeline.run(spark, SF).select("doc_id", "piece", "start", "length", "ids_crc32")
    assert Counter(again.collect()) == Counter(out["pack"].select(again.columns).collect())


def test_stages_take_odd_rows(spark, documents, odd_rows):
    """What each stage makes of NULLs, blank, short, long and repeated texts."""
    docs = documents(odd_rows)
    prose, long = odd_rows[0][1], odd_rows[-1][1]
    stage = dict(corpus_pipeline.STAGES)

    def rows(name, given=docs):
        out = stage[name](spark, given, SF)
        assert out.columns == docs.columns
        return sorted(((r.doc_id, r.text) for r in out.collect()), key=str)

    assert rows("quality_rules") == sorted([(1, prose), (2, prose), (2, prose), (None, prose), (8, long)], key=str)
    assert rows("near_duplicates") == sorted([(1, prose), *((r[0], r[1]) for r in odd_rows[4:])], key=str)
    assert rows("personal_data") == sorted(((r[0], r[1]) for r in odd_rows), key=str)
    assert set(rows("mix_sources")) == {(r[0], r[1]) for r in odd_rows}
    packed = stage["pack"](spark, docs, SF).collect()
    assert Counter(r.doc_id for r in packed if r.start == 0) == Counter(r[0] for r in odd_rows)
    for name in stage:
        assert stage[name](spark, documents([]), SF).count() == 0
