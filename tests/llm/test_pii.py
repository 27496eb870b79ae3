from __future__ import annotations

import re

from hypothesis import given, settings
from hypothesis import strategies as st

from ledgermill.llm import pii

PATTERNS = [
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"),
    re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def brute(text):
    found = []
    for kind, pattern in enumerate(PATTERNS):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == 1 and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == 2 and not (16 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if kind == 3 and not 8 <= len(digits) <= 15:
                continue
            found.append((kind, *m.span()))
    return found


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab@.-+% ()0123456789é", max_size=80))
def test_base_spans_are_those_of_the_patterns(text):
    text = f"{text} 4539578763621486 {text}"
    assert pii.base_spans(text) == brute(text)


def test_query_columns_and_edges(spark, documents, odd_rows):
    text = "é mail a.b@c.example.org or +1 (319) 555-5132 at 10.0.0.1, card 4539578763621486."
    found, model = pii.find_personal_data(documents([*odd_rows, (20, text), (21, text)]))
    rows = pii.span_digest(found).collect()
    assert len(rows) == len(odd_rows) + 2
    by_id = {r.doc_id: r for r in rows}
    hit = by_id[20]
    assert (hit.n_email, hit.n_ip, hit.n_card, hit.n_phone) == (1, 1, 1, 1)
    assert hit.base_sha256 == pii.sha256_of(brute(text)) == by_id[21].base_sha256
    assert hit.spans.split(",")[0] == "email:7:24"
    assert by_id[3].spans == "" and by_id[3].base_sha256 == pii.sha256_of([])
    assert set(model.reliability) == set(pii.LABELERS)


def test_em_learns_which_labelers_to_trust():
    # The pattern labeler is right; context agrees with it, the gazetteer is noise.
    good = [(3, "++++.+", "m1", 400), (3, "++-+.+", "m1", 380), (3, "++...+", "m1", 100)]
    bad = [(3, "--+-.-", "n1", 300), (3, "----.-", "n1", 320), (3, "-----.", "n1", 30)]
    model = pii.fit(good + bad)
    trust = {k: v["true_positive"] - v["false_positive"] for k, v in model.reliability.items()}
    assert trust["pattern"] > 0.8 > 0.3 > abs(trust["gazetteer"])
    assert model.accepts(3, "++++.+", "m1") and not model.accepts(3, "--+-.-", "n1")


def test_no_candidates_at_all(spark, documents):
    found, model = pii.find_personal_data(documents([(1, "plain prose"), (2, None)]))
    assert model.probability == {}
    assert [r.n_added for r in pii.span_digest(found).collect()] == [0, 0]
    assert pii.find_personal_data(documents([]))[0].count() == 0


def test_redaction_keeps_columns_and_updates_length(spark, documents, odd_rows):
    docs = documents([*odd_rows, (20, "write to a.b@c.example.org now")])
    out = pii.redact(docs, length="n_chars")
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    by_id = {r.doc_id: r for r in out.collect()}
    assert by_id[20].text == "write to <EMAIL> now" and by_id[20].n_chars == len(by_id[20].text)
    assert by_id[3].text is None and out.count() == docs.count()


def test_hostile_texts_take_linear_time():
    for text in ("1" * 100_000, "a" * 100_000 + "@", "@a" * 50_000, "1 " * 50_000, "A1" * 50_000):
        pii._loose_spans(text, pii.base_spans(text))
