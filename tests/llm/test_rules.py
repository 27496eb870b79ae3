from __future__ import annotations

import re
from collections import Counter

from ledgermill.llm import rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(8)}
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_measures_against_brute_force(spark, documents, odd_rows):
    rows = odd_rows + [
        (10, "a b c d e f g h a b c d e f g h i"),
        (11, "x\nx\n\ny # $\nx \n"),
        (12, "la " * 400),
        (13, "\x0b é b \x0cü # <>"),
    ]
    found = rules.rule_ledger(documents(rows)).collect()
    want = Counter((r[0], *brute(r[1])) for r in rows)
    got = Counter(
        (r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in found
    )
    assert got == want


def test_policy_is_a_mask(spark, documents):
    shout = "THIS IS LOUD " * 3 + " ".join(f"W{i}X" for i in range(40)).upper()
    docs = documents([(1, " ".join(f"word{i}" for i in range(30))), (2, "too short"), (3, shout)])
    kept = {r.doc_id for r in rules.apply_rules(docs, "v1").collect()}
    assert kept == {1}
    assert {r.doc_id for r in rules.apply_rules(docs, "base").collect()} == {1, 3}
    assert rules.apply_rules(docs).columns == docs.columns


def test_ablation_counts(spark, documents):
    docs = documents([(1, "short # # #"), (2, "short"), (3, " ".join(f"word{i}" for i in range(30)))])
    rows = {
        (r.policy, r.rule): r for r in rules.ablation(rules.rule_ledger(docs)).collect()
    }
    few = rows["v1", "too_few_words"]
    assert (few.documents, few.rejected, few.failed_rule) == (3, 2, 2)
    assert (few.rejected_by_it_alone, few.rejected_without) == (1, 1)


def test_filter_on_the_ledger_stays_linear(spark, documents):
    docs = documents([(i, " ".join(f"w{j}" for j in range(3000))) for i in range(20)])
    assert rules.apply_rules(docs).count() == 20


def test_empty_table(spark, documents):
    assert rules.rule_ledger(documents([])).count() == 0
    assert rules.apply_rules(documents([])).count() == 0
