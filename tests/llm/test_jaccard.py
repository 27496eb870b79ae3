from __future__ import annotations

import random
import re
from itertools import combinations

import numpy as np
import pyarrow as pa

from ledgermill.llm import jaccard, textnum
from ledgermill.llm.components import connected_components

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute(rows):
    sets = {i: shingles(t) for i, t in rows}
    group = {i: i for i in sets}
    for a, b in combinations(sorted(sets), 2):
        shared = len(sets[a] & sets[b])
        if shared and 100 * shared >= 80 * len(sets[a] | sets[b]):
            old, new = max(group[a], group[b]), min(group[a], group[b])
            group = {k: new if v == old else v for k, v in group.items()}
    return {i: (len(sets[i]), group[i]) for i in sets}


def test_words_and_offsets_of_slices():
    random.seed(1)
    texts = ["".join(random.choices("aAb \n\té", k=random.randint(0, 40))) for _ in range(300)] + [None, ""]
    for part in textnum.slices(pa.array(texts)):
        for j in range(len(part)):
            text = texts[part.at + j] or ""
            lo, hi = part.first[j], part.first[j + 1]
            spans = [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
            starts = textnum.code_points(part, part.start[lo:hi], j)
            ends = textnum.code_points(part, part.end[lo:hi], j)
            assert list(zip(starts, ends)) == spans


def test_against_brute_force(spark, documents):
    random.seed(3)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for family in range(12):
        base = random.choices(vocabulary, k=random.choice([3, 5, 8, 40, 120, 200]))
        for _ in range(8):
            copy = list(base)
            for _ in range(random.choice([0, 0, 1, 2, 4, 8])):
                copy[random.randrange(len(copy))] = random.choice(vocabulary)
            if random.random() < 0.3:
                copy += random.choices(vocabulary, k=random.randint(1, 20))
            text = " ".join(copy)
            rows.append((len(rows) * 3 + 1, text.upper() if random.random() < 0.2 else text))
    rows += [(900, "a b c"), (901, "a b c"), (902, "A b\nc"), (903, ""), (904, None), (905, "a b d")]
    found = jaccard.near_duplicates(documents(rows)).collect()
    assert {r.doc_id: (r.n_shingles, r["first"].doc_id) for r in found} == brute(rows)


def test_large_group_of_near_copies_makes_few_pairs(spark, documents, monkeypatch):
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(300):
        copy = list(base)
        copy[(i * 7) % 150] = f"x{i}"
        rows.append((i, " ".join(copy)))
    made = []
    plain = jaccard._verified
    monkeypatch.setattr(jaccard, "_verified", lambda p, *a: (made.append(p.count()), plain(p, *a))[1])
    found = jaccard.near_duplicates(documents(rows)).collect()
    assert {r["first"].doc_id for r in found} == {0}
    assert sum(made) < 3 * len(rows)


def test_one_document_of_each_group_stays(spark, documents, odd_rows):
    docs = documents(odd_rows)
    kept = jaccard.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4, 5, 6, 7, 8]


def test_no_links_and_empty_table(spark, documents):
    found = jaccard.near_duplicates(documents([(1, "a b c d e f"), (2, "g h i j k l")])).collect()
    assert {r.doc_id: r["first"].doc_id for r in found} == {1: 1, 2: 2}
    assert jaccard.near_duplicates(documents([])).count() == 0
    assert jaccard.drop_near_duplicates(documents([])).count() == 0


def test_packed_entries_round_trip():
    h = np.array([1, 2**40 - 1, 77], np.uint64)
    c = np.array([0, 2**48 - 1, 5], np.uint64)
    one, two = jaccard._unpack(jaccard._pack(h, c))
    assert one.tolist() == h.tolist() and two.tolist() == c.tolist()


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    found = {r.v: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(found[i] == 0 for i in range(41)) and all(found[i] == 100 for i in range(100, 160))
