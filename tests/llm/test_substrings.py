from __future__ import annotations

import random

from ledgermill.llm import substrings


def prose(seed, n):
    r = random.Random(seed)
    return [f"t{r.randrange(5000)}" for _ in range(n)]


def covered(rows, doc, lo, hi):
    return sum(max(0, min(hi, r.end) - max(lo, r.start)) for r in rows if r.doc_id == doc) / (hi - lo)


def test_lines_and_embedded_passages(spark, documents):
    line = " ".join(prose(1, 9))
    passage = " ".join(prose(2, 55))
    texts = {}
    for i in range(30):
        body = prose(100 + i, 120)
        at = random.Random(i).randrange(100)
        texts[i] = " ".join(body[:at]) + f" {passage} " + " ".join(body[at:])
    for i in range(30, 40):
        texts[i] = " ".join(prose(100 + i, 80)) + f"\n{line.upper() if i % 2 else line}\n" + " ".join(prose(200 + i, 40))
    for i in range(40, 60):
        texts[i] = " ".join(prose(100 + i, 150))
    rows = substrings.removed_spans(documents(list(texts.items()))).collect()
    for i in range(1, 30):
        lo = texts[i].index(passage)
        assert covered(rows, i, lo, lo + len(passage)) > 0.4
        mine = [r for r in rows if r.doc_id == i]
        assert all(r.kept_doc_id < i for r in mine)
        assert all(lo <= r.start < r.end <= lo + len(passage) for r in mine)
    for i in range(31, 40):
        lo = texts[i].lower().index(line)
        assert [(r.start, r.end, r.kept_doc_id) for r in rows if r.doc_id == i] == [(lo, lo + len(line), 30)]
    assert {r.doc_id for r in rows} == set(range(1, 30)) | set(range(31, 40))


def test_whole_copies_keep_the_first(spark, documents, odd_rows):
    rows = substrings.removed_spans(documents(odd_rows)).collect()
    text = odd_rows[0][1]
    assert sorted((r.doc_id is None, r.doc_id or 0, r.start, r.end, r.kept_doc_id) for r in rows) == [
        (False, 2, 0, len(text), 1), (False, 2, 0, len(text), 1), (True, 0, 0, len(text), 1),
    ]


def test_cutting_keeps_the_rest_and_the_columns(spark, documents):
    line = " ".join(prose(5, 12))
    docs = documents([(1, f"é start\n{line}"), (2, f"é other\n{line}\nend"), (3, None), (4, "alone")])
    out = substrings.cut_spans(docs, substrings.removed_spans(docs))
    assert out.columns == docs.columns
    got = {r.doc_id: r.text for r in out.collect()}
    assert got == {1: f"é start\n{line}", 2: "é other\n\nend", 3: None, 4: "alone"}


def test_repeats_inside_one_document_and_short_lines(spark, documents):
    line = " ".join(prose(6, 8))
    docs = documents([(1, f"{line}\n{line}\n{line}"), (2, "so it goes\nso it goes")])
    rows = substrings.removed_spans(docs).collect()
    assert {r.doc_id for r in rows} == {1}
    assert sum(r.end - r.start for r in rows) in (2 * len(line), 2 * len(line) + 1)
    assert substrings.removed_spans(documents([])).count() == 0


def test_passages_in_short_lines(spark, documents):
    verse = [" ".join(prose(300 + i, 1 + i % 4)) for i in range(40)]
    other = lambda seed: [" ".join(prose(1000 * seed + i, 1 + i % 3)) for i in range(20)]
    texts = {
        1: "\n".join(other(1) + verse + other(2)),
        2: "\n".join(other(1) + verse + other(2)),
        3: "\n".join(other(3) + verse + other(4)),
        4: "\n".join(other(5) + [x for line in verse for x in (line, other(6)[len(line) % 20])]),
        5: "\n\n".join(verse),
        6: "a b c\nd e f",
        7: "a b c\nd e f",
        8: "la\n" * 30 + " ".join(prose(9, 30)),
    }
    rows = substrings.removed_spans(documents(list(texts.items()))).collect()
    words_left = {r.doc_id: r.text.split() for r in substrings.cut_spans(
        documents(list(texts.items())), substrings.removed_spans(documents(list(texts.items())))).collect()}
    assert words_left[1] == texts[1].split() and words_left[6] == texts[6].split()
    assert words_left[2] == words_left[5] == words_left[7] == []
    assert words_left[3] == " ".join(other(3) + other(4)).split()
    # The same short lines, each among others, are no passage.
    assert words_left[4] == texts[4].split()
    # A copy that overlaps the one that stays does not eat it.
    assert words_left[8] == ["la"] * 10 + prose(9, 30)
    assert {r.kept_doc_id for r in rows if r.doc_id in (2, 3, 5)} == {1}


def test_length_of_text_without_spaces(spark, documents):
    r = random.Random(4)
    line = lambda n: "".join(chr(r.randrange(0x4E00, 0x9000)) for _ in range(n))
    long, short = line(40), [line(9) for _ in range(12)]
    texts = {1: f"{line(20)}\n{long}\n{line(8)}", 2: f"{line(50)}\n{long}", 3: "\n".join([line(50), *short]),
             4: "\n".join([*short, line(50)]), 5: f"{line(50)}\n{short[3]}"}
    rows = substrings.removed_spans(documents(list(texts.items()))).collect()
    cut = {(r.doc_id, texts[r.doc_id][r.start : r.end]) for r in rows}
    assert cut == {(2, long), (4, "\n".join(short))}
