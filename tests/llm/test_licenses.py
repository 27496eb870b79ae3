from __future__ import annotations

import math
import random
import textwrap
import time

import pytest
from pyspark.sql import functions as F

from ledgermill.llm import licenses


def test_notices_in_prose(spark, documents, odd_rows):
    prose = "Some words of a tale that goes on and on"
    texts = {
        50: f"{prose}\nLicensed under the Apache License, Version 2.0.\n{prose}",
        51: f"{prose}. Released under the MIT License.",
        52: "THIS WORK IS LICENSED UNDER THE GNU GENERAL PUBLIC LICENSE, VERSION 3.\nAll rights reserved.",
        53: "Licensed under CC BY-NC 4.0.",
        54: "the general public read the license of the driver, version by version",
        55: "This work is released to friends.",
    }
    found, model = licenses.scan(documents([*odd_rows, *texts.items()]))
    rows = {r.row: r.notices for r in found.collect()}
    families = lambda i: [(n.line, n.family) for n in rows[i] if n.confirmed]
    assert families(50) == [(1, "apache-2.0")]
    assert families(51) == [(0, "mit")]
    assert families(52) == [(0, "gpl"), (1, "proprietary")]
    assert families(53) == [(0, "cc-by-nc")]
    assert families(54) == families(55) == families(3) == families(7) == []
    assert found.count() == len(odd_rows) + len(texts)
    # Sparse: features without weight are not kept.
    assert 0 < len(model.weights) < 1000


def test_empty_table(spark, documents):
    found, model = licenses.scan(documents([]))
    assert found.count() == 0 and 0 < model.cut <= 0.9


def test_each_template_is_its_family(spark, documents):
    rows, want = [], {}
    for family, templates in licenses.TEMPLATES.items():
        for t in templates:
            want[len(rows)] = family
            rows.append((len(rows), t))
    found, _ = licenses.scan(documents(rows))
    got = {r.row: [n.family for n in r.notices if n.confirmed] for r in found.collect()}
    assert sum(got[i] == [f] for i, f in want.items()) >= 0.9 * len(want)


def test_wrapped_notices(spark, documents):
    prose = "Some words of a tale that goes on and on"
    bsd, gpl, sa = (licenses.TEMPLATES["bsd"][0], licenses.TEMPLATES["gpl"][1], licenses.TEMPLATES["cc-by-sa"][1])
    wrap = lambda text, width, mark="": "\n".join(mark + x for x in textwrap.wrap(text, width))
    texts = {
        1: f"{prose}\n\n{wrap(bsd, 75)}\n\n{prose}",
        2: wrap(gpl, 70, " * "),
        3: sa.replace("Commons ", "Commons\n"),
        4: sa.replace("Attribution-", "Attribution-\n"),
        5: wrap(gpl, 20, "# "),
        6: f"{prose}\n{wrap(bsd, 60, '// ')}\nAll rights reserved.\n{prose}",
        7: bsd.replace("forms, ", "forms,\n\n").replace("permitted ", "permitted\n\n"),
        8: "\n".join(gpl.split()),
        9: f"{wrap(gpl, 60)}\n{wrap(bsd, 60)}",
    }
    found, _ = licenses.scan(documents(list(texts.items())))
    rows = {r.row: r.notices for r in found.collect()}
    got = {i: [(n.line, n.family) for n in rows[i] if n.confirmed] for i in texts}
    assert got[1] == [(2, "bsd")]
    assert got[2] == got[5] == got[8] == [(0, "gpl")]
    assert got[3] == got[4] == [(0, "cc-by-sa")]
    assert got[6] == [(1, "bsd"), (3 + texts[6].count("//") - 2, "proprietary")]
    assert got[7] == []  # blank lines end a paragraph
    assert got[9] == [(0, "gpl"), (len(textwrap.wrap(gpl, 60)), "bsd")]
    # Lines of a confirmed notice are not counted as notices of unknown families.
    assert not any(n.notice and not n.confirmed for i in (1, 2, 3, 5, 9) for n in rows[i])


def test_corpus_sample_is_of_whole_distinct_lines(spark, documents):
    long = " ".join(f"w{i}" for i in range(300))
    texts = [f"first of {i}\n\n{long} {i}\nlast of {i}" for i in range(20)] + ["hot line\n***"] * 50 + [None]
    sample = licenses.corpus_sample(documents(list(enumerate(texts))))
    want = {x for i in range(20) for x in (f"first of {i}", f"{long} {i}", f"last of {i}")} | {"hot line"}
    assert len(sample) == len(want) and set(sample) == want
    many = [(i, "\n".join(f"line {i} {j}" for j in range(100))) for i in range(300)]
    bounded = licenses.corpus_sample(documents(many))
    assert len(set(bounded)) == len(bounded) == licenses.MAX_CORPUS_LINES


def evidence(line):
    """What training uses of a line, from the line itself."""
    ws = licenses.words(line)
    templates = [licenses.words(t) for ts in licenses.TEMPLATES.values() for t in ts]
    known = {w for t in templates for w in t}
    pairs = {p for t in templates for p in zip(t, t[1:])}
    own = [p in pairs for p in zip(ws, ws[1:])]
    whole = any(" ".join(t) in " ".join(ws) for t in templates)
    return licenses.Evidence(
        tuple(w if w in known else licenses.OTHER for w in ws[: licenses.HEAD]),
        frozenset(licenses.grams(ws) & {g for t in templates for g in licenses.grams(t)}),
        any(own) and (2 * sum(own) >= len(own) or whole),
    )


def test_training_gets_what_the_sampled_lines_say(spark, documents, odd_rows):
    templates = [t for ts in licenses.TEMPLATES.values() for t in ts]
    texts = [*templates, "to use the file", "y" * 100_000, "Of the GNU " * 30, "see the license\nof the\n\n  driver"]
    docs = documents([*odd_rows, *enumerate(texts, 100), *enumerate(texts, 200)])
    got = licenses.corpus_evidence(docs)
    assert set(got) == {evidence(x) for x in licenses.corpus_sample(docs)}
    assert max(len(w) for e in got for w in e.head) < 30


def brute(text, model):
    """Notices of a text with every run of lines judged word by word and compared with all that stand."""
    lines = [licenses.words(x) for x in (text or "").split("\n")]
    telling = set(model.telling)

    def judged(first, last, ws):
        pairs = [f"{a} {b}" for a, b in zip(ws, ws[1:])]
        z = list(model.bias)
        for g in dict.fromkeys(ws + pairs):
            z = [a + b for a, b in zip(z, model.weights.get(g, [0.0] * len(z)))]
        chance = 1 / sum(math.exp(v - max(z)) for v in z)
        family = model.families[z.index(max(z))]
        sure = family if chance >= model.cut else licenses.UNKNOWN
        shares = [(0.0, [])]
        for t in licenses.TEMPLATES.get(sure, ()):
            want = sorted({f"{a} {b}" for a, b in zip(licenses.words(t), licenses.words(t)[1:])})
            own = [p for p in want if p in pairs]
            shares.append((len(own) / len(want), own))
        share, own = max(shares)
        confirmed = share >= licenses.CONFIRM
        return (-share, last - first, first, last, sure, chance, confirmed, family != licenses.UNKNOWN, frozenset(own))

    single = [judged(i, i, ws) for i, ws in enumerate(lines) if telling & set(ws)]
    wide = []
    for i, ws in enumerate(lines):
        run, n = ws[-licenses.REACH :], 0
        for j in range(i + 1, len(lines)):
            if not ws or not lines[j] or n >= licenses.REACH:
                break
            run, n = run + lines[j][: licenses.REACH], n + len(lines[j])
            wide.append(judged(i, j, run))
    stand = []
    for x in sorted((j for j in single + wide if j[6]), key=lambda j: j[:6]):
        if not any(b[2] <= x[3] and x[2] <= b[3] and (b[4] == x[4] or x[8] <= b[8]) for b in stand):
            stand.append(x)
    runs = [b for b in stand if b[3] > b[2]]
    rest = [x for x in single if not x[6] and not any(b[2] <= x[2] <= b[3] for b in runs)]
    return sorted((x[2], x[4], x[6], x[7], round(x[5], 9)) for x in stand + rest)


def mixed_text(rng):
    """Whole, cut and wrapped templates among blank, short and long lines of words that templates share."""
    templates = [t for ts in licenses.TEMPLATES.values() for t in ts]
    common = sorted(licenses.STOP) + ["license", "gnu", "work", "tale", "zz"]
    some = lambda least, most: " ".join(rng.choice(common) for _ in range(rng.randint(least, most)))
    lines = []
    for _ in range(rng.randint(1, 12)):
        ws, kind = licenses.words(rng.choice(templates)), rng.random()
        if kind < 0.45:
            if rng.random() < 0.4:
                ws = ws[rng.randint(0, len(ws) // 2) :]
            at = rng.randint(0, len(ws)) if rng.random() < 0.6 else len(ws)
            lines += [" ".join(ws[:at]), " ".join(ws[at:])] if at < len(ws) else [" ".join(ws)]
        elif kind < 0.55:
            lines.append("")
        elif kind < 0.7:
            parts = [some(50, 75), " ".join(ws)]
            lines.append(" ".join(parts if rng.random() < 0.5 else parts[::-1]))
        else:
            lines.append(some(1, 9))
    return "\n".join(lines)


def test_notices_equal_brute_force(spark, documents, odd_rows):
    rng = random.Random(11)
    texts = dict(enumerate(mixed_text(rng) for _ in range(250)))
    rows = [*((100 + i, t) for i, t in texts.items()), *(r for r in odd_rows if r[0] not in (7, 8))]
    found, model = licenses.scan(documents(rows))
    got = {r.row: [(n.line, n.family, n.confirmed, n.notice, round(n.probability, 9)) for n in r.notices] for r in found.collect()}
    runs = 0
    for i, text in rows:
        assert got[i] == brute(text, model), text
        runs += sum(n[2] for n in got[i])
    assert runs > 250


@pytest.mark.parametrize("line", ["All rights reserved.", None])
def test_many_notices_in_one_text(spark, documents, line):
    """Work grows with the lines, not with their square or the runs they could be in."""
    templates = [t for ts in licenses.TEMPLATES.values() for t in ts]
    _, model = licenses.scan(documents([]))
    text = "\n".join(line or templates[i % len(templates)] for i in range(1000))
    began = time.monotonic()
    notices = documents([(1, text)]).select(licenses.licenses_of(F.col("text"), model).alias("n")).first().n
    assert time.monotonic() - began < 30
    assert [n.line for n in notices] == list(range(1000))
