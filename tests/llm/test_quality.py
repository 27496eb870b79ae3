from __future__ import annotations

import math
import re
import unicodedata
import zlib
from collections import Counter

import numpy as np

from ledgermill.llm import quality

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    scored, model = quality.score_documents(docs, labels)
    rows = {r.doc_id: r for r in scored.collect()}
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows.values())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows.values())
    held = [(rows[x.doc_id].predicted, x.quality) for x in labels.collect() if rows[x.doc_id].held_out]
    assert np.mean([p == y for p, y in held]) > 0.95


def test_labels_of_held_out_rows_do_not_matter(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn(
        "quality", quality.F.when(quality.held_out(quality.F.col("doc_id")), 1 - quality.F.col("quality")).otherwise(quality.F.col("quality"))
    )
    _, one = quality.score_documents(docs, labels)
    _, two = quality.score_documents(docs, turned)
    assert one == two


def test_pairs_recover_an_order():
    random = np.random.default_rng(0)
    x = random.normal(size=(400, len(quality.FEATURES)))
    y = (x[:, 0] - 0.5 * x[:, 1] + 0.1 * random.normal(size=400) > 0.3).astype(int)
    model = quality.fit_pairs(x, y)
    score = x @ np.array([model.weights[f] for f in quality.FEATURES])
    assert np.mean((score > model.cut) == (y == 1)) > 0.93
    # The cut is the quantile that matches the labels' share.
    assert (score > model.cut).sum() == y.sum()


def test_odd_rows_and_missing_labels(spark, documents, odd_rows):
    docs = documents(odd_rows)
    labels = spark.createDataFrame([(1, None, 0), (99, 1, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    rows = quality.score_documents(docs, labels)[0].collect()
    assert len(rows) == len(odd_rows) and {r.score for r in rows} == {0.5}
    assert quality.score_documents(documents([]), labels)[0].count() == 0
    assert quality.score_documents(docs, labels.limit(0))[0].count() == len(odd_rows)


def measured(text):
    """Features of a text, counted one by one."""
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    repeated = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
    n, chars = len(words), sum(map(len, words))
    symbols, shouts = sum(c in "#*$%&|<>" for c in text), text.count("!")
    return {
        "length": math.log(1 + n),
        "short": float(n < 20),
        "word_length": chars / max(n, 1),
        "symbols": symbols / (symbols + max(n, 1)),
        "lines": len(lines) / (len(lines) + max(n, 1)),
        "duplicate_lines": (len(lines) - len(set(lines))) / max(len(lines), 1),
        "repeated": len(repeated) / max(n, 1),
        "stutters": sum(a == b for a, b in zip(words, words[1:])) / max(n, 1),
        "upper": sum(unicodedata.category(c) == "Lu" for c in text) / max(chars, 1),
        "exclamations": shouts / (shouts + max(n, 1)),
    }


def test_scores_against_brute_force(spark):
    """Every score from features counted one by one, and the weights where the loss over all pairs is least."""
    small = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    scored, model = quality.score_documents(docs, labels)
    features = {r.doc_id: measured(r.text) for r in docs.collect()}
    for r in scored.collect():
        line = sum(model.weights[f] * v for f, v in features[r.doc_id].items()) - model.cut
        assert abs(r.score - 1 / (1 + math.exp(-min(max(line, -700), 700)))) < 1e-6

    learnt = [(r.doc_id, r.quality) for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 3 != 1]
    x = {i: np.array([features[i][f] for f in quality.FEATURES]) for i, _ in learnt}
    spread = np.std(list(x.values()), axis=0)
    spread[spread < 1e-12] = 1
    pairs = np.array([(x[g] - x[b]) / spread for g, a in learnt for b, c in learnt if a == 1 and c == 0])
    w = np.array([model.weights[f] for f in quality.FEATURES]) * spread

    def loss(v):
        return np.logaddexp(0, -pairs @ v).mean() + quality.RIDGE / 2 * (v @ v)

    best = loss(w)
    for i in range(len(w)):
        for move in (-0.05, 0.05):
            assert loss(w + move * np.eye(len(w))[i]) >= best - 1e-9
