from __future__ import annotations

import math
import re
from collections import Counter

import pytest

from ledgermill.llm import urls

RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block")]


def split(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host) :])[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def rule(host, path):
    fits = []
    for name, verdict in RULES:
        rule_host, _, rule_path = name.partition("/")
        if (host == rule_host or host.endswith("." + rule_host)) and path.startswith("/" + rule_path):
            fits.append((len(name), name, verdict))
    return max(fits)[1:] if fits else (None, None)


URLS = [
    "http://WWW.Example.COM/en/a", "https://shop.example.com/en/x?y#z", "http://example.com/en", "http://com/", "http://com",
    "ftp://a.net/es/1", "http://net/fr/", "http://anet/fr/", "nourl", "", None, "http://", "http://x.org?q=/en/", "a://b://c/d",
    "http://x.org/" + "é" * 50, "http://www.example.com/en/#f", "http://b.org/" + "p/" * 5000,
]


def test_hosts_paths_and_rules(spark, pages):
    rows = [(i, u, "h", "x", "y") for i, u in enumerate(URLS)] + [(0, URLS[0], None, None, None)]
    found, _ = urls.judge_urls(pages(rows))
    got = found.collect()
    assert len(got) == len(rows)
    for r in got:
        host, path = split(URLS[r.row])
        name, verdict = rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, name)
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")
        if not host + path:
            assert r.verdict == "block"


def test_log_ratios_against_the_formula(spark):
    texts = {"allow": ["abab", "abb"], "block": ["aacc", "ca"]}
    counted = Counter()
    for side, group in texts.items():
        for t in group:
            padded = urls.BEFORE * urls.ORDER + t + urls.AFTER
            for i in range(urls.ORDER, len(padded)):
                counted[padded[i - urls.ORDER : i + 1], side] += 1
    windows = sorted({w for w, _ in counted})
    table = spark.createDataFrame([(w, counted[w, "allow"], counted[w, "block"]) for w in windows], "w string, allow long, block long")
    letters = {w[-1] for w in windows}

    def chance(w, side):
        p = None
        for k in range(urls.ORDER + 1):
            gram = sum(n for (x, s), n in counted.items() if s == side and x.endswith(w[len(w) - k - 1 :]))
            if k == 0:
                p = (gram + 1) / (sum(n for (_, s), n in counted.items() if s == side) + len(letters))
            else:
                context = sum(n for (x, s), n in counted.items() if s == side and x[urls.ORDER - k : urls.ORDER] == w[urls.ORDER - k : urls.ORDER])
                p = (gram + urls.BACKOFF * p) / (context + urls.BACKOFF)
        return p

    for r in urls.log_ratios(table).collect():
        assert r.ratio == pytest.approx(math.log(chance(r.w, "allow") / chance(r.w, "block")))


def test_models_tell_unseen_urls_apart(spark, pages):
    good = [f"http://site{i}.com/article/reading/{i}" for i in range(120)]
    bad = [f"http://q{i}.net/es/xxzz/kk{i}zz" for i in range(120)]
    fresh = ["http://other.org/article/reading/7", "http://v.org/es/xxzz/kk9zz"]
    rows = [(i, u, None, None, None) for i, u in enumerate(good + bad + fresh)]
    found, cut = urls.judge_urls(pages(rows))
    verdicts = {r.row: r.verdict for r in found.collect()}
    assert [verdicts[240], verdicts[241]] == ["allow", "block"]
    assert cut.allowed_kept > 0.95 and cut.blocked_caught > 0.95


def test_one_sided_and_empty_tables(spark, pages):
    found, _ = urls.judge_urls(pages([(1, "http://a.com/x", None, None, None), (2, "http://b.org/", None, None, None)]))
    assert {r.row: r.verdict for r in found.collect()} == {1: "allow", 2: "allow"}
    assert urls.judge_urls(pages([]))[0].count() == 0
