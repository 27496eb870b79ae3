from __future__ import annotations

import random

import numpy as np
import pytest
from xxhash import xxh64_intdigest

from ledgermill.llm import simhash

UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def brute_fingerprint(text):
    words = [w for w in "".join(" " if c in "\t\n\v\f\r" else c for c in (text or "")).translate(UPPER).split(" ") if w]
    grams = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    h = [xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, distance):
    """Least place of each fingerprint's component."""
    group = list(range(len(fps)))

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for i, a in enumerate(fps):
        for j in range(i):
            if (a ^ fps[j]).bit_count() <= distance:
                x, y = sorted((root(i), root(j)))
                group[y] = x
    return [root(i) for i in range(len(fps))]


def flipped(fp, rng, n):
    for bit in rng.sample(range(64), n):
        fp ^= 1 << bit
    return fp


@pytest.fixture(scope="module")
def crowd():
    """Fingerprints alone, in pairs at each distance, in chains and in balls around a centre."""
    rng = random.Random(3)
    fps = [rng.getrandbits(64) for _ in range(150)]
    for n in range(1, 8):
        fps += [flipped(rng.choice(fps[:150]), rng, n) for _ in range(30)]
    for _ in range(40):
        fps.append(flipped(fps[-1], rng, 4))
    centre = rng.getrandbits(64)
    fps += [flipped(centre, rng, rng.randint(0, 3)) for _ in range(300)]
    fps += [0, 1, 0b11110, 2**64 - 1, 2**64 - 1 - 0b1111, 2**63]
    rng.shuffle(fps)
    return sorted(set(fps))


def linked(spark, fps, distance):
    """Least place in ``fps`` of each one's component, from the links found."""
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    classes = spark.createDataFrame([(x,) for x in signed], "fp long")
    found = simhash.links(classes, distance).collect()
    at = {x: i for i, x in enumerate(signed)}
    group = list(range(len(fps)))

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for row in found:
        assert 0 < (fps[at[row.a]] ^ fps[at[row.b]]).bit_count() <= distance
        x, y = sorted((root(at[row.a]), root(at[row.b])))
        group[y] = x
    return [root(i) for i in range(len(fps))], len(found)


@pytest.mark.parametrize("distance", [2, 3, 4, 5, 6])
def test_links_against_brute_force(spark, crowd, distance):
    assert linked(spark, crowd, distance)[0] == brute_components(crowd, distance)


def test_crowded_anchors_are_dealt_and_lose_nothing(spark, crowd, monkeypatch):
    monkeypatch.setattr(simhash, "HOME_ROWS", 20)
    monkeypatch.setattr(simhash, "BUCKET_COPIES", 500)
    monkeypatch.setattr(simhash, "PAIR_CELLS", 2_000)
    assert linked(spark, crowd, 4)[0] == brute_components(crowd, 4)


def test_a_crowd_gives_links_not_pairs(spark):
    rng = random.Random(5)
    fps = sorted({flipped(2**50 + 12345, rng, rng.randint(0, 2)) for _ in range(1_500)})
    groups, links = linked(spark, fps, 4)
    assert set(groups) == {0}
    assert links < 30 * len(fps)


@pytest.mark.parametrize("start, length", simhash.windows(4) + simhash.windows(2))
def test_copies_reach_every_anchor_within_two_bits_once(start, length):
    rng = np.random.default_rng(start)
    fp = rng.integers(0, 2**64, 40, dtype=np.uint64)
    value = (fp >> np.uint64(start)).astype(np.int64) & (2**length - 1)
    got = [set() for _ in fp]
    for places, anchors in simhash.copies(fp, start, length):
        for p, a in zip(places.tolist(), anchors.tolist()):
            assert a not in got[p]
            got[p].add(a)
    masks = [0, *(1 << i for i in range(length)), *(1 << i | 1 << j for i in range(length) for j in range(i))]
    for p, v in enumerate(value.tolist()):
        near = {v ^ m for m in masks}
        assert got[p] == {a for a in near if simhash._SYNDROME[a & 0x7FFF] == 0}
    home = simhash.homes(fp, start, length)
    assert all((int(h) ^ int(v)).bit_count() <= 1 for h, v in zip(home, value))


def test_documents(spark, documents):
    rng = random.Random(1)
    words = [f"W{i}é" for i in range(300)]
    base = [rng.choice(words) for _ in range(400)]
    rows = [(i, " ".join([*base[:i], f"new{i}", *base[i + 1 :]])) for i in range(0, 60, 3)]
    rows += [(100 + i, " ".join(rng.choice(words) for _ in range(80))) for i in range(40)]
    rows += [(200, None), (201, ""), (202, " \t\n"), (203, "one"), (204, "ONE"), (205, "a b c\x0bd e"), (206, "x" * 50_000)]
    rows += [(300, rows[0][1]), (None, rows[0][1]), (301, rows[0][1]), (301, rows[0][1]), (None, "alone here")]
    got = [tuple(r) for r in simhash.near_duplicates(documents(rows)).collect()]
    fps = [brute_fingerprint(t) for _, t in rows]
    root = brute_components(fps, 4)
    least = {}
    for (doc_id, _), r in zip(rows, root):
        if doc_id is not None:
            least[r] = min(doc_id, least.get(r, doc_id))
    wanted = [
        (doc_id, int(np.uint64(fp).view(np.int64)), least.get(r)) for (doc_id, _), fp, r in zip(rows, fps, root)
    ]
    assert sorted(got, key=str) == sorted(wanted, key=str)


def test_long_texts_are_counted_in_parts(monkeypatch):
    text = " ".join(f"w{i % 977}" for i in range(5_000))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "PART_WORDS", 313)
    assert simhash.fingerprint(text) == whole == brute_fingerprint(text)


def test_equal_to_the_functions_of_sql(spark):
    from pyspark.sql import functions as F

    row = spark.range(1).select(F.xxhash64(F.lit("é b c d")).alias("h")).first()
    assert simhash.fingerprint("É b C d".replace("É", "é")) == row.h % 2**64


def test_empty_table(spark, documents):
    found = simhash.near_duplicates(documents([]))
    assert found.count() == 0 and found.columns == ["doc_id", "fp", "component_id"]


def test_hex_digits(spark):
    df = spark.createDataFrame([(0,), (-1,), (255,)], "fp long")
    got = [r[0] for r in df.select(simhash.hex_digits(df.fp)).collect()]
    assert got == ["0" * 16, "f" * 16, "0" * 14 + "ff"]
