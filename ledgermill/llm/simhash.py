"""Near copies by SimHash: fingerprints at few differing bits, found around the anchors of covering codes.

A fingerprint has 64 bits; bit i is set if more than half of the text's word shingles have it set in
their XXH64. Fingerprints link at ``distance`` or fewer differing bits.

Of ``distance // 2 + 1`` windows that part the 64 bits, two linked fingerprints differ in at most one bit
in some window. In each window the anchors are the words of a covering code: fifteen bits under the
perfect Hamming code, of covering radius one, and every value of the other bits. Each fingerprint lives
at its nearest anchor, and is also copied to every anchor within covering radius plus that one bit, thus
to the home of any partner. Anchors compare those who live there with those copied to them; what differs
in ``distance`` bits or fewer over all 64 is linked.

Only distinct fingerprints are placed, so exact copies cost nothing. A task returns only
links that join groups of its fingerprints, not all pairs. Where many live at one anchor they are dealt over
several tasks, each of which gets all that are copied there.

Edge cases: texts without words (NULL too) have the fingerprint zero and link like others; a text of
fewer words than a shingle is one shingle; a bit set in exactly half is 0; equal rows have one
fingerprint; a NULL id is named as component only where there is no other; an empty table gives no rows;
other columns are not looked at. Texts are read whole, long ones in parts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import apply_arrow, map_arrow, small_batches, staged
from ledgermill.llm.components import connected_components

WORDS = 4
DISTANCE = 4
BITS = 64
SEED = 42  # fixed value: the seed of the shingle hashes
PART_WORDS = 100_000
BUCKET_COPIES = 1_000_000
# So many that live at one anchor are compared in one task.
HOME_ROWS = 4_096
PAIR_CELLS = 4_000_000


def fingerprint(text: str | None, k: int = WORDS) -> int:
    """Unsigned fingerprint of a text."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()
    n = max(len(words) - k + 1, min(len(words), 1))
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, PART_WORDS):
        stop = min(at + PART_WORDS, n)
        digests = (xxh64_intdigest(b" ".join(words[i : i + k]), SEED) for i in range(at, stop))
        h = np.fromiter(digests, np.uint64, stop - at)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, k: int = WORDS, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, fp) of every row, the fingerprint as a signed 64-bit number."""

    def task(batches):
        for batch in small_batches(batches):
            found = np.array([fingerprint(t, k) for t in batch.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "fp"]
            )

    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return map_arrow(narrow, task, f"doc_id {narrow.schema['doc_id'].dataType.simpleString()}, fp long")


def _hamming() -> np.ndarray:
    """Syndromes of all 15-bit values: 0 for the words of the code, else the number of the bit to flip."""
    values = np.arange(1 << 15)
    syndrome = np.zeros(1 << 15, np.int64)
    for bit in range(15):
        syndrome ^= np.where(values >> bit & 1, bit + 1, 0)
    return syndrome


_SYNDROME = _hamming()
# For each syndrome the pairs of bits to flip that reach a word of the code.
_PAIRS = [
    [(1 << i) | (1 << j) for i in range(15) for j in range(i) if (i + 1) ^ (j + 1) == s] for s in range(16)
]


def _nearest(low: np.ndarray) -> np.ndarray:
    """The only word of the code within distance one of fifteen bits."""
    s = _SYNDROME[low]
    return low ^ np.where(s > 0, 1 << np.maximum(s - 1, 0), 0)


def windows(distance: int) -> list[tuple[int, int]]:
    """First bit and length of each window."""
    parts = distance // 2 + 1
    edges = [BITS * i // parts for i in range(parts + 1)]
    if not 15 <= BITS // parts <= 32:
        raise ValueError("distance has to be from 2 to 7")
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def homes(fp: np.ndarray, start: int, length: int) -> np.ndarray:
    """The nearest anchor of each fingerprint in a window."""
    value = (fp >> np.uint64(start)).astype(np.int64) & ((1 << length) - 1)
    return value & ~0x7FFF | _nearest(value & 0x7FFF)


def copies(fp: np.ndarray, start: int, length: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places in ``fp``, anchors) that cover every anchor at two or fewer bits from a fingerprint, once."""
    value = (fp >> np.uint64(start)).astype(np.int64) & ((1 << length) - 1)
    low, high = value & 0x7FFF, value & ~0x7FFF
    s = _SYNDROME[low]
    all_places = np.arange(len(fp))
    yield all_places, high | _nearest(low)
    for syndrome, flips in enumerate(_PAIRS):
        at = np.flatnonzero(s == syndrome)
        for flip in flips if len(at) else ():
            yield at, value[at] ^ flip
    exact = np.flatnonzero(s == 0)
    for i in range(15, length):
        yield all_places, (high ^ (1 << i)) | _nearest(low)
        for j in range(15, i):
            yield exact, value[exact] ^ (1 << i | 1 << j)


def _placed(classes: DataFrame, distance: int, home: bool) -> DataFrame:
    """(anchor, fp): homes, or all copies; the anchor's number holds its window."""
    spans = windows(distance)

    def task(batches):
        for batch in small_batches(batches, 4096):
            fp = batch.column("fp").to_numpy().view(np.uint64)
            for w, (start, length) in enumerate(spans):
                if home:
                    found = [(np.arange(len(fp)), homes(fp, start, length))]
                else:
                    found = list(copies(fp, start, length))
                place = np.concatenate([p for p, _ in found])
                anchor = np.concatenate([a for _, a in found]) * len(spans) + w
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor), pa.array(fp[place].view(np.int64))], ["anchor", "fp"]
                )

    return map_arrow(classes.select("fp"), task, "anchor long, fp long")


class _Forest:
    """Groups of a task's fingerprints, and the links that joined them."""

    def __init__(self, fp: np.ndarray):
        self.fp = np.unique(fp)
        self.group = np.arange(len(self.fp))
        self.kept: list[tuple[int, int]] = []

    def place(self, fp: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.fp, fp)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        """Joins the groups of the places ``a`` and ``b``, pair by pair."""
        group = self.group
        while (group != (up := group[group])).any():
            group = up
        one, other = np.minimum(group[a], group[b]), np.maximum(group[a], group[b])
        fresh = np.flatnonzero(one != other)
        _, first = np.unique(one[fresh] * len(group) + other[fresh], return_index=True)
        for i in fresh[first].tolist():
            x, y = int(a[i]), int(b[i])
            while group[x] != x:
                x = group[x]
            while group[y] != y:
                y = group[y]
            if x != y:
                group[max(x, y)] = min(x, y)
                self.kept.append((a[i], b[i]))
        self.group = group

    def links(self) -> pa.Table:
        ends = self.fp.view(np.int64)[np.array(self.kept, np.int64).reshape(-1, 2)]
        return pa.table({"a": ends[:, 0].copy(), "b": ends[:, 1].copy()})


def _join_crowd(forest: _Forest, home: np.ndarray, near: np.ndarray, distance: int) -> None:
    """The links of an anchor with many, block by block; blocks grow, as first ones join most groups."""
    own, other = forest.place(home), forest.place(near)
    at, step, most = 0, 1, max(1, PAIR_CELLS // max(len(near), 1))
    while at < len(home):
        apart = np.bitwise_count(home[at : at + step, None] ^ near[None, :])
        a, b = np.nonzero((apart <= distance) & (apart > 0))
        forest.join(own[a + at], other[b])
        at, step = at + step, min(2 * step, most)


def _join_all(forest: _Forest, home_anchor, home, near_anchor, near, distance: int) -> None:
    """The links of a task's anchors. Those where few live share flat arrays, a cell for each pair to compare."""
    order = np.argsort(near_anchor, kind="stable")
    near_anchor, near = near_anchor[order], near[order]
    order = np.argsort(home_anchor, kind="stable")
    home_anchor, home = home_anchor[order], home[order]
    lo = np.searchsorted(near_anchor, home_anchor)
    width = np.searchsorted(near_anchor, home_anchor, side="right") - lo
    first = np.flatnonzero(np.append(True, home_anchor[1:] != home_anchor[:-1])) if len(home) else np.zeros(0, int)
    stop = np.append(first[1:], len(home))[: len(first)]
    large = (stop - first) * width[first] > PAIR_CELLS // 64
    for a, b in zip(first[large].tolist(), stop[large].tolist()):
        _join_crowd(forest, home[a:b], near[lo[a] : lo[a] + width[a]], distance)
    small = np.flatnonzero(np.repeat(~large, stop - first))
    edges = np.cumsum(width[small])
    at = 0
    while at < len(small):
        base = edges[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(edges, base + PAIR_CELLS, side="right")))
        rows = small[at:to]
        mine = np.repeat(rows, width[rows])
        starts = np.cumsum(width[rows]) - width[rows]
        other = np.arange(len(mine)) - np.repeat(starts - lo[rows], width[rows])
        apart = np.bitwise_count(home[mine] ^ near[other])
        hit = np.flatnonzero((apart <= distance) & (apart > 0))
        forest.join(forest.place(home[mine[hit]]), forest.place(near[other[hit]]))
        at = to


def links(classes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(a, b): links between distinct fingerprints (``fp``), enough of them to tell all components."""
    total = classes.count()
    placed_homes = staged(_placed(classes, distance, home=True))
    per_anchor = placed_homes.groupBy(F.col("anchor").alias("hot")).agg(F.count("*").alias("n"))
    # At most one in HOME_ROWS of the fingerprints' homes is such an anchor.
    crowded = staged(
        per_anchor.filter(F.col("n") > HOME_ROWS).select("hot", F.ceil(F.col("n") / HOME_ROWS).cast("int").alias("deals"))
    )
    # A fingerprint has about fifteen copies in each window of twenty-one bits.
    buckets = max(1, total * 15 * len(windows(distance)) // BUCKET_COPIES)

    def dealt(rows: DataFrame, side: int, deal: Column) -> DataFrame:
        known = rows.join(crowded, F.col("anchor") == F.col("hot"), "left").withColumn("deal", deal)
        bucket = F.pmod(F.xxhash64("anchor", "deal"), F.lit(buckets))
        return known.select(bucket.alias("bucket"), F.lit(side).alias("side"), "anchor", "deal", "fp")

    one = F.pmod(F.xxhash64("fp"), F.coalesce("deals", F.lit(1))).cast("int")
    each = F.explode(F.sequence(F.lit(0), F.coalesce("deals", F.lit(1)) - 1))
    # The copies hold the homes too: each lives at an anchor within reach of itself.
    rows = dealt(placed_homes, 0, one).unionByName(dealt(_placed(classes, distance, home=False), 1, each))

    def compare(table: pa.Table) -> pa.Table:
        side = table.column("side").to_numpy()
        # Anchor numbers take at most 34 bits.
        anchor = table.column("anchor").to_numpy() << 24 | table.column("deal").to_numpy()
        fp = table.column("fp").to_numpy().view(np.uint64)
        home, near = side == 0, side == 1
        forest = _Forest(fp[near])
        _join_all(forest, anchor[home], fp[home], anchor[near], fp[near], distance)
        return forest.links()

    return apply_arrow(rows.groupBy("bucket"), compare, "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame,
    k: int = WORDS,
    distance: int = DISTANCE,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """(doc_id, fp, component_id): the fingerprint of every document and the least id of its component."""
    found = staged(fingerprints(docs, k, text, doc_id))
    classes = staged(found.groupBy("fp").agg(F.min("doc_id").alias("least")))
    linked = connected_components(links(classes, distance))
    keyed = classes.join(linked, F.col("fp") == F.col("v"), "left").withColumn("key", F.coalesce("component", "fp"))
    least = keyed.groupBy(F.col("key").alias("g")).agg(F.min("least").alias("component_id"))
    named = staged(keyed.join(least, F.col("key") == F.col("g")).select(F.col("fp").alias("f"), "component_id"))
    return found.join(named, F.col("fp") == F.col("f")).select("doc_id", "fp", "component_id")


def hex_digits(fp: Column) -> Column:
    """A fingerprint as sixteen lowercase hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
