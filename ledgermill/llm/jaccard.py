"""Exact similarity join of documents on the Jaccard index of their word shingles.

1. Documents with equal shingle sets form a class; everything below works on classes.
2. A first filter orders shingles by hash. Two sets of similarity s share the l smallest of their
   common shingles within the first n - ceil(s n) + l of each, so a class that shares too few of
   those with any other class has no partner. What travels is packed, and a shingle that already
   meets a second class within a task is settled there.
3. The classes left are ordered rare first, by exact document frequency. Shingles of frequency one
   cannot be shared, so they fill the prefix first; many classes drop out here.
4. Prefix shingles are joined, with length, positional and suffix filters (the last compares counts
   of shingles by hash range), and each pair is verified once on the whole sets.

Linked groups may be huge, and all their pairs are not needed to know them. So each prefix shingle
first pairs its classes with one hub only; the links found make components; and all other pairs are
made just across components. A long list of near copies thus costs its length, not its square, and no
link between different components is lost. Lists that stay mixed get further hubs before the rest of
their pairs are made.

Edge cases: texts without words (NULL too) have an empty set and stay alone; texts shorter than a
shingle are one shingle; equal rows fall in one class; a NULL id is an id like any other but is named
as component only where there is no other; an empty table gives no rows; other columns are not looked
at. Whole texts are read, in slices of bounded memory.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import apply_arrow, map_arrow, staged
from ledgermill.llm.components import connected_components
from ledgermill.llm.textnum import mix, shingle_sets, slices

WORDS = 5
SIMILARITY = 80  # in hundredths
FLUSH_ENTRIES = 600_000
BUCKET_BYTES = 1_000_000
# A side of at most so many (id, hash) rows, counted first, is broadcast: under 100 MB as a hash table.
BROADCAST_ROWS = 500_000
RANGES = 16  # hash ranges of the suffix filter
HUB_ROUNDS = 4


def least_shared(n, similarity: int = SIMILARITY):
    """Shingles that a set of n must have in common with any partner; for numbers and columns."""
    return -(-similarity * n // 100)


def _extra(n):
    return 1 + n // 5


def _sets(column: pa.Array, k: int):
    """(place in the batch, set, class) for each text with words; the class is a hash of the set."""
    for part in slices(column):
        for j, found in enumerate(shingle_sets(part, k)):
            if len(found):
                digest = hashlib.blake2b(found.tobytes(), digest_size=8).digest()
                yield part.at + j, found, int.from_bytes(digest, "little", signed=True)


def shingle_classes(docs: DataFrame, k: int = WORDS, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, th, n, cls) for every document: hash of the text, size of its set, class (NULL if empty)."""
    narrow = docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("th"), F.col(text).alias("text")
    )

    def task(batches):
        for batch in batches:
            n = np.zeros(batch.num_rows, np.int64)
            cls: list[int | None] = [None] * batch.num_rows
            for i, found, c in _sets(batch.column("text"), k):
                n[i], cls[i] = len(found), c
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("th"), pa.array(n), pa.array(cls, pa.int64())],
                ["doc_id", "th", "n", "cls"],
            )

    kind = narrow.schema["doc_id"].dataType.simpleString()
    return map_arrow(narrow, task, f"doc_id {kind}, th long, n long, cls long")


def _pack(hashes: np.ndarray, classes: np.ndarray) -> bytes:
    """Five bytes of each hash, then six of each class: enough for a filter that may keep too much."""
    parts = (hashes.view(np.uint8).reshape(-1, 8)[:, :5], classes.view(np.uint8).reshape(-1, 8)[:, :6])
    return b"".join(p.tobytes() for p in parts)


def _unpack(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(payload) // 11
    raw = np.frombuffer(payload, np.uint8)
    hashes, classes = np.zeros((n, 8), np.uint8), np.zeros((n, 8), np.uint8)
    hashes[:, :5], classes[:, :6] = raw[: 5 * n].reshape(n, 5), raw[5 * n :].reshape(n, 6)
    return hashes.view(np.uint64).ravel(), classes.view(np.uint64).ravel()


_LOW48 = (1 << 48) - 1


def _meetings(docs: DataFrame, buckets: int, k: int, similarity: int, text: str) -> DataFrame:
    """(short, met): by the low 48 bits of a class, its first-filter shingles that meet another class."""
    narrow = docs.select(F.col(text).alias("text"))

    def send(batches):
        hashes, classes, seen, held = [], [], set(), 0

        def flush():
            h, c = np.concatenate(hashes), np.concatenate(classes)
            order = np.argsort(h, kind="stable")
            h, c = h[order], c[order]
            first = np.append(True, h[1:] != h[:-1])
            alone = first & np.append(first[1:], True)
            settled, counts = np.unique(c[~alone], return_counts=True)
            # A settled shingle goes on once, as class 0, to tell the other tasks.
            h, c = np.append(h[alone], h[first & ~alone]), np.append(c[alone], np.zeros((first & ~alone).sum(), np.uint64))
            place = (h % np.uint64(buckets)).astype(np.int64)
            h = h // np.uint64(buckets)
            order = np.argsort(place, kind="stable")
            place, h, c = place[order], h[order], c[order]
            marks = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
            ends = np.append(marks[1:], len(place))
            rows = [(int(place[a]), 0, _pack(h[a:b], c[a:b])) for a, b in zip(marks, ends)]
            if len(settled):
                rows.append((int(settled[0] % np.uint64(buckets)), 1, settled.tobytes() + counts.astype(np.int64).tobytes()))
            for column in (hashes, classes):
                column.clear()
            seen.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.binary())],
                ["bucket", "kind", "payload"],
            )

        for batch in batches:
            for _, found, c in _sets(batch.column("text"), k):
                if c not in seen:
                    seen.add(c)
                    n = len(found)
                    part = found[: n - least_shared(n, similarity) + _extra(n)]
                    hashes.append(mix(part))  # spreads the smallest hashes over all buckets
                    classes.append(np.full(len(part), c & _LOW48 or 1, np.uint64))
                    held += len(part)
                    if held >= FLUSH_ENTRIES:
                        yield flush()
                        held = 0
        if held:
            yield flush()

    def meet(table: pa.Table) -> pa.Table:
        kinds = table.column("kind").to_numpy()
        payloads = table.column("payload")
        h, c, out, counts = [], [], [], []
        for i, kind in enumerate(kinds):
            payload = payloads[i].as_py()
            if kind:
                both = np.frombuffer(payload, np.int64)
                out.append(both[: len(both) // 2])
                counts.append(both[len(both) // 2 :])
            else:
                one, two = _unpack(payload)
                h.append(one)
                c.append(two)
        if h:
            h, c = np.concatenate(h), np.concatenate(c)
            order = np.lexsort((c, h))
            h, c = h[order], c[order]
            begin = np.append(True, h[1:] != h[:-1])
            group = np.cumsum(begin) - 1
            starts = np.flatnonzero(begin)
            ends = np.append(starts[1:], len(h)) - 1
            shared = (c[starts] != c[ends]) | (c[starts] == 0)
            fresh = np.append(True, (h[1:] != h[:-1]) | (c[1:] != c[:-1]))
            found, times = np.unique(c[shared[group] & fresh & (c != 0)], return_counts=True)
            out.append(found.astype(np.int64))
            counts.append(times.astype(np.int64))
        return pa.table({"short": np.concatenate(out), "met": np.concatenate(counts)})

    sent = map_arrow(narrow, send, "bucket int, kind int, payload binary")
    met = apply_arrow(sent.groupBy("bucket"), meet, "short long, met long")
    return met.groupBy("short").agg(F.sum("met").alias("met"))


def _whole_sets(docs: DataFrame, k: int, text: str) -> DataFrame:
    """(cls, n, sh, ranges): the sets themselves, and their counts by hash range."""
    narrow = docs.select(F.col(text).alias("text"))

    def task(batches):
        for batch in batches:
            rows, size = [], 0
            for _, found, c in _sets(batch.column("text"), k):
                ranges = np.bincount((found >> np.uint64(60)).astype(np.int64), minlength=RANGES)
                rows.append((c, len(found), found.view(np.int64), ranges))
                size += len(found)
                if size >= FLUSH_ENTRIES:
                    yield _set_batch(rows)
                    rows, size = [], 0
            yield _set_batch(rows)

    return map_arrow(narrow, task, "cls long, n long, sh array<long>, ranges array<int>")


def _set_batch(rows) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()))
    columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
    return pa.RecordBatch.from_arrays(columns, ["cls", "n", "sh", "ranges"])


def if_small(df: DataFrame) -> DataFrame:
    """A written table, marked for broadcast if it has few enough rows."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _ceil_div(a: Column, b: int) -> Column:
    return F.floor((a + (b - 1)) / b)


def _survivors(docs: DataFrame, classes: DataFrame, k: int, similarity: int, text: str) -> DataFrame:
    """Whole sets of the classes that the first filter keeps."""
    size = docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    # About a third of the words' shingles, of at least two bytes a word, packed in eleven.
    buckets = max(1, -(-size * 11 // (18 * BUCKET_BYTES)))
    met = _meetings(docs, buckets, k, similarity, text)
    known = classes.filter("cls IS NOT NULL").groupBy("cls", "n").agg(
        F.min(F.struct("doc_id", "th")).alias("first")
    )
    need = F.lit(1) + F.floor(_ceil_div(F.col("n") * similarity, 100) / 5)
    low = F.col("cls").bitwiseAND(F.lit(_LOW48))
    short = F.when(low == 0, F.lit(1).cast("long")).otherwise(low)
    kept = staged(
        known.join(met, short == F.col("short"))
        .filter(F.col("met") >= need)
        .select(F.col("first.doc_id").alias("i"), F.col("first.th").alias("t"))
        .distinct()
    )
    chosen = docs.join(
        if_small(kept),
        F.col(f"{_ID}").eqNullSafe(F.col("i")) & (F.xxhash64(F.col(text)) == F.col("t")),
        "left_semi",
    )
    return staged(_whole_sets(chosen, k, text).dropDuplicates(["cls"]))


_ID = "doc_id"


def _live(sets: DataFrame, similarity: int) -> DataFrame:
    """(cls, n, alone, take, sh, ranges): classes whose prefix, rare first, has shared shingles.

    ``sh`` holds just the shingles that other classes have too, rare first: all that an intersection
    can consist of. The first ``take`` of them are in the prefix, after ``alone`` that are not shared.
    """
    items = sets.select("cls", "n", F.explode("sh").alias("h"))
    frequency = (
        items.groupBy("h").agg(F.count("*").alias("df")).filter("df > 1").withColumnRenamed("h", "g")
    )
    least = _ceil_div(F.col("n") * similarity, 100)
    ordered = (
        items.join(frequency, F.col("h") == F.col("g"))
        .groupBy("cls", "n")
        .agg(F.array_sort(F.collect_list(F.struct("df", "h"))).alias("shared"))
        .withColumn("alone", F.col("n") - F.size("shared"))
        .withColumn("take", (F.col("n") - least + 1 - F.col("alone")).cast("int"))
        .filter("take > 0")
        .select("cls", "n", "alone", "take", F.transform("shared", lambda s: s["h"]).alias("sh"))
    )
    return ordered.join(sets.select(F.col("cls").alias("c"), "ranges"), F.col("cls") == F.col("c")).drop("c")


def _postings(live: DataFrame, similarity: int) -> DataFrame:
    """(h, cls, n, alone, i): the shared prefix shingles of each class; shingle ``i`` of the shared.

    The first shingle that a pair has in common lies within n - needed of either class, and what is
    needed grows with the partner. Left out are shingles too far back for even the shortest class of
    their list.
    """
    prefix = live.select("cls", "n", "alone", F.posexplode(F.slice("sh", F.lit(1), F.col("take"))).alias("i", "h"))
    lists = prefix.groupBy(F.col("h").alias("g")).agg(F.min("n").alias("least"), F.count("*").alias("k"))
    needed = _ceil_div(similarity * (F.col("n") + F.col("least")), 100 + similarity)
    return (
        prefix.join(lists.filter("k > 1"), F.col("h") == F.col("g"))
        .filter(F.col("alone") + F.col("i") <= F.col("n") - needed)
        .select("h", "cls", "n", "alone", "i")
    )


def _alpha(similarity: int) -> Column:
    """Shingles that sets of na and nb must share."""
    return _ceil_div(similarity * (F.col("na") + F.col("nb")), 100 + similarity)


def _side(name: str, of: str = "") -> list[Column]:
    """Columns of one side of a pair."""
    return [
        F.col(f"{of}{c}").alias(a)
        for c, a in (("cls", name), ("n", f"n{name}"), ("alone", f"l{name}"), ("i", f"i{name}"))
    ]


def _filtered(pairs: DataFrame, similarity: int) -> DataFrame:
    """Pairs of one prefix shingle, filtered by length and position, and made distinct.

    Before the shingle both sides can only have shared ones in common, after it what is left of them.
    A pair's first common shingle lies early enough on both sides; others need not propose it again.
    """
    long_enough = (100 * F.least("na", "nb")) >= similarity * F.greatest("na", "nb")
    left = F.least(F.col("na") - F.col("la") - F.col("ia"), F.col("nb") - F.col("lb") - F.col("ib"))
    alpha = _alpha(similarity)
    early = (F.col("la") + F.col("ia") <= F.col("na") - alpha) & (
        F.col("lb") + F.col("ib") <= F.col("nb") - alpha
    )
    return (
        pairs.filter(long_enough & early & (F.least("ia", "ib") + left >= alpha))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )


def _verified(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """The pairs whose whole sets are similar, with the counts that prove it."""
    side = lambda x: sets.select(
        F.col("cls").alias(x), F.col("n").alias(f"n{x}"), F.col("sh").alias(f"s{x}"), F.col("ranges").alias(f"r{x}")
    )
    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    at_most = F.aggregate(
        F.zip_with("ra", "rb", lambda x, y: F.least(x, y)), F.lit(0), lambda acc, x: acc + x
    )
    shared = F.when(at_most >= _alpha(similarity), F.size(F.array_intersect("sa", "sb"))).otherwise(0)
    return (
        joined.withColumn("shared", shared.cast("long"))
        .filter(100 * F.col("shared") >= similarity * (F.col("na") + F.col("nb") - F.col("shared")))
        .select("a", "b", "shared", "na", "nb")
    )


def _components_of(postings: DataFrame, sets: DataFrame, similarity: int) -> DataFrame | None:
    """(v, component) of the linked classes; None if there are none."""
    links, labels, won = None, None, 0
    for turn in range(HUB_ROUNDS + 1):
        # Lists that still hold classes of different components.
        if labels is None:
            marked = postings.withColumn("component", F.col("cls"))
        else:
            marked = postings.join(labels, F.col("cls") == F.col("v"), "left").withColumn(
                "component", F.coalesce("component", "cls")
            ).drop("v")
        mixed = (
            marked.groupBy("h", "component").agg(F.count("*").alias("k"))
            .groupBy("h")
            .agg(F.count("*").alias("parts"), F.sum("k").alias("k"), F.sum(F.col("k") * F.col("k")).alias("kk"))
            .filter("parts > 1")
            .select(F.col("h").alias("g"), "k", ((F.col("k") * F.col("k") - F.col("kk")) / 2).alias("pairs"))
        )
        open_lists = staged(mixed)
        size = open_lists.agg(F.sum("k").alias("k"), F.sum("pairs").alias("pairs")).first()
        if not size["k"]:
            break
        active = staged(
            marked.join(open_lists, F.col("h") == F.col("g")).select("h", "cls", "n", "alone", "i", "component")
        )
        # Hubs are done with where few pairs are left, or a round has linked few of the classes.
        spent = size["pairs"] <= 4 * size["k"] or 20 * won < active.select("cls").distinct().count()
        rest = turn == HUB_ROUNDS or turn > 0 and spent
        if rest:
            pairs = _across(active)
        else:
            # The first hub is the class that most of the others resemble: little of it is its own.
            central = F.col("alone") if turn == 0 else F.lit(0)
            chosen = F.struct(
                central.alias("own"), F.xxhash64(F.lit(turn), "cls").alias("x"), "cls", "n", "alone", "i", "component"
            )
            hubs = active.groupBy(F.col("h").alias("g")).agg(F.min(chosen).alias("hub"))
            pairs = (
                active.join(hubs, F.col("h") == F.col("g"))
                .filter(F.col("component") != F.col("hub.component"))
                .select(*_side("a"), *_side("b", "hub."))
            )
        found = staged(_verified(_filtered(pairs, similarity), sets, similarity).select("a", "b"))
        won = found.count()
        if won:
            links = found if links is None else links.unionByName(found)
            labels = connected_components(links)
        if rest:
            break
    return labels


def _across(active: DataFrame) -> DataFrame:
    """All pairs of a list that lie in different components."""
    one = active.select("h", *_side("a"), "component")
    other = active.select(F.col("h").alias("g"), *_side("b"), F.col("component").alias("cb"))
    return one.join(
        other, (F.col("h") == F.col("g")) & (F.col("a") < F.col("b")) & (F.col("component") != F.col("cb"))
    )


def near_duplicates(
    docs: DataFrame,
    k: int = WORDS,
    similarity: int = SIMILARITY,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """(doc_id, th, n_shingles, first): each document and the least (doc_id, th) of its component.

    ``th`` is ``xxhash64`` of the text, which tells rows of one id apart.
    """
    docs = docs.select(F.col(doc_id).alias(_ID), F.col(text).alias("text"))
    classes = staged(shingle_classes(docs, k))
    sets = _survivors(docs, classes, k, similarity, "text")
    live = staged(_live(sets, similarity))
    labels = _components_of(staged(_postings(live, similarity)), live, similarity)
    if labels is None:
        keyed = classes.withColumn("key", F.col("cls"))
    else:
        keyed = classes.join(labels, F.col("cls") == F.col("v"), "left").withColumn(
            "key", F.coalesce("component", "cls")
        )
    named = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "th")
    # Written, so that the join below has a shuffle on both sides, which a hot component can be split in.
    firsts = staged(
        keyed.filter("key IS NOT NULL").groupBy(F.col("key").alias("g")).agg(F.min(named).alias("first"))
    )
    found = keyed.join(firsts, F.col("key") == F.col("g"), "left")
    first = F.when(F.col("key").isNull(), named).otherwise(F.col("first"))
    return found.select("doc_id", "th", F.col("n").alias("n_shingles"), first.alias("first"))


def drop_near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """One document of each component, the one of the least id; columns as they came.

    Documents without words are all kept. Of rows with the same id and text one stays.
    """
    found = staged(near_duplicates(docs, text=text, doc_id=doc_id, **options))
    twice = staged(
        found.filter("n_shingles > 0").groupBy("doc_id", "th").agg(F.count("*").alias("rows")).filter("rows > 1")
    )
    is_first = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("th") == F.col("first.th"))
    gone = staged(
        found.filter(~is_first & (F.col("n_shingles") > 0))
        .select(F.col("doc_id").alias("i"), F.col("th").alias("t"))
        .distinct()
    )
    same = F.col("d").eqNullSafe(F.col("i")) & (F.col("x") == F.col("t"))
    rows = docs.select(F.struct("*").alias("row")).withColumns(
        {"d": F.col(f"row.`{doc_id}`"), "x": F.xxhash64(F.col(f"row.`{text}`"))}
    )
    kept = rows.join(if_small(gone), same, "left_anti")
    if not twice.isEmpty():
        again = if_small(twice.select(F.col("doc_id").alias("i"), F.col("th").alias("t")))
        single = kept.join(again, same, "left_anti")
        repeated = kept.join(again, same, "left_semi").dropDuplicates(["d", "x"])
        kept = single.unionByName(repeated)
    return kept.select("row.*")
