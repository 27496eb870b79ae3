"""Collocations: frequent phrases of two to four words, scored against the parts they can be cut into.

Frequent phrases are found by partitioning, in two passes. Documents are dealt to ``SHARDS`` shards by
hash. A phrase that occurs ``min_count`` times in all occurs in some shard at least as often as that
shard's share of the text asks, so

1. each shard is mined completely at the support lowered by its share: words and pairs first, then longer
   phrases all of whose pairs are frequent. Only packed hashes with counts travel, combined in each
   task; a shard's phrases are counted in slices of the hash space of bounded size. The union of what is
   frequent in some shard is kept as a bitmap over the hash space, whose size is bounded (``MOST_BITS``);
2. all phrases that the bitmap holds are counted over all texts, now as strings, combined in each task.

Hash collisions, or a bitmap too small for its input, let phrases through that are counted for
nothing. They lose none, and the counts are those of strings, so results are exact.

Scoring joins the candidates with the counts of their parts; every part of a frequent phrase is
frequent. The ranking is made in two steps, so that no task sorts a whole language.

Edge cases: NULL and empty texts have no words; a NULL language is ``und``; repeated rows count each;
words are whatever is between blanks, tabs and breaks, of any length; languages without candidates
give no rows, and an empty table gives none; other columns are not looked at. Texts are read whole, in
slices of bounded memory.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.llm.common import apply_arrow, map_arrow, staged
from ledgermill.llm.textnum import Slice, byte_set, mix, slices

# What ends a piece of text, and what parts its words.
BREAKS = b".,;:!?\n\v\f\r"
BLANKS = b" \t"
MIN_COUNT = 30
MOST_WORDS = 4
COVERED = 80  # hundredths of its occurrences that a longer phrase may take from a phrase
MOST_RANKS = 2000

SHARD_BITS = 3
SHARDS = 1 << SHARD_BITS
# What a task holds before it counts: more combines better, and takes more memory in each Python worker.
FLUSH_HASHES = 1_000_000
FLUSH_PHRASES = 500_000
BUCKET_PHRASES = 1_000_000
KEPT_BITS = 37  # of a hash below its bucket
MOST_BITS = 29  # the bitmap has at most 2 ** 29 bits: 64 MB
SORT_ROWS = 500_000

_BREAK, _GAP = byte_set(BREAKS), byte_set(BREAKS + BLANKS)
_STEP = np.uint64(0xD1342543DE82EF95)


def _held(table: np.ndarray, bits: int, h: np.ndarray) -> np.ndarray:
    """Whether the bitmap holds the hashes."""
    place = (h >> np.uint64(64 - bits)).astype(np.int64)
    return (table[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)


def _phrases(part: Slice, lang: np.ndarray, lengths: range, pairs: tuple[np.ndarray, int] | None = None):
    """For each length k: places of the first words of its phrases, their hashes and texts.

    ``lang`` holds a hash for each text of the slice. With ``pairs``, a bitmap, only phrases of which it
    holds every two neighbouring words.
    """
    owner = np.repeat(np.arange(len(part)), np.diff(part.first))
    breaks = np.zeros(len(part.raw) + 1, np.int64)
    np.cumsum(_BREAK[part.raw], out=breaks[1:])
    piece = breaks[part.start] + owner
    h = mix(part.word ^ lang[owner])
    frequent = None
    for k in range(1, lengths.stop):
        if k > len(part.word):
            return
        if k > 1:
            h = mix(h[:-1] * _STEP + part.word[k - 1 :])
        whole = piece[k - 1 :] == piece[: len(h)]
        if pairs and k == 2:
            frequent = _held(*pairs, h)
        if pairs and k > 2:
            for i in range(k - 1):
                whole &= frequent[i : i + len(h)]
        if k in lengths:
            at = np.flatnonzero(whole)
            yield k, at, h[at], owner[at]


def _narrow(docs: DataFrame, text: str, lang: str, doc_id: str) -> DataFrame:
    named = F.coalesce(F.col(lang), F.lit("und"))
    return docs.select(
        F.col(text).alias("text"),
        named.alias("lang"),
        F.xxhash64(named).alias("lh"),
        F.pmod(F.xxhash64(F.col(doc_id), F.col(text)), F.lit(SHARDS)).cast("int").alias("shard"),
    )


def _packed(z: np.ndarray) -> pa.RecordBatch:
    """Counts of (bucket, rest of the hash, shard) as one row per bucket: five bytes each, then a count each."""
    z.sort()
    first = np.flatnonzero(np.append(True, z[1:] != z[:-1]))
    counts, z = np.diff(np.append(first, len(z))), z[first]
    times = -(-counts // 255)
    ends = np.cumsum(times)
    size = np.full(ends[-1], 255)
    size[ends - 1] = counts - 255 * (times - 1)
    z, size = np.repeat(z, times), size.astype(np.uint8)
    bucket = (z >> np.uint64(KEPT_BITS + SHARD_BITS)).astype(np.int64)
    rest = z.view(np.uint8).reshape(-1, 8)[:, :5]
    marks = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    rows = [rest[a:b].tobytes() + size[a:b].tobytes() for a, b in zip(marks, [*marks[1:], len(z)])]
    return pa.RecordBatch.from_arrays([pa.array(bucket[marks]), pa.array(rows, pa.binary())], ["bucket", "payload"])


def _mined(
    narrow: DataFrame, need: list[int], bucket_bits: int, bits: int, lengths: range, shared=None
) -> DataFrame:
    """(bucket, bits): the bitmap's part for each bucket of hashes, with the phrases frequent in some shard.

    ``shared`` is a bitmap that holds the word pairs frequent in some shard, if longer phrases are mined.
    """

    def send(batches):
        held, size = [], 0
        pairs = shared and (np.frombuffer(shared.value, np.uint8), bits)
        for batch in batches:
            lang = batch.column("lh").to_numpy().view(np.uint64)
            shard = batch.column("shard").to_numpy().astype(np.uint64)
            for part in slices(batch.column("text"), gaps=_GAP):
                stop = part.at + len(part)
                for _, _, h, owner in _phrases(part, lang[part.at : stop], lengths, pairs):
                    z = h >> np.uint64(64 - KEPT_BITS - bucket_bits) << np.uint64(SHARD_BITS)
                    held.append(z | shard[part.at : stop][owner])
                    size += len(h)
                if size >= FLUSH_HASHES:
                    yield _packed(np.concatenate(held))
                    held, size = [], 0
        if size:
            yield _packed(np.concatenate(held))

    needed = np.array(need)

    def mine(table: pa.Table) -> pa.Table:
        keys, sizes = [], []
        for payload in table.column("payload").to_pylist():
            raw = np.frombuffer(payload, np.uint8)
            n = len(raw) // 6
            key = np.zeros((n, 8), np.uint8)
            key[:, :5] = raw[: 5 * n].reshape(n, 5)
            keys.append(key.view(np.uint64).ravel())
            sizes.append(raw[5 * n :])
        key, size = np.concatenate(keys), np.concatenate(sizes)
        order = np.argsort(key)
        key, size = key[order], size[order].astype(np.int64)
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        count, key = np.add.reduceat(size, first), key[first]
        frequent = key[count >= needed[(key & np.uint64(SHARDS - 1)).astype(np.int64)]]
        held = np.zeros(1 << (bits - bucket_bits), np.uint8)
        held[frequent >> np.uint64(SHARD_BITS + KEPT_BITS - (bits - bucket_bits))] = 1
        bucket = table.column("bucket").slice(0, 1)
        return pa.table({"bucket": bucket, "bits": pa.array([np.packbits(held, bitorder="little").tobytes()])})

    sent = map_arrow(narrow.select("text", "lh", "shard"), send, "bucket long, payload binary")
    return apply_arrow(sent.groupBy("bucket"), mine, "bucket long, bits binary")


def _counted(narrow: DataFrame, bitmap, bits: int, most: int) -> DataFrame:
    """(lang, phrase, n) as counted in each task; a NULL phrase stands for all words."""
    names = ["lang", "phrase", "n"]

    def task(batches):
        held, texts, langs, raws, bounds, words, size = [], 0, [], [], [], {}, 0
        table = np.frombuffer(bitmap.value, np.uint8)

        def flush():
            h, begin, stop, text = (np.concatenate(c) for c in zip(*held)) if held else [np.zeros(0, np.int64)] * 4
            _, first, count = np.unique(h, return_index=True, return_counts=True)
            text, begin, stop = text[first], begin[first], stop[first]
            found = np.searchsorted(bounds, text, side="right") - 1
            phrases = [
                b" ".join(raws[r][a:b].split())
                for r, a, b in zip(found.tolist(), begin.tolist(), stop.tolist())
            ]
            spoken = pa.array(langs, pa.string()).take(pa.array(text))
            for a in range(0, len(phrases), 100_000):
                part = pa.array(phrases[a : a + 100_000], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [spoken.slice(a, len(part)), part, pa.array(count[a : a + 100_000])], names
                )
            kinds = (pa.string(), pa.string(), pa.int64())
            rows = [list(words), [None] * len(words), list(words.values())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)], names)

        for batch in batches:
            lang_hash = batch.column("lh").to_numpy().view(np.uint64)
            lang = batch.column("lang").to_pylist()
            for part in slices(batch.column("text"), gaps=_GAP):
                stop = part.at + len(part)
                bounds.append(texts)
                raws.append(part.raw.tobytes().lower())
                for k, at, h, owner in _phrases(part, lang_hash[part.at : stop], range(1, most + 1), (table, bits)):
                    kept = np.flatnonzero(_held(table, bits, h))
                    at = at[kept]
                    ends = part.end[at + (k - 1)]
                    held.append(
                        (h[kept], part.start[at].astype(np.int32), ends.astype(np.int32), owner[kept] + texts)
                    )
                    size += len(at)
                for name, n in zip(lang[part.at : stop], np.diff(part.first).tolist()):
                    words[name] = words.get(name, 0) + n
                langs.extend(lang[part.at : stop])
                texts += len(part)
                if size >= FLUSH_PHRASES:
                    yield from flush()
                    held, texts, langs, raws, bounds, words, size = [], 0, [], [], [], {}, 0
        yield from flush()

    return map_arrow(narrow.select("text", "lang", "lh"), task, "lang string, phrase string, n long")


def frequent_phrases(
    docs: DataFrame,
    min_count: int = MIN_COUNT,
    most: int = MOST_WORDS,
    text: str = "text",
    lang: str = "lang",
    doc_id: str = "doc_id",
) -> DataFrame:
    """(lang, phrase, n): exact counts of all phrases of up to ``most`` words found ``min_count`` times.

    A row with a NULL phrase counts all words of the language. The result is a written table.
    """
    narrow = _narrow(docs, text, lang, doc_id)
    shares = dict(
        narrow.groupBy("shard").agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)))).collect()
    )
    size = sum(shares.values())
    # The least count in a shard that its share of the whole support allows, rounded up.
    need = [max(1, -(-min_count * shares.get(i, 0) // max(size, 1))) for i in range(SHARDS)]
    # About a word in six bytes, two lengths at a time, two thirds of their phrases left by a task's count.
    bucket_bits = min(24, max(1, (size * 2 // (9 * BUCKET_PHRASES)).bit_length()))
    bits = max(bucket_bits + 3, min(MOST_BITS, (size // 8).bit_length()))
    bitmap, width, shared = bytearray(1 << (bits - 3)), 1 << (bits - bucket_bits - 3), None
    # Longer phrases are made of frequent pairs only, so these are mined first.
    for lengths in (range(1, min(most, 2) + 1), range(3, most + 1)):
        if lengths:
            parts = _mined(narrow, need, bucket_bits, bits, lengths, shared).collect()  # 2 ** bits bits in all
            for bucket, held in parts:
                at = slice(bucket * width, (bucket + 1) * width)
                both = int.from_bytes(bitmap[at], "little") | int.from_bytes(held, "little")
                bitmap[at] = both.to_bytes(width, "little")
            shared = docs.sparkSession.sparkContext.broadcast(bytes(bitmap))
    counted = _counted(narrow, shared, bits, most).groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
    return staged(counted.filter((F.col("n") >= min_count) | F.col("phrase").isNull()))


def _words(first: Column | int, count: Column | int) -> Column:
    return F.array_join(F.slice("words", first, count), " ")


def _exact(value: Column) -> Column:
    """For products beyond 64 bits."""
    return value.cast("decimal(28,0)")


def score_phrases(phrases: DataFrame) -> DataFrame:
    """(lang, phrase, words, a, k, l, r, score) of each phrase of two words or more, by its lowest cut."""
    several = (
        phrases.select("lang", "phrase", F.split("phrase", " ").alias("words"), F.col("n").alias("a"))
        .filter(F.size("words") > 1)
    )
    cuts = F.transform(
        F.sequence(F.lit(1), F.size("words") - 1),
        lambda k: F.array(
            F.struct(k.alias("k"), F.lit(0).alias("side"), _words(F.lit(1), k).alias("part")),
            F.struct(k.alias("k"), F.lit(1).alias("side"), _words(k + 1, F.size("words") - k).alias("part")),
        ),
    )
    parts = several.select("lang", "phrase", "words", "a", F.inline(F.flatten(cuts)))
    known = phrases.select(F.col("lang").alias("g"), F.col("phrase").alias("p"), "n")
    side = lambda i: F.max(F.when(F.col("side") == i, F.col("n")))
    scored = (
        parts.join(known, (F.col("lang") == F.col("g")) & (F.col("part") == F.col("p")))
        .groupBy("lang", "phrase", "words", "a", "k")
        .agg(side(0).alias("l"), side(1).alias("r"))
        .withColumns({"top": _exact(F.col("a")) * 2_000_000, "below": _exact(F.col("l")) + _exact(F.col("r"))})
        .withColumn("score", F.expr("top div below"))
    )
    best = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    return scored.groupBy("lang", "phrase", "words", "a").agg(best).select("lang", "phrase", "words", "a", "cut.*")


def not_covered(scored: DataFrame, covered: int = COVERED) -> DataFrame:
    """Phrases that no longer one takes ``covered`` hundredths of the occurrences from."""
    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.size("words") - 1),
            lambda k: F.transform(F.sequence(F.lit(1), F.size("words") - k + 1), lambda i: _words(i, k)),
        )
    )
    takers = (
        scored.filter(F.size("words") > 2)
        .select(F.col("lang").alias("g"), F.explode(inner).alias("p"), "a")
        .groupBy("g", "p")
        .agg(F.max("a").alias("taken"))
    )
    joined = scored.join(takers, (F.col("lang") == F.col("g")) & (F.col("phrase") == F.col("p")), "left")
    free = F.col("taken").isNull() | (_exact(F.col("taken")) * 100 < _exact(F.col("a")) * covered)
    return joined.filter(free).drop("g", "p", "taken")


def collocations(
    docs: DataFrame,
    min_count: int = MIN_COUNT,
    most_words: int = MOST_WORDS,
    covered: int = COVERED,
    most_ranks: int = MOST_RANKS,
    text: str = "text",
    lang: str = "lang",
    doc_id: str = "doc_id",
) -> DataFrame:
    """(lang, rank, phrase, a, k, l, r, n, score): the first phrases of each language.

    ``a`` is the count of the phrase, ``l`` and ``r`` those of its parts at the lowest cut, after ``k``
    words; ``n`` counts all words of the language.
    """
    phrases = frequent_phrases(docs, min_count, most_words, text, lang, doc_id)
    ranked = staged(not_covered(score_phrases(phrases), covered).drop("words"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    deals = max(1, ranked.count() // SORT_ROWS)
    dealt = ranked.withColumn("deal", F.pmod(F.xxhash64("phrase"), F.lit(deals)))
    first = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "deal").orderBy(*order)))
    few = first.filter(F.col("rank") <= most_ranks)
    last = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    totals = phrases.filter("phrase IS NULL").select(F.col("lang").alias("g"), F.col("n").alias("total"))
    return (
        last.filter(F.col("rank") <= most_ranks)
        .join(totals, F.col("lang") == F.col("g"))
        .select("lang", "rank", "phrase", "a", "k", "l", "r", F.col("total").alias("n"), "score")
    )
