"""Best-fit packing of tokenised documents into sequences of a fixed capacity.

Sizes are whole numbers up to the capacity, so the histogram of sizes, at most ``capacity`` rows
whatever the corpus, decides the packing. ``plan`` works on it: large items (above a third of the
capacity) are matched greedily, at most two a bin, then small ones fill the tightest gaps. All bins
of one content are one entry with a count. Each piece then finds its place from its rank among the
pieces of its size, which two levels of counting give without a global sort or a group in one task.

Edge cases: NULL and empty texts are one piece holding just the end id; repeated rows and ids are
packed as separate documents; an empty table gives no rows; other columns are not looked at. A text
of any length is encoded whole and cut into full pieces after a shorter first one.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.llm.common import map_arrow, row_schema, small_batches, staged
from ledgermill.llm.tokens import encoder

CAPACITY = 1024
END_ID = 2
# Pieces of one size are ranked in buckets of about this many at most, were all of one size.
BUCKET_PIECES = 20_000
LEAST_BUCKETS = 64

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


def tokenizer_files() -> dict[str, str]:
    """The default vocabulary, from the installed package of public tokenizers."""
    import public_tokenizers

    return {
        "tokenizer_file": public_tokenizers.path("byte_bpe_50k.json"),
        "ranks_file": public_tokenizers.path("byte_bpe_50k.tiktoken"),
        "pattern": public_tokenizers.PATTERN,
    }


def token_pieces(
    docs: DataFrame,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    keep_ids: bool = False,
    files: dict[str, str] | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Pieces of every document, with the ids themselves where ``keep_ids`` is set."""
    end = np.array([end_id], dtype="<u4").tobytes()
    full = 4 * capacity

    def cut(batches):
        encode = encoder(**(files or tokenizer_files())).packed
        for batch in small_batches(batches):
            rows = [[] for _ in range(6)]
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encode(value or "") + end
                at, stop = 0, len(ids) % full or full
                for piece in range(-(-len(ids) // full)):
                    part = ids[at:stop]
                    cells = (key, piece, at // 4, len(part) // 4, zlib.crc32(part), part)
                    for column, cell in zip(rows, cells):
                        column.append(cell)
                    at, stop = stop, stop + full
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            columns = [pa.array(c, k) for c, k in zip(rows, kinds)]
            if keep_ids:
                names.append("ids")
                lists = [np.frombuffer(part, "<u4").astype("<i4") for part in rows[5]]
                columns.append(pa.array(lists, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = PIECE_SCHEMA + (", ids array<int>" if keep_ids else "")
    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return map_arrow(narrow, cut, schema)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """Bins as (how many, {size: times in each}) for a histogram of sizes.

    Work and length of the result depend on the capacity, not on the counts.
    """
    left = {s: n for s, n in counts.items() if n > 0}
    if any(not 0 < s <= capacity for s in left):
        raise ValueError("sizes must lie between 1 and the capacity")
    bins: dict[int, list[tuple[int, dict[int, int]]]] = defaultdict(list)  # by the gap left
    large = sorted((s for s in left if 3 * s > capacity), reverse=True)
    for s in large:
        while left[s]:
            mate = next((y for y in large if y <= capacity - s and y <= s and left[y]), None)
            if mate is None:
                bins[capacity - s].append((left[s], {s: 1}))
                left[s] = 0
            elif mate == s and left[s] == 1:
                mate = next((y for y in large if y < s and y <= capacity - s and left[y]), None)
                bins[capacity - s - (mate or 0)].append((1, {s: 1} | ({mate: 1} if mate else {})))
                left[s] = 0
                if mate:
                    left[mate] -= 1
            else:
                n = left[s] // 2 if mate == s else min(left[s], left[mate])
                bins[capacity - s - mate].append((n, {s: 2} if mate == s else {s: 1, mate: 1}))
                left[s] -= 2 * n if mate == s else n
                if mate != s:
                    left[mate] -= n
    for s in sorted((s for s in left if 3 * s <= capacity), reverse=True):
        while left[s]:
            gap = min((g for g, held in bins.items() if g >= s and held), default=None)
            if gap is None:
                gap, (have, content) = capacity, (-(-left[s] // (capacity // s)), {})
            else:
                have, content = bins[gap].pop()
            each = min(gap // s, left[s])
            n = min(have, left[s] // each)
            if have > n and content:
                bins[gap].append((have - n, content))
            bins[gap - each * s].append((n, content | {s: each}))
            left[s] -= n * each
    return [entry for held in bins.values() for entry in held]


def _places(bins: list[tuple[int, dict[int, int]]]) -> dict[int, np.ndarray]:
    """For each size rows (first rank, times a bin, first bin, offset in the bin), by rank."""
    places, used, first = defaultdict(list), defaultdict(int), 0
    for n, content in bins:
        offset = 0
        for size in sorted(content, reverse=True):
            places[size].append((used[size], content[size], first, offset))
            used[size] += n * content[size]
            offset += size * content[size]
        first += n
    return {size: np.array(rows, dtype=np.int64) for size, rows in places.items()}


def pack(pieces: DataFrame, capacity: int = CAPACITY, length: str = "length") -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; their columns stay as they are.

    ``pieces`` is written to the scratch folder first: it is read once for the histogram and once
    for the placing, and tokenising is what costs.
    """
    kept = staged(pieces.select(F.struct("*").alias("row"), F.col(length).alias("size")))
    total = kept.count()
    buckets = max(LEAST_BUCKETS, -(-total // BUCKET_PIECES))
    keyed = kept.withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)))
    counted = keyed.groupBy("size", "bucket").agg(F.count("*").alias("n"))
    sizes = counted.groupBy("size").agg(F.sum("n").alias("n")).collect()
    histogram = {row["size"]: row["n"] for row in sizes}
    places = _places(plan(histogram, capacity))

    before = Window.partitionBy("size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counted.select(
        "size", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")
    )
    inside = Window.partitionBy("size", "bucket").orderBy(F.xxhash64("row", F.lit(1)))
    ranked = (
        keyed.withColumn("at", F.row_number().over(inside))
        .join(starts, ["size", "bucket"])
        .select("row", "size", (F.col("before") + F.col("at") - 1).alias("rank"))
    )

    def place(batches):
        for batch in batches:
            size = batch.column("size").to_numpy(zero_copy_only=False)
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            sequence, offset = np.empty_like(rank), np.empty_like(rank)
            for s in np.unique(size):
                mine = np.flatnonzero(size == s)
                table = places[int(s)]
                row = table[np.searchsorted(table[:, 0], rank[mine], side="right") - 1]
                step = rank[mine] - row[:, 0]
                sequence[mine] = row[:, 2] + step // row[:, 1]
                offset[mine] = row[:, 3] + step % row[:, 1] * s
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(sequence), pa.array(offset)],
                ["row", "sequence_id", "offset"],
            )

    placed = map_arrow(
        ranked, place, row_schema(ranked.schema["row"], "sequence_id long, offset long")
    )
    return placed.select("row.*", "sequence_id", "offset")


def pack_documents(docs: DataFrame, keep_ids: bool = False, **options) -> DataFrame:
    """Tokenise, cut and pack; one row per piece, with its ids where ``keep_ids`` is set."""
    capacity = options.get("capacity", CAPACITY)
    return pack(token_pieces(docs, keep_ids=keep_ids, **options), capacity)
