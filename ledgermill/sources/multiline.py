"""CSV records with line breaks inside quotes, read by many tasks a file.

Whether a line begins inside a quoted field depends on all lines before it, but each line only maps
two states (outside, inside) to two. So the lines of a file split are run from both states at once; what
that does to a state is one small row for each split. Those rows, in the order of their splits, tell
the state in which every split begins. A second pass then cuts the lines of each split into whole records,
with no shuffle of the text. A record that crosses into another split leaves its parts, at most one at
either end of a split, and these are put together.

Records end in ``\\n`` or ``\\r\\n``; inside quotes both stay as they are. A quote counts only where a field
begins with it. A quoted field that is never closed reaches to the end of its file. Files that cannot be
split (compressed as a whole) are one task each.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgermill.session import ship_package

# A join side of at most so many rows, counted first, is broadcast.
BROADCAST_ROWS = 100_000

# Where the next character stands: in an empty field, in one that has begun without a quote, inside
# quotes, after a quote that closes or is the first of a doubled one.
EMPTY, BEGUN, QUOTED, CLOSING = range(4)
AFTER_QUOTE = {EMPTY: QUOTED, BEGUN: BEGUN, QUOTED: CLOSING, CLOSING: QUOTED}

# What a split holds of a record: all, its end, its beginning, or a middle without either.
WHOLE, END, BEGINNING, MIDDLE = range(4)


def ends_inside(line: str, inside: bool) -> bool:
    """Whether the break after ``line`` lies inside quotes, given whether its beginning does."""
    place = QUOTED if inside else EMPTY
    for i, text in enumerate(line.split('"')):
        if i:
            place = AFTER_QUOTE[place]
        if text and place != QUOTED:
            place = EMPTY if text.endswith(",") else BEGUN
    return place == QUOTED


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, line): each line with the split that it begins in, in order within a split."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("value").alias("line"),
    )


def _runs(batch: pa.RecordBatch):
    """(file, start, rows) for each run of lines of one split."""
    file, start = batch.column("file").to_pylist(), batch.column("start").to_pylist()
    at = 0
    for i in range(1, batch.num_rows + 1):
        if i == batch.num_rows or (file[i], start[i]) != (file[at], start[at]):
            yield file[at], start[at], range(at, i)
            at = i


def _split_effects(batches):
    """For each split the state after it, begun outside and begun inside."""
    now, ends = None, [False, True]

    def told():
        columns = [[now[0]], [now[1]], [ends[0]], [ends[1]]]
        return pa.RecordBatch.from_arrays(
            [pa.array(c) for c in columns], ["file", "start", "from_outside", "from_inside"]
        )

    for batch in batches:
        quoted = pc.match_substring(batch.column("line"), '"').to_pylist()
        for file, start, rows in _runs(batch):
            if now != (file, start):
                if now:
                    yield told()
                now, ends = (file, start), [False, True]
            for i in rows:
                if quoted[i]:
                    line = batch.column("line")[i].as_py()
                    ends = [ends_inside(line, inside) for inside in ends]
    if now:
        yield told()


def _cut(batches):
    """Records, and parts of records at either end of a split, from lines with the state of their split."""
    now, parts, inside, headed, kind = None, [], False, False, WHOLE

    def took(rows, part_of, text, first):
        rows.append((*now, part_of, text, first))

    def batch_of(rows):
        kinds = (pa.string(), pa.int64(), pa.int32(), pa.string(), pa.bool_())
        columns = list(zip(*rows)) or [[]] * 5
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], ["file", "start", "part", "text", "first"]
        )

    def left_over(rows):
        if now and parts:
            took(rows, MIDDLE if kind == END else BEGINNING, "\n".join(parts), not headed)

    for batch in batches:
        rows = []
        lines, begins_inside = batch.column("line").to_pylist(), batch.column("inside").to_pylist()
        for file, start, places in _runs(batch):
            if now != (file, start):
                left_over(rows)
                now, parts = (file, start), []
                inside = bool(begins_inside[places[0]])
                kind = END if inside else WHOLE
                headed = start > 0
                if start == 0:
                    lines[places[0]] = lines[places[0]].removeprefix("﻿")
            for i in places:
                line = lines[i]
                parts.append(line)
                if '"' in line:
                    inside = ends_inside(line, inside)
                if not inside:
                    text = parts[0] if len(parts) == 1 else "\n".join(parts)
                    if kind == END or text.removesuffix("\r"):
                        took(rows, kind, text, kind == WHOLE and not headed)
                        headed = headed or kind == WHOLE
                    parts, kind = [], WHOLE
        yield batch_of(rows)
    rows = []
    left_over(rows)
    yield batch_of(rows)


def _beginning_inside(effects: DataFrame) -> DataFrame:
    """(f, s): the splits that begin inside quotes.

    The last split whose end is the same from either state settles what was before it; since then each
    split has either kept or turned the state.
    """
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    settles = F.col("from_outside") == F.col("from_inside")
    turns = F.when(~settles & F.col("from_outside"), 1).otherwise(0)
    marked = effects.withColumns({"turned": F.coalesce(F.sum(turns).over(before), F.lit(0)), "turn": turns})
    settled = F.last(F.when(settles, F.struct(F.col("from_outside"), F.col("turned"))), ignorenulls=True)
    known = marked.withColumn("known", settled.over(before))
    since = F.col("turned") - F.coalesce("known.turned", F.lit(0))
    odd = since % 2 == 1
    return known.filter(F.coalesce("known.from_outside", F.lit(False)) != odd).select(
        F.col("file").alias("f"), F.col("start").alias("s")
    )


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, text, first): every record's text, without its last line break; ``first`` marks a file's first one."""
    ship_package(spark)
    lines = _lines(spark, path)
    effects = lines.mapInArrow(
        _split_effects, "file string, start long, from_outside boolean, from_inside boolean"
    )
    inner = _beginning_inside(effects)
    few = inner.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    inner = inner.withColumn("inside", F.lit(True))
    marked = lines.join(
        F.broadcast(inner) if few else inner, (F.col("file") == F.col("f")) & (F.col("start") == F.col("s")), "left"
    )
    cut = marked.select("file", "start", "line", "inside").mapInArrow(
        _cut, "file string, start long, part int, text string, first boolean"
    )
    # A record that several splits share: its beginning, the splits all inside it, its end.
    order = Window.partitionBy("file").orderBy("start", "place")
    shared = (
        cut.filter(F.col("part") != WHOLE)
        .withColumn("place", (F.col("part") == BEGINNING).cast("int"))
        .withColumn("number", F.sum("place").over(order))
        .groupBy("file", "number")
        .agg(F.array_sort(F.collect_list(F.struct("start", "place", "text"))).alias("parts"), F.max("first").alias("first"))
        .select("file", F.array_join("parts.text", "\n").alias("text"), "first")
    )
    whole = cut.filter(F.col("part") == WHOLE).select("file", "text", "first")
    records = whole.unionByName(shared)
    return records.withColumn("text", F.regexp_replace("text", "\r$", ""))
