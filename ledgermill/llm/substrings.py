"""Removal of lines and passages that occur before, with offsets into the original texts.

Units are lines, normalised to their words in lower case, and, since passages also recur in the middle
of lines, the segments of each line: cut where the hash of a word pair is the least for four words to
both sides, so the cuts inside a copied passage do not depend on what surrounds it. Digests of units
are grouped globally; the occurrence of the least (document id, place) stays. A line is removed when
it occurs before; segments when a run of neighbours that all occur before has enough words.

Only digests and places are shuffled, never texts. The grouping combines in each task first, and its
result is joined back on the digest, which adaptive execution splits where a line is very common.

Edge cases: NULL and empty texts have no units; of repeated rows the first keeps its text; a unit
repeated inside one document goes too, unless it overlaps the copy that stays; a line of fewer than
five words whose neighbours do not occur before with it stays; so does a text of fewer than five words;
an empty table gives no rows; other columns are not looked at. Texts are read whole, in slices of
bounded memory.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import map_arrow
from ledgermill.llm.textnum import Slice, code_points, mix, slices, span_hash

REACH = 4
MIN_SEGMENT = 4  # words; shorter segments carry no evidence alone
MIN_LINE = 5
MIN_RUN = 10
CHARS = 6  # characters that count as a word
# Part of a line; line of one segment; line of several; short unit with its neighbours.
SEGMENT, SHORT_LINE, LONG_LINE, WINDOW = 0, 1, 2, 3


def _windows(short: np.ndarray, words: np.ndarray, chars: np.ndarray, marks: np.ndarray):
    """Distinct (first unit, last unit + 1) of the least runs of enough length around each short unit.

    ``words`` and ``chars`` are sums before each unit, ``marks`` the units at which the texts begin. Where
    a run meets the end of its text it grows to the other side; a short text is one window.
    """
    owner = np.searchsorted(marks, short, side="right") - 1
    low, high = marks[owner], marks[owner + 1]

    def after(first):
        return np.minimum(
            np.searchsorted(words, words[first] + MIN_RUN), np.searchsorted(chars, chars[first] + CHARS * MIN_RUN)
        )

    def before(stop):
        return np.maximum(
            np.searchsorted(words, words[stop] - MIN_RUN, side="right"),
            np.searchsorted(chars, chars[stop] - CHARS * MIN_RUN, side="right"),
        ) - 1

    stop, first = after(short), before(short + 1)
    forward = np.where(stop <= high, short, np.maximum(before(high), low)), np.minimum(stop, high)
    backward = np.maximum(first, low), np.where(first >= low, short + 1, np.minimum(after(low), high))
    lo, hi = np.divmod(np.unique([a * len(words) + b for a, b in (forward, backward)]), len(words))
    enough = (words[hi] - words[lo] >= MIN_LINE) | (chars[hi] - chars[lo] >= CHARS * MIN_LINE)
    enough &= hi - lo > 1
    return lo[enough], hi[enough]


def _units(part: Slice) -> list[tuple[np.ndarray, ...]]:
    """For each text of the slice (kind, first word, last word + 1, digest, characters, unit, anchor), by place.

    ``unit`` numbers segments and lines of one segment in order, ``anchor`` those of at least MIN_SEGMENT
    words; short units bear the number of the anchor before them. Windows and lines of several segments
    are not numbered.
    """
    word, n = part.word, len(part.word)
    if not n:
        return [tuple(np.zeros(0, np.int64) for _ in range(7))] * len(part)
    breaks = np.zeros(len(part.raw) + 1, np.int64)
    np.cumsum(part.raw == 10, out=breaks[1:])
    line = breaks[part.start]
    opens = np.append(True, line[1:] != line[:-1])
    heads = part.first[:-1]
    opens[heads[heads < n]] = True
    number = np.cumsum(opens)
    pair = mix(word * np.uint64(0xD1342543DE82EF95) + np.append(np.uint64(0), word[:-1]))
    pair[opens] = np.uint64(2**64 - 1)
    cut = ~opens
    for off in range(1, REACH + 1):
        same = number[off:] == number[:-off]
        cut[off:] &= ~same | (pair[off:] < pair[:-off])
        cut[:-off] &= ~same | (pair[:-off] < pair[off:])
    begins = np.flatnonzero(opens | cut)
    ends = np.append(begins[1:], n)
    line_begins = np.flatnonzero(opens)
    line_ends = np.append(line_begins[1:], n)
    whole = opens[begins] & np.append(opens[begins[1:]], True)
    kinds = np.where(whole, SHORT_LINE, SEGMENT)
    several = ~np.isin(line_begins, begins[whole])
    letters = np.zeros(len(part.raw) + 1, np.int64)
    np.cumsum((part.raw & 0xC0) != 0x80, out=letters[1:])
    chars = np.zeros(n + 1, np.int64)
    np.cumsum(letters[part.end] - letters[part.start], out=chars[1:])

    size = ends - begins
    short = np.flatnonzero(size < np.where(whole, MIN_LINE, MIN_SEGMENT))
    edges = np.append(begins, n)
    firsts, stops = _windows(short, edges, chars[edges], np.searchsorted(begins, part.first))
    order = np.arange(len(begins))
    anchors = np.cumsum(size >= MIN_SEGMENT)
    begin = np.concatenate([begins, line_begins[several], begins[firsts]])
    end = np.concatenate([ends, line_ends[several], edges[stops]])
    others = np.repeat([LONG_LINE, WINDOW], [several.sum(), len(firsts)])
    kind = np.concatenate([kinds, others])
    unit = np.concatenate([order, np.zeros(len(others), np.int64)])
    anchor = np.concatenate([anchors, np.zeros(len(others), np.int64)])
    length = chars[end] - chars[begin]
    # A short unit goes by its windows; alone it is kept only where its characters are evidence enough.
    enough = (end - begin >= np.where(kind == LONG_LINE, MIN_LINE, MIN_SEGMENT)) | (length >= CHARS * MIN_SEGMENT)
    enough |= kind == WINDOW
    order = np.flatnonzero(enough)
    order = order[np.lexsort((kind[order], begin[order]))]
    begin, end = begin[order], end[order]
    found = kind[order], begin, end, span_hash(word, begin, end), length[order], unit[order], anchor[order]
    marks = np.searchsorted(begin, part.first)
    return [tuple(a[lo:hi] for a in found) for lo, hi in zip(marks, marks[1:])]


def text_units(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per unit: doc_id, rid (tells repeated rows apart), unit and anchor (order), kind, words, chars, start, end, digest."""
    narrow = docs.select(
        F.col(doc_id).alias("doc_id"), F.monotonically_increasing_id().alias("rid"), F.col(text).alias("text")
    )
    names = ["doc_id", "rid", "unit", "anchor", "kind", "words", "chars", "start", "end", "digest"]

    def task(batches):
        for batch in batches:
            for part in slices(batch.column("text")):
                rows, cells = [], [[] for _ in range(8)]
                for j, (kind, begin, end, digest, chars, unit, anchor) in enumerate(_units(part)):
                    if not len(kind):
                        continue
                    starts, stops = part.start[begin], part.end[end - 1]
                    places = code_points(part, np.concatenate([starts, stops]), j)
                    begins, ends = places[: len(kind)], places[len(kind) :]
                    found = (unit, anchor, kind, end - begin, chars, begins, ends, digest.view(np.int64))
                    for column, cell in zip(cells, found):
                        column.append(cell)
                    rows.append(np.full(len(kind), part.at + j))
                if rows:
                    take = pa.array(np.concatenate(rows))
                    columns = [batch.column("doc_id").take(take), batch.column("rid").take(take)]
                    kinds = [pa.int32()] * 7 + [pa.int64()]
                    columns += [pa.array(np.concatenate(c)).cast(t) for c, t in zip(cells, kinds)]
                    yield pa.RecordBatch.from_arrays(columns, names)

    kind = narrow.schema["doc_id"].dataType.simpleString()
    return map_arrow(
        narrow,
        task,
        f"doc_id {kind}, rid long, unit int, anchor int, kind int, words int, chars int, start int, end int, digest long",
    )


def _spans(units: list[dict]) -> list[tuple[int, int, int]]:
    """(start, end, place in the list of the unit that names the keeper) to remove from one text."""
    spans, run, words, chars, last, anchor = [], [], 0, 0, None, None

    def close():
        if words >= MIN_RUN or chars >= CHARS * MIN_RUN:
            spans.extend((u["start"], u["end"], i) for i, u in run)

    for i, u in enumerate(units):
        whole = u["kind"] in (SHORT_LINE, LONG_LINE)
        if u["kind"] == WINDOW or whole and (u["words"] >= MIN_LINE or u["chars"] >= CHARS * MIN_LINE):
            spans.append((u["start"], u["end"], i))
        if u["kind"] in (LONG_LINE, WINDOW):
            continue
        anchored = u["words"] >= MIN_SEGMENT
        # Anchors are neighbours whatever short units lie between them.
        if run and u["unit"] != last + 1 and not (anchored and anchor is not None and u["anchor"] == anchor + 1):
            close()
            run, words, chars, anchor = [], 0, 0, None
        run.append((i, u))
        words, chars, last = words + u["words"], chars + u["chars"], u["unit"]
        anchor = u["anchor"] if anchored else anchor
    close()
    return sorted(spans)


def removed_spans(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, rid, start, end (code points of the original text), kept_doc_id, one row per removed span.

    Neighbouring removals are one span, named after the document that keeps its first unit.
    """
    units = text_units(docs, text, doc_id)
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "rid", "start", F.col("kind").alias("k"), "end")
    firsts = (
        units.groupBy(F.col("digest").alias("g"))
        .agg(F.min(place).alias("first"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("g", "first.doc_id", "first.rid", "first.end")
        .toDF("g", "kept", "kept_rid", "kept_end")
    )
    again = units.join(firsts, F.col("digest") == F.col("g")).filter(
        (F.col("rid") != F.col("kept_rid")) | (F.col("start") >= F.col("kept_end"))
    )
    listed = again.groupBy("doc_id", "rid").agg(
        F.array_sort(F.collect_list(F.struct("start", "end", "unit", "anchor", "kind", "words", "chars", "kept"))).alias("units")
    )

    def task(batches):
        for batch in batches:
            take, start, end, kept = [], [], [], []
            for i, units in enumerate(batch.column("units").to_pylist()):
                units.sort(key=lambda u: (u["start"], u["kind"]))
                edge = -1
                for lo, hi, j in _spans(units):
                    if edge >= 0 and lo <= edge + 1:
                        end[-1] = max(end[-1], hi)
                    else:
                        take.append(i)
                        start.append(lo)
                        end.append(hi)
                        kept.append(units[j]["kept"])
                    edge = end[-1]
            rows = pa.array(take, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(rows), batch.column("rid").take(rows), pa.array(start, pa.int32()),
                 pa.array(end, pa.int32()), pa.array(kept, batch.schema.field("doc_id").type)],
                ["doc_id", "rid", "start", "end", "kept_doc_id"],
            )

    kind = listed.schema["doc_id"].dataType.simpleString()
    return map_arrow(listed, task, f"doc_id {kind}, rid long, start int, end int, kept_doc_id {kind}")


def cut_spans(docs: DataFrame, spans: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The documents with their spans cut out of the text; other columns as they came.

    Ids must be unique here. What is between two spans stays, line breaks included.
    """
    listed = spans.groupBy(F.col("doc_id").alias("span_id")).agg(
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias("cuts")
    )
    rows = docs.select(F.struct("*").alias("row"))
    joined = rows.join(listed, F.col(f"row.`{doc_id}`") == F.col("span_id"), "left")
    whole = F.col(f"row.`{text}`")
    begin = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    kept = F.aggregate(
        "cuts",
        begin,
        lambda acc, s: F.struct(
            F.concat(acc["out"], F.substring(whole, acc["at"] + 1, s["start"] - acc["at"])).alias("out"),
            s["end"].alias("at"),
        ),
        lambda acc: F.concat(acc["out"], F.substring(whole, acc["at"] + 1, F.length(whole))),
    )
    cut = F.when(F.col("cuts").isNull(), whole).otherwise(kept)
    return joined.select(*[(cut if c == text else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
