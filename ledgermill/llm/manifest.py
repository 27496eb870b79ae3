"""Merkle manifest of a dataset: digests of documents, of their sources, and one root.

Each document is a leaf, ranked within its source. A node carries the interval [lo, hi) of leaf ranks
that it covers and the digest of its children's digests, at most three. Sources are then the leaves of
one more tree, whose top is the root.

Levels are handled in bands of ``BAND``. The nodes of a band lie in blocks, the interval of leaf ranks
under one node of the band's top level. Leaves (or the tops of the band below) are dealt by block, so a
hot source is as many blocks as its size asks, and a task builds all nodes of its blocks. Ancestors are
attached from the top down, band by band, by the same buckets: in a block, the parent of a node is the
node of the next level whose interval contains its own, and its siblings are what the parent's interval
holds besides it, before and after. The path of a block's top continues that of its members.

Ranks come from one sort by range whose result is written; each written part tells how many leaves of
which source it holds, so no task sees a whole source.

Edge cases: a NULL field is hashed as ``-`` and an empty text as ``0:``, so they differ; NULL sources are one
source, before all others; NULL ids come first; rows of equal id go by their digest, and wholly equal rows
are leaves of their own; a lone leaf is its source's top, a lone source the root; an empty table has no
nodes and no root; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.llm.common import apply_arrow, cogroup_arrow, staged

# Children of a node, and the fields of a leaf in order.
FANOUT = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

BAND = 6
BLOCK = FANOUT**BAND
TASK_LEAVES = 4_096


def leaf_digest(values: list[Column]) -> Column:
    """SHA-256 of the values, each as its length in bytes, a colon and its text, or ``-`` for NULL."""
    told = [
        F.coalesce(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")), F.lit("-"))
        for v in values
    ]
    return F.sha2(F.concat(*told).cast("binary"), 256)


@dataclass
class Manifest:
    """``leaves`` (source, doc_id, grp, lo, hi, n, digest, given), ``nodes`` (grp, level, lo, hi, n, digest) of the
    sources' trees, ``sources`` (grp, source, n, lo, digest), ``source_nodes`` like ``nodes`` of the tree over
    the sources, and the ``root``. ``grp`` names a source."""

    leaves: DataFrame
    nodes: DataFrame
    sources: DataFrame
    source_nodes: DataFrame
    root: str | None
    n_leaves: int
    n_sources: int
    largest: int


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _width(level: int, n: int) -> int:
    """Nodes of a level over n leaves."""
    return -(-n // FANOUT**level)


def _height(n: int) -> int:
    """Levels above n leaves."""
    level = 0
    while _width(level, n) > 1:
        level += 1
    return level


def _unit(level: int, total: int) -> Column:
    """Number of the task's share that a node's block of the band above ``level`` falls in."""
    block = F.expr(f"lo div {FANOUT ** (level + BAND)}")
    return F.pmod(F.xxhash64("grp", block), F.lit(max(1, total // FANOUT**level // TASK_LEAVES)))


def _blocks(table: pa.Table, span: int):
    """(rows of one block in order of level and interval) for each block of the table."""
    grp, lo = table.column("grp").to_numpy(), table.column("lo").to_numpy()
    level = table.column("level").to_numpy()
    order = np.lexsort((lo, level, lo // span, grp))
    key = np.stack([grp[order], lo[order] // span])
    marks = np.flatnonzero(np.append(True, (key[:, 1:] != key[:, :-1]).any(axis=0))) if len(order) else []
    for a, b in zip(marks, [*marks[1:], len(order)]):
        yield order[a:b]


NODE = "grp long, level int, lo long, hi long, n long, digest string"


def _band(members: DataFrame, level: int, total: int) -> DataFrame:
    """The nodes above ``members`` (grp, lo, hi, n, digest), which are all nodes of ``level``, for one band."""
    span = FANOUT ** (level + BAND)

    def build(table: pa.Table) -> pa.Table:
        grp, lo, hi, n = (table.column(c).to_numpy() for c in ("grp", "lo", "hi", "n"))
        digest = table.column("digest").to_pylist()
        rows = []
        for block in _blocks(table, span):
            g, size = int(grp[block[0]]), int(n[block[0]])
            row = [(int(lo[i]), int(hi[i]), digest[i]) for i in block]
            for up in range(level + 1, level + BAND + 1):
                if _width(up - 1, size) == 1:
                    break
                runs = [row[i : i + FANOUT] for i in range(0, len(row), FANOUT)]
                row = [(run[0][0], run[-1][1], _hash("".join(d for _, _, d in run))) for run in runs]
                rows.extend((g, up, a, b, size, d) for a, b, d in row)
        columns = list(zip(*rows)) or [[]] * 6
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string())
        names = ["grp", "level", "lo", "hi", "n", "digest"]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    dealt = members.select(
        _unit(level, total).alias("unit"), "grp", F.lit(level).alias("level"), "lo", "hi", "n", "digest"
    )
    return staged(apply_arrow(dealt.groupBy("unit"), build, NODE))


def _tree(members: DataFrame, total: int, largest: int) -> DataFrame:
    """(grp, level, lo, hi, n, digest): all nodes above the leaves (grp, lo, hi, n, digest)."""
    nodes = below = _band(members, 0, total)
    level = BAND
    while _width(level, largest) > 1:
        open_tops = below.filter((F.col("level") == level) & (F.col("n") > FANOUT**level))
        below = _band(open_tops, level, total)
        nodes = nodes.unionByName(below)
        level += BAND
    return nodes


def _tops(leaves: DataFrame, nodes: DataFrame) -> DataFrame:
    """(grp, n, digest): the node of each group that covers all of it."""
    covers = (F.col("lo") == 0) & (F.col("hi") == F.col("n"))
    alone = leaves.filter(covers & (F.col("n") == 1))
    return alone.select("grp", "n", "digest").unionByName(nodes.filter(covers).select("grp", "n", "digest"))


def build(
    docs: DataFrame,
    fields: tuple[str, ...] = FIELDS,
    source: str = "source",
    doc_id: str = "doc_id",
    given: dict[str, Column] | None = None,
) -> Manifest:
    """The manifest of all documents.

    ``given`` names fields whose values, as presented for verification, are other than the stored ones;
    ``leaves`` then holds the digest of the row as given, for ``prove``.
    """
    leaf = leaf_digest([F.col(f) for f in fields])
    shown = leaf_digest([(given or {}).get(f, F.col(f)) for f in fields]) if given else F.lit(None).cast("string")
    hashed = staged(
        docs.select(F.col(source).alias("source"), F.col(doc_id).alias("doc_id"), leaf.alias("digest"), shown.alias("given"))
        .withColumn("tie", F.monotonically_increasing_id())
    )
    keys = ["source", "doc_id", "digest", "tie"]
    placed = staged(
        hashed.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("tie")
        .withColumn("at", F.monotonically_increasing_id())
        .withColumn("part", F.shiftright("at", 33))
    )
    # One row for each source in each written part.
    runs = placed.groupBy("part", "source").agg(F.min("at").alias("begin"), F.count("*").alias("rows"))
    whole = Window.partitionBy("source")
    before = F.sum("rows").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    runs = staged(
        runs.select(
            F.col("part").alias("p"),
            F.col("source").alias("s"),
            "begin",
            F.min("begin").over(whole).alias("grp"),
            F.coalesce(before, F.lit(0)).alias("before"),
            F.sum("rows").over(whole).alias("n"),
        )
    )
    leaves = (
        placed.join(runs, (F.col("part") == F.col("p")) & F.col("source").eqNullSafe(F.col("s")))
        .withColumn("lo", F.col("before") + F.col("at") - F.col("begin"))
        .select("source", "doc_id", "grp", "lo", (F.col("lo") + 1).alias("hi"), "n", "digest", "given")
    )
    heads = runs.filter("begin = grp").select("p", "grp", F.col("s").alias("source"), "n")
    sizes = heads.agg(F.count("*"), F.sum("n"), F.max("n")).first()
    n_sources, n_leaves, largest = sizes[0], sizes[1] or 0, sizes[2] or 0
    nodes = _tree(leaves, n_leaves, largest)

    # Sources in their order; one row for each written part is all that a single task sees.
    starts = heads.groupBy(F.col("p").alias("q")).agg(F.count("*").alias("heads")).withColumn(
        "earlier", F.sum("heads").over(Window.orderBy("q").rowsBetween(Window.unboundedPreceding, -1))
    )
    ranked = heads.join(starts, F.col("p") == F.col("q")).withColumn(
        "lo", F.coalesce("earlier", F.lit(0)) + F.row_number().over(Window.partitionBy("p").orderBy("grp")) - 1
    )
    tops = _tops(leaves, nodes).select(F.col("grp").alias("g"), "digest")
    sources = staged(ranked.join(tops, F.col("grp") == F.col("g")).select("grp", "source", "n", "lo", "digest"))
    over = _as_leaves(sources, n_sources)
    source_nodes = _tree(over, n_sources, n_sources)
    top = _tops(over, source_nodes).first()
    return Manifest(leaves, nodes, sources, source_nodes, top and top["digest"], n_leaves, n_sources, largest)


def _as_leaves(sources: DataFrame, n_sources: int) -> DataFrame:
    """The sources' tops as leaves of the tree over them."""
    return sources.select(
        F.lit(0).cast("long").alias("grp"),
        "lo",
        (F.col("lo") + 1).alias("hi"),
        F.lit(n_sources).cast("long").alias("n"),
        "digest",
    )


PATH = "array<struct<before:string,after:string>>"


def _siblings(table: pa.Table, block: np.ndarray):
    """For each member of the block (its least level): row, and its siblings level by level, up to the top.

    A node's parent is the node of the next level that contains its interval; the parent's interval less
    the node's own leaves what is before and after it.
    """
    level = table.column("level").to_numpy()[block]
    lo, hi = table.column("lo").to_numpy()[block], table.column("hi").to_numpy()[block]
    digest = table.column("digest").take(pa.array(block)).to_pylist()
    edges = [int(np.searchsorted(level, v)) for v in range(int(level[0]), int(level[-1]) + 2)]
    spans = list(zip(edges, edges[1:]))
    steps = []
    for (a, b), (c, d) in zip(spans, spans[1:]):
        parent = c + np.searchsorted(lo[c:d], lo[a:b], side="right") - 1
        first = a + np.searchsorted(lo[a:b], lo[parent])
        last = a + np.searchsorted(lo[a:b], hi[parent])
        steps.append(
            [
                ("".join(digest[p:i]), "".join(digest[i + 1 : q]))
                for i, p, q in zip(range(a, b), first.tolist(), last.tolist())
            ]
        )
    a, b = spans[0]
    ancestor = [np.searchsorted(lo[c:d], lo[a:b], side="right") - 1 for c, d in spans[:-1]]
    for i in range(a, b):
        yield block[i], [step[ancestor[s][i - a]] for s, step in enumerate(steps)]


def _attached(members: DataFrame, nodes: DataFrame, above: DataFrame, level: int, total: int, finish, schema: str):
    """``finish`` on each member of a band with its path to the root.

    ``members`` are the nodes of ``level``, with further columns; ``nodes`` those of the tree; ``above``
    (grp, lo, path) the paths of the band's tops, by the first leaf they cover.
    """
    span = FANOUT ** (level + BAND)
    inner = nodes.filter((F.col("level") > level) & (F.col("level") <= level + BAND))
    rows = members.withColumn("level", F.lit(level)).unionByName(inner, allowMissingColumns=True)
    dealt = rows.withColumn("unit", _unit(level, total))
    tops = above.withColumn("unit", _unit(level, total))

    def attach(table: pa.Table, paths: pa.Table) -> pa.Table:
        places = zip(paths.column("grp").to_pylist(), paths.column("lo").to_pylist())
        known = dict(zip(places, paths.column("path").to_pylist()))
        grp, lo = table.column("grp").to_numpy(), table.column("lo").to_numpy()
        taken, found = [], []
        for block in _blocks(table, span):
            first = block[0]
            rest = [(s["before"], s["after"]) for s in known[int(grp[first]), int(lo[first]) // span * span]]
            for row, path in _siblings(table, block):
                taken.append(row)
                found.append(path + rest)
        return finish(table.take(pa.array(taken, pa.int64())), found)

    return cogroup_arrow(dealt.groupBy("unit"), tops.groupBy("unit"), attach, schema)


PATHS = f"grp long, lo long, n long, path {PATH}"


def _as_paths(table: pa.Table, paths: list) -> pa.Table:
    told = [[{"before": b, "after": a} for b, a in path] for path in paths]
    kind = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))
    columns = [table.column(c) for c in ("grp", "lo", "n")]
    return pa.table([*columns, pa.array(told, kind)], ["grp", "lo", "n", "path"])


def _handed_down(
    leaves: DataFrame, nodes: DataFrame, above: DataFrame, total: int, largest: int, finish, schema: str
) -> DataFrame:
    """Paths (grp, lo, n, path) of whole groups handed down band by band, and ``finish`` on those of the leaves."""
    level = BAND * max(0, (_height(largest) - 1) // BAND)
    while level:
        climbing = F.col("n") > FANOUT**level  # other groups end in a band below
        members = nodes.filter((F.col("level") == level) & climbing).drop("level")
        inner = _attached(members, nodes, above.filter(climbing), level, total, _as_paths, PATHS)
        above = staged(inner.unionByName(above.filter(~climbing)))
        level -= BAND
    return _attached(leaves, nodes, above, 0, total, finish, schema)


def prove(manifest: Manifest, siblings: bool = False) -> DataFrame:
    """One row per leaf: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``proof_sha256`` digests the siblings from the leaf to the root; ``folded_root`` is what they and the
    row as given lead to. With ``siblings`` the proof itself is returned too, as an array of
    (before, after) by level.
    """
    over = _as_leaves(manifest.sources, manifest.n_sources)
    zero = F.lit(0).cast("long")
    top = over.sparkSession.range(1).select(
        zero.alias("grp"), zero.alias("lo"), F.lit(manifest.n_sources).cast("long").alias("n"), F.array().cast(PATH).alias("path")
    )
    by_rank = _handed_down(
        over, manifest.source_nodes, top, manifest.n_sources, manifest.n_sources, _as_paths, PATHS
    )
    named = manifest.sources.select(
        F.col("lo").alias("rank"), F.col("grp").alias("g"), F.col("n").alias("leaves"), F.col("digest").alias("subroot")
    )
    by_source = staged(
        by_rank.join(named, F.col("lo") == F.col("rank")).select(
            F.col("g").alias("grp"), zero.alias("lo"), F.col("leaves").alias("n"), "path", "subroot"
        )
    )
    kind = manifest.leaves.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "grp", "leaf", "proof_sha256", "folded_root"] + ["siblings"] * siblings

    def finish(table: pa.Table, paths: list) -> pa.Table:
        digest, given = table.column("digest").to_pylist(), table.column("given").to_pylist()
        proofs, folded = [], []
        for i, path in enumerate(paths):
            proofs.append(_hash("".join(b + a for b, a in path)))
            now = given[i] or digest[i]
            for b, a in path:
                now = _hash(b + now + a)
            folded.append(now)
        told = [table.column("doc_id"), table.column("grp"), digest, proofs, folded]
        if siblings:
            told.append(_as_paths(table, paths).column("path"))
        return pa.table(told, names)

    schema = f"doc_id {kind}, grp long, leaf string, proof_sha256 string, folded_root string"
    schema += f", siblings {PATH}" * siblings
    leaves = manifest.leaves.drop("source")
    proofs = _handed_down(
        leaves, manifest.nodes, by_source.drop("subroot"), manifest.n_leaves, manifest.largest, finish, schema
    )
    tops = by_source.select(F.col("grp").alias("g"), "subroot")
    return (
        proofs.join(tops, F.col("grp") == F.col("g"))
        .withColumn("root", F.lit(manifest.root).cast("string"))
        .withColumn("verified", F.col("folded_root") == F.col("root"))
        .select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", *names[5:])
    )
