"""Approximate nearest neighbours on robust-pruned directed graphs, one per shard.

Equal vectors become one node that keeps the least ids it stands for, which is all a top-k answer can
need, so a very common vector is a single node. Nodes are dealt to shards of bounded size by hash. In
each shard points are inserted in doubling batches: a greedy beam search proposes neighbours, relaxed
distance pruning keeps few but diverse edges, reverse edges are added and pruned alike. A query walks
the graph of every shard by beam search; answers are scored on the original vectors in double
precision and merged. Queries travel in blocks, so no task sees all of them.

Edge cases: vectors that are NULL, empty, zero, or hold NULL or non-finite components take no part, as
queries or candidates; vectors of different length never meet; equal rows count once; ties go to the
smaller id; a shard of few nodes is searched whole, so small tables give exact and complete answers;
an empty table gives no rows; other columns are not looked at. NULL ids take no part.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.llm.common import apply_arrow, staged

SHARD_NODES = 4096
QUERY_BLOCK = 20_000
DEGREE = 24
BUILD_BEAM = 48
SEARCH_BEAM = 192
ALPHA = 1.2
ENTRIES = 256  # fixed nodes where every walk starts; smaller shards start everywhere
BATCH = 256
EXPAND = 4


def _squared(x: np.ndarray, norms: np.ndarray, ids: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Squared distances of each query (rows of q) to its nodes (rows of ids), negative ids far away."""
    near = norms[ids] - 2 * np.einsum("amd,ad->am", x[ids], q) + (q * q).sum(1)[:, None]
    return np.where(ids >= 0, near, np.inf)


@dataclass
class Graph:
    """Nodes with at most DEGREE edges out, -1 where there is none."""

    x: np.ndarray
    edges: np.ndarray
    entries: np.ndarray

    @classmethod
    def build(cls, x: np.ndarray, alpha: float = ALPHA) -> Graph:
        n = len(x)
        order = np.random.default_rng(n).permutation(n)
        graph = cls(x, np.full((n, DEGREE), -1, np.int64), order[:ENTRIES])
        done = min(n, ENTRIES)
        if done > 1:  # the entries see each other
            for lo in range(0, done, BATCH):
                some = graph.entries[lo : lo + BATCH]
                graph._link(some, np.tile(graph.entries, (len(some), 1)), alpha)
        while done < n:
            some = order[done : done + min(BATCH, done)]
            found, _ = graph.search(x[some], BUILD_BEAM)
            graph._link(some, found, alpha)
            done += len(some)
        return graph

    def _prune(self, points: np.ndarray, proposed: np.ndarray, alpha: float) -> np.ndarray:
        """Diverse nearest neighbours: one is dropped if a chosen one is nearer to it by far."""
        norms = (self.x * self.x).sum(1)
        p = self.x[points]
        proposed = np.where(proposed == points[:, None], -1, proposed)
        proposed = np.sort(proposed, axis=1)
        proposed[:, 1:][proposed[:, 1:] == proposed[:, :-1]] = -1
        far = _squared(self.x, norms, proposed, p)
        order = np.argsort(far, axis=1)
        proposed, far = np.take_along_axis(proposed, order, 1), np.take_along_axis(far, order, 1)
        vectors, alive = self.x[proposed], np.isfinite(far)
        out = np.full((len(points), DEGREE), -1, np.int64)
        rows = np.arange(len(points))
        for slot in range(DEGREE):
            pick = alive.argmax(1)
            some = alive[rows, pick]
            if not some.any():
                break
            out[some, slot] = proposed[some, pick[some]]
            chosen = vectors[rows, pick]
            apart = norms[proposed] - 2 * np.einsum("amd,ad->am", vectors, chosen) + (chosen * chosen).sum(1)[:, None]
            alive &= ~(some[:, None] & (alpha * alpha * apart <= far))
            alive[rows, pick] = False
        return out

    def _link(self, points: np.ndarray, proposed: np.ndarray, alpha: float) -> None:
        self.edges[points] = self._prune(points, np.hstack([proposed, self.edges[points]]), alpha)
        # Reverse edges, gathered by their new start.
        ends = np.repeat(points, DEGREE)
        starts = self.edges[points].ravel()
        ends, starts = ends[starts >= 0], starts[starts >= 0]
        order = np.argsort(starts, kind="stable")
        starts, ends = starts[order], ends[order]
        nodes, first, count = np.unique(starts, return_index=True, return_counts=True)
        for lo in range(0, len(nodes), BATCH):
            some, width = nodes[lo : lo + BATCH], count[lo : lo + BATCH]
            at = np.arange(width.max())[None, :]
            new = np.where(at < width[:, None], ends[np.minimum(first[lo : lo + BATCH, None] + at, len(ends) - 1)], -1)
            self.edges[some] = self._prune(some, np.hstack([self.edges[some], new]), alpha)

    def search(self, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Nodes nearest first (-1 where there are no more) and squared distances, by beam search."""
        beam = max(beam, 1)
        n, m = len(self.x), len(q)
        norms = (self.x * self.x).sum(1)
        rows = np.arange(m)[:, None]
        ids = np.tile(self.entries, (m, 1))
        far = norms[ids] - 2 * q @ self.x[self.entries].T + (q * q).sum(1)[:, None]
        seen = np.zeros((m, n), bool)
        seen[:, self.entries] = True
        ids, far, open_ = self._best(ids, far, np.ones_like(ids, bool), beam)
        while open_.any():
            rank = np.where(open_, np.cumsum(open_, axis=1), EXPAND + 1)
            turn = rank <= EXPAND
            open_ &= ~turn
            picked = np.full((m, EXPAND), -1, np.int64)
            r, c = np.nonzero(turn)
            picked[r, rank[r, c] - 1] = ids[r, c]
            near = np.where(picked[:, :, None] >= 0, self.edges[picked], -1).reshape(m, -1)
            near = np.sort(near, axis=1)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
            near[(near >= 0) & seen[rows, near]] = -1
            r, c = np.nonzero(near >= 0)
            seen[r, near[r, c]] = True
            new = _squared(self.x, norms, near, q)
            ids, far, open_ = self._best(
                np.hstack([ids, near]), np.hstack([far, new]), np.hstack([open_, near >= 0]), beam
            )
        return ids, far

    @staticmethod
    def _best(ids, far, open_, beam):
        order = np.argsort(far, axis=1, kind="stable")[:, :beam]
        far = np.take_along_axis(far, order, 1)
        ids = np.where(np.isfinite(far), np.take_along_axis(ids, order, 1), -1)
        return ids, far, np.take_along_axis(open_, order, 1) & (ids >= 0)


def usable(vector: Column) -> Column:
    """Whether a vector takes part."""
    finite = F.forall(
        vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    )
    return F.coalesce(finite & F.exists(vector, lambda v: v != 0), F.lit(False))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    flat = flat.chunk(0) if isinstance(flat, pa.ChunkedArray) else flat
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


def nodes_of(vectors: DataFrame, least: int) -> DataFrame:
    """(v, ids): distinct vectors, each with the ``least`` smallest ids that it stands for."""
    first = Window.partitionBy("v").orderBy("id")
    return (
        vectors.dropDuplicates(["v", "id"])
        .withColumn("r", F.row_number().over(first))
        .filter(F.col("r") <= least)
        .groupBy("v")
        .agg(F.array_sort(F.collect_list("id")).alias("ids"))
    )


def build_index(vectors: DataFrame, k: int, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """(d, shard, shards, node, ids, v, edges), written: the graph of every shard of (id, v)."""
    nodes = staged(nodes_of(vectors, k + 1).withColumn("d", F.size("v")))
    sizes = nodes.groupBy(F.col("d").alias("e")).agg(
        F.ceil(F.count("*") / shard_nodes).cast("int").alias("shards")
    )
    dealt = nodes.join(sizes, F.col("d") == F.col("e")).select(
        "d", F.pmod(F.xxhash64("v"), "shards").cast("int").alias("shard"), "shards", "ids", "v"
    )

    def build(table: pa.Table) -> pa.Table:
        graph = Graph.build(_matrix(table.column("v")))
        entry = np.zeros(len(graph.x), bool)
        entry[graph.entries] = True
        return (
            table.append_column("node", pa.array(np.arange(len(graph.x), dtype=np.int32)))
            .append_column("edges", pa.array(list(graph.edges.astype(np.int32)), pa.list_(pa.int32())))
            .append_column("entry", pa.array(entry))
        )

    schema = "d int, shard int, shards int, ids array<long>, v array<double>, node int, edges array<int>, entry boolean"
    return staged(apply_arrow(dealt.groupBy("d", "shard"), build, schema))


def nearest(
    index: DataFrame, queries: DataFrame, k: int, beam: int = SEARCH_BEAM
) -> DataFrame:
    """(query_id, rank, vec_id, score) of each of the queries (id, v)."""
    queries = staged(queries.dropDuplicates(["id", "v"]))
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    spread = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    shards = index.select(F.col("d").alias("e"), F.col("shard").alias("s")).distinct()
    asked = queries.join(shards, F.size("v") == F.col("e")).select(
        F.col("e").alias("d"), F.col("s").alias("shard"), F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"), "id", "v"
    )

    def walk(graph: pa.Table, asked: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if len(graph) and len(asked):
            graph = graph.sort_by("node")
            x, q = _matrix(graph.column("v")), _matrix(asked.column("v"))
            edges = _matrix(graph.column("edges")).astype(np.int64)
            shard = Graph(x, edges, np.flatnonzero(graph.column("entry").to_numpy()))
            ids = graph.column("ids").to_pylist()
            own = asked.column("id").to_pylist()
            for lo in range(0, len(q), BATCH):
                found, _ = shard.search(q[lo : lo + BATCH], max(beam, 2 * k + 2))
                for i, nodes in enumerate(found, lo):
                    nodes = nodes[nodes >= 0]
                    score = np.sqrt(((x[nodes] - q[i]) ** 2).sum(1))
                    top = np.argsort(score, kind="stable")[: 2 * k + 2]
                    hits = [(float(score[j]), v) for j in top for v in ids[nodes[j]] if v != own[i]]
                    out += [(own[i], v, s) for s, v in sorted(hits)[:k]]
        columns = list(zip(*out)) if out else [[], [], []]
        kinds = (pa.int64(), pa.int64(), pa.float64())
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], ["query_id", "vec_id", "score"])

    keys = ["d", "shard", "block"]
    found = apply_arrow(
        spread.groupBy(*keys).cogroup(asked.groupBy(*keys)), walk, "query_id long, vec_id long, score double"
    )
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        found.dropDuplicates(["query_id", "vec_id"])
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


def search(
    table: DataFrame, is_query: Column, k: int = 10, vec_id: str = "vec_id", vector: str = "embedding",
    shard_nodes: int = SHARD_NODES,
) -> DataFrame:
    """Index all usable vectors and answer the rows that ``is_query`` marks, over column ``id``."""
    kept = table.select(
        F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")
    ).filter(F.col("id").isNotNull() & usable(F.col("v")))
    return nearest(build_index(kept, k, shard_nodes), kept.filter(is_query), k)
