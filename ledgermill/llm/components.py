"""Connected components of an undirected graph, with every step on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import staged

MOST_ROUNDS = 60


def connected_components(edges: DataFrame) -> DataFrame:
    """(v, component) for every vertex of ``edges`` (a, b); the component is its smallest vertex.

    Each round takes the least label among the neighbours and then the label of that label, so paths
    shrink by half. Labels are written once a round, which cuts the lineage.
    """
    both = staged(
        edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        .filter("a <> b")
        .distinct()
    )
    labels = staged(both.groupBy(F.col("a").alias("v")).agg(F.least(F.col("v"), F.min("b")).alias("l")))
    for _ in range(MOST_ROUNDS):
        near = (
            both.join(labels, F.col("b") == F.col("v"))
            .groupBy("a")
            .agg(F.min("l").alias("near"))
        )
        jump = labels.select(F.col("v").alias("j"), F.col("l").alias("far"))
        stepped = (
            labels.join(near, F.col("v") == F.col("a"))
            .withColumn("m", F.least("l", "near"))
            .join(jump, F.col("m") == F.col("j"))
            .select("v", F.least("m", "far").alias("l"), (F.least("m", "far") < F.col("l")).alias("moved"))
        )
        written = staged(stepped)
        labels = written.select("v", "l")
        if written.filter("moved").isEmpty():
            return labels.withColumnRenamed("l", "component")
    raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
