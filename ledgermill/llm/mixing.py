"""Mixing sources to target weights by temperature, realised as budgeted block permutations.

A source with token share p gets weight p^a / sum(p^a). The exponent a lies between 0 (all sources
alike) and 1 (as they are) and is narrowed down until the weights meet a target entropy or a limit on
how often the most repeated source is read. Every evaluation is one aggregate over the table of
sources, for a whole section of exponents at once, so that any number of sources works.

A source's stream is pass after pass over its documents, each pass in its own permutation, cut at its
quota of tokens. A document's place in the stream, as a share of the quota, tells its block in the
mixture, so each block holds the sources in their weights. The prefix sums behind this are taken in
two levels, over about sqrt(n) buckets of sqrt(n) documents, so no source has to fit one task.

Edge cases: a NULL source is a source of its own; NULL or blank texts count no tokens and go along
with their source; a source without any token is read once, its rows
spread evenly over the blocks; repeated rows are mixed one by one; an
empty table gives an empty mixture; columns of any name are carried in one struct.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.llm.common import staged, words_of

SECTIONS = 64
ROUNDS = 5
BLOCK_TOKENS = 1_000_000


@dataclass
class Mixture:
    """What was decided: exponent, budget in tokens, entropy, and the per-source table."""

    exponent: float
    budget: float
    entropy: float
    repetition: float
    blocks: int
    sources: DataFrame  # source, n, tokens, weight, quota, passes, rest


def _measures(sources: DataFrame, exponents: list[float], budget: float | None) -> list[tuple]:
    """(exponent, z, entropy, budget, repetition) for each exponent, in one aggregate."""
    whole = sources.agg(F.sum("tokens").alias("t"), F.max("tokens").alias("most")).first()
    total, most = float(whole["t"]), float(whole["most"])
    points = F.explode(F.array(*[F.lit(a) for a in exponents])).alias("a")
    p = F.col("tokens") / F.lit(total)
    rows = (
        sources.select("tokens", points)
        .groupBy("a")
        .agg(
            F.sum(F.pow(p, F.col("a"))).alias("z"),
            F.sum(F.pow(p, F.col("a")) * F.log(p)).alias("s"),
            F.min("tokens").alias("least"),
        )
        .collect()
    )
    found = []
    for a, z, s, least in sorted(tuple(r) for r in rows):
        # By default the largest source is read exactly once, the others more often.
        b = budget if budget is not None else total * z * (most / total) ** (1 - a)
        found.append((a, z, max(0.0, -(a * s / z) + math.log(z)), b, b * (least / total) ** (a - 1) / z / total))
    return found


def decide(
    sources: DataFrame,
    budget: float | None = None,
    entropy: float | None = None,
    repetition: float | None = None,
    block_tokens: int = BLOCK_TOKENS,
) -> Mixture:
    """Exponent, weights and quotas for a table (source, n, tokens).

    Give ``entropy`` (in nats; reached as nearly as exponents between 0 and 1 allow) or
    ``repetition`` (the flattest weights under which no source is read more often; if even the plain
    shares break it, these). Without ``budget`` it is the least that reads every document.
    """
    if (entropy is None) == (repetition is None):
        raise ValueError("give either entropy or repetition")
    full = sources.filter("tokens > 0")
    if full.isEmpty():
        decided = sources.selectExpr(
            "source", "n", "tokens", "0D AS weight", "0D AS quota", "1L AS passes", "0D AS rest"
        )
        return Mixture(1.0, 0.0, 0.0, 1.0, 1, decided)

    low, high = 0.0, 1.0
    for _ in range(ROUNDS):
        grid = [low + (high - low) * i / SECTIONS for i in range(SECTIONS + 1)]
        found = _measures(full, grid, budget)
        if entropy is not None:  # falls with the exponent
            enough = [m[2] <= entropy + 1e-12 for m in found]
        else:
            enough = [m[4] <= repetition * (1 + 1e-12) for m in found]
        first = enough.index(True) if True in enough else SECTIONS
        low, high = found[max(0, first - 1)][0], found[first][0]
        if low == high:
            break
    exponent, z, reached, spent, most = _measures(full, [high], budget)[0]
    total = float(full.agg(F.sum("tokens")).first()[0])
    weight = F.when(
        F.col("tokens") > 0, F.pow(F.col("tokens") / F.lit(total), F.lit(exponent)) / F.lit(z)
    ).otherwise(F.lit(0.0))
    quota = F.col("weight") * F.lit(spent)
    # Rounding must not cost the last document of a source that is read a whole number of times.
    passes = F.when(F.col("tokens") > 0, F.floor(F.col("quota") / F.col("tokens") + 1e-9)).otherwise(1)
    rest = F.greatest(F.lit(0.0), F.col("quota") - F.col("passes") * F.col("tokens"))
    decided = (
        sources.withColumn("weight", weight)
        .withColumn("quota", quota)
        .withColumn("passes", passes.cast("long"))
        .withColumn("rest", F.when(rest > 1e-9 * F.col("quota"), rest).otherwise(0.0))
    )
    return Mixture(exponent, spent, reached, most, max(1, -int(-spent // block_tokens)), decided)


def mix(
    docs: DataFrame,
    source: str = "source",
    keep: str = "doc_id",
    tokens: Column | None = None,
    seed: int = 0,
    **target,
) -> tuple[DataFrame, Mixture]:
    """The mixture: one row per reading of a document, and what was decided.

    Columns: ``row`` (the kept column), source, tokens, pass, block, position (order in the block).
    ``tokens`` defaults to the words of the column ``text``.
    """
    if tokens is None:
        tokens = F.size(words_of(F.col("text")))
    counted = staged(
        docs.select(
            F.col(keep).alias("row"),
            F.col(source).cast("string").alias("source"),
            tokens.cast("long").alias("tokens"),
            F.monotonically_increasing_id().alias("rid"),
        )
    )
    sources = counted.groupBy("source").agg(
        F.count("*").alias("n"), F.sum("tokens").alias("tokens")
    )
    decided = decide(staged(sources), **target)
    plan = staged(
        decided.sources.select(F.col("source").alias("s"), "n", "tokens", "quota", "passes", "rest")
        .withColumnRenamed("tokens", "all_tokens")
    )

    # Each reading that may occur, with a random place in its pass.
    readings = (
        counted.join(plan, F.col("source").eqNullSafe(F.col("s")))
        .withColumn("last", F.col("passes") - F.when(F.col("rest") > 0, 0).otherwise(1))
        .filter("last >= 0")
        .withColumn("pass", F.explode(F.sequence(F.lit(0).cast("long"), F.col("last"))))
        .withColumn("h", F.xxhash64(F.lit(seed), "pass", "row"))
        .withColumn(
            "bucket", F.pmod(F.shiftrightunsigned("h", 8), F.ceil(F.sqrt("n")).cast("long"))
        )
    )
    key = ["source", "pass", "bucket"]
    inside = Window.partitionBy(*key).orderBy("h", "rid").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("source", "pass").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = (
        readings.groupBy(*key)
        .agg(F.sum("tokens").alias("sum"))
        .select(
            F.col("source").alias("s2"),
            F.col("pass").alias("p2"),
            F.col("bucket").alias("b2"),
            F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("before"),
        )
    )
    same = (
        F.col("source").eqNullSafe(F.col("s2"))
        & (F.col("pass") == F.col("p2"))
        & (F.col("bucket") == F.col("b2"))
    )
    placed = (
        readings.withColumn("inside", F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
        .join(starts, same)
        .withColumn("at", F.col("before") + F.col("inside"))
        .filter("pass < passes OR at < rest")
        # A source without tokens has no places; its rows are dealt over the blocks.
        .withColumn("dealt", F.pmod(F.xxhash64(F.lit(seed), "rid"), F.lit(1 << 30)) / F.lit(float(1 << 30)))
        .withColumn("share", F.coalesce((F.col("pass") * F.col("all_tokens") + F.col("at")) / F.nullif("quota", F.lit(0.0)), "dealt"))
        .withColumn(
            "block",
            F.least(F.floor(F.col("share") * decided.blocks), F.lit(decided.blocks - 1)).cast("long"),
        )
    )
    order = Window.partitionBy("block").orderBy(F.xxhash64(F.lit(seed), "h"), "rid")
    mixture = placed.select(
        "row", "rid", "source", "tokens", "pass", "block",
        (F.row_number().over(order) - 1).cast("long").alias("position"),
    )
    return mixture, decided


def repeat_documents(docs: DataFrame, source: str = "source", text: str = "text", **target) -> DataFrame:
    """The documents as often as the mixture reads them, with the columns they came with.

    Blocks and positions of the mixture do not pass on: the rows come in no order.
    """
    whole = staged(
        docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("key"))
    )
    narrow = whole.select("key", F.col(f"row.`{source}`").alias("source"), F.col(f"row.`{text}`").alias("text"))
    mixture, _ = mix(narrow, keep="key", **target)
    times = mixture.groupBy(F.col("row").alias("key")).agg(F.count("*").alias("times"))
    return (
        whole.join(times, "key")
        .select("row", F.explode(F.sequence(F.lit(1).cast("long"), "times")).alias("reading"))
        .select("row.*")
    )
