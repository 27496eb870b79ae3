"""Quality rules as a bitmask ledger: every rule once, policies and ablations on the bits.

``rule_ledger`` computes each measurement and one failure bit per rule in a single pass without a
shuffle. A policy is a version name and a mask of the bits that reject a document, so a changed
policy or a leave-one-out study never reads a text again.

Edge cases: a NULL or blank text has zero words, fails ``too_few_words`` and nothing else; repeated
rows and rows with equal ids are judged one by one; an empty table gives an empty ledger; other
columns are not looked at. The work per text is linear but for one sort of the windows of texts
that do repeat a window.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import SPACE, let, words_of

WINDOW = 8
MIN_WORDS = 20

# Bit by bit: when the rule fails, over the measurements.
RULES: dict[str, Callable[[Column], Column]] = {
    "too_few_words": lambda m: m["n_words"] < MIN_WORDS,
    "repeated_windows": lambda m: 100 * m["n_repeat_words"] > 30 * m["n_words"],
    "symbols": lambda m: 10 * m["n_symbols"] > m["n_words"],
    "duplicate_lines": lambda m: (m["n_lines"] >= 5) & (2 * m["n_dup_lines"] > m["n_lines"]),
    "stuttering": lambda m: 10 * m["n_stutters"] > 3 * m["n_words"],
    "shouting": lambda m: (m["n_words"] > 0) & (2 * m["n_upper"] > m["word_chars"]),
    "exclamations": lambda m: 2 * m["n_exclamations"] > m["n_words"],
    "word_length": lambda m: (m["n_words"] > 0)
    & ((m["word_chars"] < 2 * m["n_words"]) | (m["word_chars"] > 15 * m["n_words"])),
}
BITS = {name: 1 << i for i, name in enumerate(RULES)}
# Versions are only ever added, so that a stored verdict can be named by its version.
POLICIES: dict[str, int] = {
    "base": BITS["too_few_words"] | BITS["repeated_windows"],
    "v1": sum(BITS.values()),
}
MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_lines",
    "n_dup_lines",
    "n_repeat_words",
    "n_stutters",
    "n_upper",
    "n_exclamations",
)


def _repeat_words(hashes: Column) -> Column:
    """Words covered by windows whose hash occurs twice or more, from the hashes by position."""

    def covered(s: Column) -> Column:
        twins = F.filter(
            s,
            lambda x, j: F.coalesce(F.get(s, j - 1)["h"] == x["h"], F.lit(False))
            | F.coalesce(F.get(s, j + 1)["h"] == x["h"], F.lit(False)),
        )
        starts = F.array_sort(F.transform(twins, lambda x: x["i"]))
        zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
        return F.aggregate(
            starts,
            zero,
            lambda acc, x: F.struct(
                (acc["n"] + x + WINDOW - F.greatest(acc["end"], x)).alias("n"),
                (x + WINDOW).alias("end"),
            ),
        )["n"]

    placed = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    return let(F.array_sort(placed), covered)


def _hashes(w: Column) -> Column:
    """Hash of the window that starts at each word, where there is a whole one."""
    return F.when(
        F.size(w) >= WINDOW,
        F.transform(
            F.sequence(F.lit(1), F.size(w) - (WINDOW - 1)),
            lambda i: F.xxhash64(F.slice(w, i, WINDOW)),
        ),
    ).otherwise(F.array().cast("array<bigint>"))


def ledger_of(text: Column) -> Column:
    """Struct of all measurements and ``failed_rules``, as one expression.

    Each part is bound once. Written as columns instead, a filter on the result would be pushed below
    them, which copies their definitions into each other and computes the words anew for each word.
    """

    def measured(t: Column, w: Column, lines: Column, h: Column) -> Column:
        repeats = F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(_repeat_words(h))
        stutters = F.filter(w, lambda x, i: F.coalesce(F.get(w, i - 1) == x, F.lit(False)))
        values = {
            "n_words": F.size(w),
            "word_chars": F.length(F.array_join(w, "")),
            "n_symbols": F.regexp_count(t, F.lit(r"[#*$%&|<>]")),
            "n_lines": F.size(lines),
            "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
            "n_repeat_words": repeats,
            "n_stutters": F.size(stutters),
            "n_upper": F.regexp_count(t, F.lit(r"\p{Lu}")),
            "n_exclamations": F.regexp_count(t, F.lit("!")),
        }
        return F.struct(*[values[m].cast("long").alias(m) for m in MEASURES])

    def judged(m: Column) -> Column:
        bits = [F.when(fails(m), BITS[name]).otherwise(0) for name, fails in RULES.items()]
        failed = reduce(lambda x, y: x.bitwiseOR(y), bits).cast("long").alias("failed_rules")
        return F.struct(*[m[name].alias(name) for name in MEASURES], failed)

    def lines_of(t: Column) -> Column:
        return F.filter(F.split(t, "\n", -1), lambda x: x.rlike(f"[^{SPACE}]"))

    return let(
        F.coalesce(text, F.lit("")),
        lambda t: let(
            words_of(t),
            lambda w: let(
                lines_of(t),
                lambda ls: let(_hashes(w), lambda h: let(measured(t, w, ls, h), judged)),
            ),
        ),
    )


def rule_ledger(docs: DataFrame, text: str = "text", keep: str = "doc_id") -> DataFrame:
    """The kept column, every measurement (long), and the bits of the rules that a document fails."""
    judged = docs.select(F.col(keep).alias("kept_column"), ledger_of(F.col(text)).alias("ledger"))
    return judged.select(F.col("kept_column").alias(keep), "ledger.*")


def passes(version: str, failed: Column | None = None) -> Column:
    """Whether a document passes the policy of that version."""
    failed = F.col("failed_rules") if failed is None else failed
    return failed.bitwiseAND(F.lit(POLICIES[version]).cast("long")) == 0


def ablation(ledger: DataFrame, policies: Mapping[str, int] = POLICIES) -> DataFrame:
    """For each policy and each of its rules: documents, rejects, rejects by this rule alone.

    The ledger is first counted by its bits, at most 2^rules rows whatever its size; the rest works
    on those counts. ``rejected_without`` is what the policy would reject if the rule were dropped.
    """
    counts = ledger.groupBy("failed_rules").agg(F.count("*").alias("n"))
    pairs = F.array(
        *[
            F.struct(F.lit(p).alias("policy"), F.lit(mask).cast("long").alias("mask"),
                     F.lit(rule).alias("rule"), F.lit(bit).cast("long").alias("bit"))
            for p, mask in policies.items()
            for rule, bit in BITS.items()
            if mask & bit
        ]
    )
    failed = F.col("failed_rules").bitwiseAND(F.col("p.mask"))
    hit = F.col("failed_rules").bitwiseAND(F.col("p.bit")) != 0
    alone = failed == F.col("p.bit")
    return (
        counts.select("failed_rules", "n", F.explode(pairs).alias("p"))
        .groupBy(F.col("p.policy").alias("policy"), F.col("p.rule").alias("rule"))
        .agg(
            F.sum("n").alias("documents"),
            F.sum(F.when(failed != 0, F.col("n")).otherwise(0)).alias("rejected"),
            F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("failed_rule"),
            F.sum(F.when(alone, F.col("n")).otherwise(0)).alias("rejected_by_it_alone"),
            F.sum(F.when((failed != 0) & ~alone, F.col("n")).otherwise(0)).alias(
                "rejected_without"
            ),
        )
    )


def apply_rules(docs: DataFrame, version: str = "v1", text: str = "text") -> DataFrame:
    """The documents that pass a policy, with the columns they came with."""
    return docs.filter(passes(version, ledger_of(F.col(text))["failed_rules"]))
