"""URL filter: host and path rules first, a character language-model ratio for the rest.

URLs that a rule allows or blocks train two smoothed variable-order Markov models over the characters
of host and path: P_k(c | last k) = (N(last k, c) + B * P_(k-1)) / (N(last k) + B), down to the plain
share of a character. A URL's score is the mean log ratio of the two, so length does not count; the
cut is calibrated on labelled URLs that the models have not seen.

All of it is DataFrame code. The models are tables of character windows: one aggregate over all URLs
counts each distinct window for both sides, shorter contexts are sums of those counts, and scoring is
a join on the window, which adaptive execution splits where a window is very common.

Edge cases: a NULL URL, or one without ``://``, has an empty host and path, fits no rule and is
blocked by the method, since there is nothing to score; repeated rows are judged one by one; where
the rules leave one side without examples, the method allows; an empty table gives no rows; other
columns are not looked at. Very long URLs are scored whole, in linear time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import staged

# (verdict, host, path); a rule fits its host and all subdomains where the path starts with its own.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
ORDER = 4  # characters of context
BACKOFF = 4.0  # B: weight of the shorter context
HELD_SHARE = 5  # one labelled URL in so many calibrates the cut
# Code points that no URL holds, before its first character and after its last.
BEFORE, AFTER = "\x01", "\x02"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case (A-Z only) and path, both empty where the URL has no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(F.coalesce(at, F.lit(0)) > 0, url.substr(at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    tail = rest.substr(F.length(host) + 1, F.length(rest))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), F.regexp_extract(tail, "^[^?#]*", 0)


def matching_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; NULL where none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for side, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        name = F.when(fits, rule_host + rule_path).otherwise(name)
        verdict = F.when(fits, side).otherwise(verdict)
    return name, verdict


def _windows(text: Column) -> Column:
    """Each character of the text, and its end, with the ORDER characters before it."""
    chars = F.split(F.concat(F.lit(BEFORE * ORDER), text, F.lit(AFTER)), "")
    return F.transform(
        F.sequence(F.lit(1), F.length(text) + 1),
        lambda i: F.array_join(F.slice(chars, i, ORDER + 1), ""),
    )


def log_ratios(counts: DataFrame) -> DataFrame:
    """(w, ratio) for windows counted on both sides, (w, allow, block)."""
    sides = ("allow", "block")
    table = counts
    # Order zero: shares of single characters, smoothed by one count each.
    totals = counts.agg(*[F.sum(s).alias(s) for s in sides], F.count_distinct(F.right("w", F.lit(1))).alias("n")).first()
    for k in range(ORDER + 1):
        suffix = F.right("w", F.lit(k + 1))
        grams = counts.groupBy(suffix.alias("g")).agg(*[F.sum(s).alias(f"g_{s}") for s in sides])
        table = table.join(grams, F.right("w", F.lit(k + 1)) == F.col("g")).drop("g")
        if k == 0:
            for s in sides:
                table = table.withColumn(
                    f"p_{s}", (F.col(f"g_{s}") + 1) / F.lit(float((totals[s] or 0) + totals["n"]))
                )
        else:
            context = F.substring("w", ORDER - k + 1, k)
            met = counts.groupBy(context.alias("c")).agg(*[F.sum(s).alias(f"c_{s}") for s in sides])
            table = table.join(met, F.substring("w", ORDER - k + 1, k) == F.col("c")).drop("c")
            for s in sides:
                longer = (F.col(f"g_{s}") + BACKOFF * F.col(f"p_{s}")) / (F.col(f"c_{s}") + BACKOFF)
                table = table.withColumn(f"p_{s}", longer)
            table = table.drop(*[f"c_{s}" for s in sides])
        table = table.drop(*[f"g_{s}" for s in sides])
    return table.select("w", F.log(F.col("p_allow") / F.col("p_block")).alias("ratio"))


@dataclass
class UrlCut:
    """The calibrated cut, and how many labelled URLs on each side it gets right."""

    cut: float
    allowed_kept: float
    blocked_caught: float


def calibrate(scores: DataFrame) -> UrlCut:
    """Cut with the best mean of both rates, over 1000 quantiles of the held-out scores."""
    points = [i / 1000 for i in range(1001)]
    rows = (
        scores.groupBy("known").agg(F.percentile_approx("score", points, 100_000).alias("q")).collect()
    )
    q = {r["known"]: r["q"] for r in rows}
    if not q.get("allow") or not q.get("block"):
        return UrlCut(float("-inf"), 1.0, 0.0)
    best = UrlCut(0.0, 0.0, 0.0)
    marks = sorted(set(q["allow"]) | set(q["block"]))
    for low, high in zip(marks, marks[1:]):
        cut = (low + high) / 2
        kept = sum(x >= cut for x in q["allow"]) / len(points)
        caught = sum(x < cut for x in q["block"]) / len(points)
        if kept + caught > best.allowed_kept + best.blocked_caught:
            best = UrlCut(cut, kept, caught)
    return best


def judge_urls(
    pages: DataFrame, url: str = "url", keep: str = "page_id", rules=RULES
) -> tuple[DataFrame, UrlCut]:
    """``row``, host, path, rule, verdict and the language-model ``score`` of every URL."""
    host, path = host_and_path(F.col("u"))
    name, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    base = staged(
        pages.select(F.col(keep).alias("row"), F.col(url).alias("u"))
        .select("row", host.alias("host"), path.alias("path"))
        .withColumn("rule", name)
        .withColumn("known", verdict)
        .withColumn("rid", F.monotonically_increasing_id())
    )
    held = F.pmod(F.xxhash64("host", "path"), F.lit(HELD_SHARE)) == 0
    windows = (
        base.withColumn("text", F.concat("host", "path"))
        .filter(F.length("text") > 0)
        .select("rid", F.when(~held, F.col("known")).alias("side"), F.explode(_windows(F.col("text"))).alias("w"))
    )
    counts = staged(
        windows.groupBy("w").agg(
            F.count_if(F.col("side") == "allow").alias("allow"),
            F.count_if(F.col("side") == "block").alias("block"),
        )
    )
    ratios = staged(log_ratios(counts))
    scores = staged(
        windows.select("rid", "w").join(ratios, "w").groupBy("rid").agg(F.avg("ratio").alias("score"))
    )
    scored = base.join(scores, "rid", "left")
    cut = calibrate(scored.filter(held & F.col("known").isNotNull() & F.col("score").isNotNull()))
    method = F.when(F.col("score") >= F.lit(cut.cut), "allow").otherwise("block")
    return (
        scored.select(
            "row", "host", "path", "rule", F.coalesce("known", method).alias("verdict"), "score"
        ),
        cut,
    )
