"""Quality scores from preferences: Bradley-Terry on feature differences, cut at a score quantile.

Every labelled pair of a good and a bad document is a preference for the good one. The model is a
linear score whose differences are the log odds of winning, learnt by logistic loss on feature
differences. The cut is the quantile of the scores that leaves as many labelled documents above it
as are labelled good; the published score is the logistic function of the distance from the cut.

Features are the measurements of the rule ledger, as shares of words, so one pass over whole texts
without a shuffle serves training and scoring, and scoring is a column expression.

Edge cases: NULL and empty texts are scored from their zero measurements; labels that are NULL, not
0 or 1, or of unknown documents are not used; repeated rows are scored one by one; without labels of
both kinds every score is 0.5; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import hash_share, staged
from ledgermill.llm.rules import rule_ledger

# Bounds of what is fitted on the driver; beyond them the rows of the smallest hashes are taken.
MAX_LABELLED = 20_000
MAX_PAIRS = 200_000
RIDGE = 1e-3

_WORDS = "greatest(n_words, 1)"
FEATURES: dict[str, str] = {
    "length": "ln(1 + n_words)",
    "short": "CASE WHEN n_words < 20 THEN 1D ELSE 0D END",
    "word_length": f"word_chars / {_WORDS}",
    "symbols": f"n_symbols / (n_symbols + {_WORDS})",
    "lines": f"n_lines / (n_lines + {_WORDS})",
    "duplicate_lines": "n_dup_lines / greatest(n_lines, 1)",
    "repeated": f"n_repeat_words / {_WORDS}",
    "stutters": f"n_stutters / {_WORDS}",
    "upper": "n_upper / greatest(word_chars, 1)",
    "exclamations": f"n_exclamations / (n_exclamations + {_WORDS})",
}


@dataclass
class PairwiseModel:
    """Weights on plain features, and the cut; no weights where there was nothing to learn."""

    weights: dict[str, float]
    cut: float

    def score(self) -> Column:
        """Score between 0 and 1 over the measurements of the rule ledger."""
        if not self.weights:
            return F.lit(0.5)
        line = sum((F.expr(FEATURES[f]) * F.lit(w) for f, w in self.weights.items()), F.lit(-self.cut))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-line))


def fit_pairs(x: np.ndarray, y: np.ndarray, seed: int = 0) -> PairwiseModel:
    """Bradley-Terry weights by Newton steps on pairs of a good (1) and a bad (0) row."""
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return PairwiseModel({}, 0.0)
    middle, spread = x.mean(0), x.std(0)
    spread[spread < 1e-12] = 1.0
    z = (x - middle) / spread
    if len(good) * len(bad) <= MAX_PAIRS:
        i, j = (a.ravel() for a in np.meshgrid(good, bad))
    else:
        random = np.random.default_rng(seed)
        i, j = random.choice(good, MAX_PAIRS), random.choice(bad, MAX_PAIRS)
    d = z[i] - z[j]
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(np.clip(d @ w, -30, 30)))  # chance that the pair is the wrong way round
        slope = -(d * p[:, None]).mean(0) + RIDGE * w
        curve = (d * (p * (1 - p))[:, None]).T @ d / len(d) + RIDGE * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    w /= spread
    scores = np.sort(x @ w)
    n = len(bad)  # the quantile: as many below as are labelled bad
    return PairwiseModel(dict(zip(FEATURES, map(float, w))), float((scores[n - 1] + scores[n]) / 2))


def train(features: DataFrame, labels: DataFrame, quality: str = "quality") -> PairwiseModel:
    """Fit on at most ``MAX_LABELLED`` labelled rows; ``labels`` must hold no held-out row."""
    known = labels.filter(F.col(quality).isin(0, 1)).select("doc_id", F.col(quality).alias("y"))
    labelled = hash_share(known, "doc_id", MAX_LABELLED)
    rows = (
        features.select("doc_id", F.array(*[F.expr(f).cast("double") for f in FEATURES.values()]).alias("x"))
        .join(labelled, "doc_id")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "y")
        .limit(MAX_LABELLED)
        .collect()
    )
    if not rows:
        return PairwiseModel({}, 0.0)
    return fit_pairs(np.array([r["x"] for r in rows]), np.array([r["y"] for r in rows]))


def held_out(doc_id: Column) -> Column:
    """Rows never learnt from: those whose checksum of the id leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def score_documents(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, PairwiseModel]:
    """doc_id, held_out, score and predicted for every document; the model."""
    features = staged(rule_ledger(docs))
    model = train(features, labels.filter(~held_out(F.col("doc_id"))))
    scored = features.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), model.score().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int")), model
