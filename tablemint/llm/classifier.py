"""A quality classifier by pairwise ranking.

A Bradley-Terry model gives every document a score such that the difference of two scores is the log
odds that the first is the better one.  It is fitted by logistic loss on the feature differences of
preference pairs: a document labelled good is preferred to one labelled bad.  The decision bound is a
quantile of the training scores, the one that separates the labels best.

Features are shares and averages taken from the whole text; labels, language, source and id are no
features.  They are computed for all documents by Spark; the fit uses at most ``SAMPLE_ROWS`` labelled
rows, picked by a hash of the id, and ``PAIRS`` pairs of them.

Defined cases: a null or empty text has zero features and gets a score like any other; repeated rows
get equal scores; rows with a null label, id or no label train nothing but are scored; with one class
of labels, or none, every score is that of an uninformed model; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import bounded_sample, fold, query, small_batches, table
from .rules import measure_text

SAMPLE_ROWS = 20_000
PAIRS = 100_000
#: Score of a document that lies on the decision bound.
BOUND = 0.7


def text_features(text: str | None) -> list[float]:
    """Features of one text.  Ratios are over words, letters or lines; sizes are logarithms."""
    n_words, word_chars, symbols, dup_lines, repeats, lines, letters, upper, marks = measure_text(text)
    if not n_words:
        return [0.0] * N_FEATURES
    body = text or ""
    low = body.lower().split()
    packed = len(zlib.compress(body.encode("utf-8", "surrogatepass"), 1))
    size = len(body.encode("utf-8", "surrogatepass"))
    ends = sum(w[-1] in ".!?" for w in low)
    shares = [
        symbols / n_words,
        dup_lines / max(1, lines),
        repeats / n_words,
        upper / max(1, letters),
        marks / n_words,
        letters / max(1, word_chars),
        word_chars / n_words / 10,
        len(set(low)) / n_words,
        min(1.0, ends / n_words),
        packed / max(1, size),
        body.count("|") / n_words,
    ]
    sizes = [np.log1p(n_words) / 10, np.log1p(lines) / 10, np.log1p(n_words / max(1, ends)) / 10]
    # Square roots let a linear model see small shares.
    return shares + [v**0.5 for v in shares] + sizes


N_FEATURES = 25


def features(text: str) -> Column:
    @F.pandas_udf("array<double>")
    def read(texts: pd.Series) -> pd.Series:
        return pd.Series([np.array(text_features(t)) for t in texts], dtype=object)

    return read(F.col(text))


@dataclass(frozen=True)
class Ranking:
    """Raw score: weights times standardised features.  ``bound``: the raw score of the decision."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    bound: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        # Far beyond the training range features say no more.
        return np.clip((x - self.mean) / self.spread, -8, 8) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.clip(self.raw(x) - self.bound, -30, 30)
        return 1 / (1 + np.exp(-z) * (1 - BOUND) / BOUND)


def fit_ranking(x: np.ndarray, good: np.ndarray, pairs: int = PAIRS, rounds: int = 300, penalty: float = 1e-3) -> Ranking:
    """Gradient descent with momentum on preference pairs, then the quantile of the best bound."""
    width = x.shape[1] if x.size else N_FEATURES
    if not len(x) or good.all() or not good.any():
        return Ranking(np.zeros(width), np.ones(width), np.zeros(width), 0.0)
    mean, spread = x.mean(axis=0), x.std(axis=0)
    spread = np.where(spread > 1e-9, spread, 1.0)
    z = np.clip((x - mean) / spread, -8, 8)
    rng = np.random.default_rng(11)
    winners = rng.choice(np.flatnonzero(good), pairs)
    losers = rng.choice(np.flatnonzero(~good), pairs)
    weights, speed = np.zeros(width), np.zeros(width)
    for at in range(rounds):
        part = slice(at * 4096 % pairs, at * 4096 % pairs + 4096)
        difference = z[winners[part]] - z[losers[part]]
        wrong = 1 / (1 + np.exp(np.clip(difference @ weights, -30, 30)))
        gradient = -(wrong @ difference) / len(difference) + penalty * weights
        speed = 0.9 * speed - 0.1 * gradient
        weights = weights + speed
    raw = z @ weights
    order = np.sort(raw)
    best, bound = -1.0, float(order[0])
    for share in np.linspace(0, 1, 401):
        cut = float(np.quantile(order, share))
        right = np.mean((raw >= cut) == good)
        if right > best:
            best, bound = right, cut
    return Ranking(mean, spread, weights, bound)


def train(described: DataFrame, labels: DataFrame, label: str, rows: int = SAMPLE_ROWS) -> Ranking:
    """Fit on (id, features) rows joined to (id, label) rows: at most ``rows`` of them."""
    labelled = described.join(
        labels.filter(F.col(label).isin(0, 1)).select(F.col("doc_id").alias("id"), F.col(label).alias("_label")), "id"
    )
    sample = bounded_sample(labelled, "id", rows).select("features", "_label").collect()
    x = np.array([r["features"] for r in sample], float).reshape(len(sample), -1)
    return fit_ranking(x, np.array([r["_label"] == 1 for r in sample], bool))


def score_with(model: Ranking, column: str) -> Column:
    @F.pandas_udf("double")
    def score(rows: pd.Series) -> pd.Series:
        if not len(rows):
            return pd.Series([], dtype="float64")
        return pd.Series(model.score(np.stack(rows.to_numpy())))

    return score(F.col(column))


@query("op3_quality_classifier")
def op3_quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 4) == 2
    small_batches(spark)
    described = stage(
        docs.select(F.col("doc_id").alias("id"), held_out.alias("held_out"), features("text").alias("features")), "features"
    )
    model = train(described.filter(~F.col("held_out")).select("id", "features"), table(spark, sf_dir, "labels"), "quality")
    scored = described.select(F.col("id").alias("doc_id"), "held_out", score_with(model, "features").alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= BOUND, 1).otherwise(0))
