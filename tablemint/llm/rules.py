"""Quality rules as weak supervision.

Each rule looks at counts taken from one whole text and votes to keep it, votes to reject it, or
abstains.  Which votes are right is not known, so expectation-maximisation estimates how often each
rule is right about good and about bad texts, and a text's posterior probability of being good
decides, not a conjunction of all rules.  The model needs only the number of texts per vote pattern
(at most 3 to the number of rules), which Spark counts over all rows.

Defined cases: a null or empty text has no words, zero counts and fails the base rule; equal rows are
separate rows with equal results; an empty table gives an empty result; columns of the input other
than the text are passed through, and only the output column names given by the caller are added.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stage
from .common import query, small_batches, table, words

SYMBOLS = "#*$%&|<>"
_SPACES = " \t\n\v\f\r"
_SPACE, _SYMBOL, _LETTER, _UPPER, _MARK, _DIGIT = (1 << i for i in range(6))

_NAMES = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_letters", "n_upper", "n_marks",
]
MEASURES = T.StructType([T.StructField(name, T.LongType()) for name in _NAMES])


def repeated_words(tokens: list[bytes]) -> int:
    """Words covered by three-word windows that occur at least twice in the text."""
    n = len(tokens)
    if n < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in tokens), np.int64, n)
    base = len(number)
    pairs = ids[:-1] * base + ids[1:]
    _, pairs = np.unique(pairs, return_inverse=True)
    windows = pairs[:-1].astype(np.int64) * base + ids[2:]
    _, which, counts = np.unique(windows, return_inverse=True, return_counts=True)
    hit = counts[which] > 1
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift : n - 2 + shift] |= hit
    return int(covered.sum())


@cache
def _classes() -> np.ndarray:
    """The classes of every code point, as bits."""
    kinds = np.zeros(0x110000, np.uint8)
    for c in map(chr, range(0x110000)):
        if c.isalpha():
            kinds[ord(c)] |= _LETTER
        if c.isupper():
            kinds[ord(c)] |= _UPPER
        if c.isdigit():
            kinds[ord(c)] |= _DIGIT
    kinds[[0x20, *range(0x09, 0x0E)]] |= _SPACE
    kinds[[ord(c) for c in SYMBOLS]] |= _SYMBOL
    kinds[ord("!")] |= _MARK
    return kinds


def character_counts(text: str) -> dict[int, int]:
    """How many code points of each class a text holds."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    found = np.bincount(_classes()[codes], minlength=64)
    kinds = np.arange(len(found))
    return {bit: int(found[kinds & bit > 0].sum()) for bit in (_SPACE, _SYMBOL, _LETTER, _UPPER, _MARK, _DIGIT)}


def measure_text(text: str | None) -> tuple[int, ...]:
    """The counts of one text, in the order of ``MEASURES``."""
    if not text:
        return (0,) * len(_NAMES)
    tokens = words(text)
    lines = [line for line in text.split("\n") if line.strip(_SPACES)]
    kinds = character_counts(text)
    return (
        len(tokens),
        len(text) - kinds[_SPACE],
        kinds[_SYMBOL],
        len(lines) - len(set(lines)),
        repeated_words(tokens),
        len(lines),
        kinds[_LETTER],
        kinds[_UPPER],
        kinds[_MARK],
    )


def measures(text: str) -> Column:
    """The counts of a text column, as a struct."""

    small_batches(SparkSession.getActiveSession())

    @F.pandas_udf(MEASURES)
    def measure(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([measure_text(t) for t in texts], columns=_NAMES, dtype="int64")

    return measure(F.col(text))


@dataclass(frozen=True)
class Rule:
    """``value`` at most ``keep`` votes to keep, above ``reject`` votes to reject, else abstains."""

    name: str
    value: str
    keep: float
    reject: float


#: Shares of words, letters or lines; a text without any words makes every rule abstain.
RULES = (
    Rule("repetition", "n_repeat_words / n_words", 0.15, 0.5),
    Rule("symbols", "n_symbols / n_words", 0.05, 0.3),
    Rule("capitals", "n_upper / greatest(n_letters, 1)", 0.2, 0.5),
    Rule("exclamation", "n_marks / n_words", 0.05, 0.3),
    Rule("duplicate_lines", "n_dup_lines / greatest(n_lines, 1)", 0.1, 0.4),
    Rule("word_length", "abs(word_chars / n_words - 6.5)", 3.0, 6.0),
    Rule("not_letters", "1 - n_letters / greatest(word_chars, 1)", 0.12, 0.3),
)


def votes(measure: str, rules: tuple[Rule, ...] = RULES) -> Column:
    """One character per rule: ``+`` keep, ``-`` reject, ``0`` abstain."""

    def one(rule: Rule) -> Column:
        value = F.expr(re.sub(r"\b(n_\w+|word_chars)", rf"{measure}.\1", rule.value))
        return (
            F.when(F.col(f"{measure}.n_words") == 0, "0")
            .when(value <= rule.keep, "+")
            .when(value > rule.reject, "-")
            .otherwise("0")
        )

    return F.concat(*[one(rule) for rule in rules])


VOTES = "+-"


@dataclass(frozen=True)
class VoteModel:
    """``good[r][v]`` and ``bad[r][v]``: how often rule r, when it votes, casts v on texts of either class."""

    prior: float
    good: tuple[tuple[float, ...], ...]
    bad: tuple[tuple[float, ...], ...]

    def accuracy(self, rule: int) -> tuple[float, float]:
        """How often the rule, when it votes, is right about good and about bad texts."""
        g, b = self.good[rule], self.bad[rule]
        return g[0] / (g[0] + g[1]), b[1] / (b[0] + b[1])

    def posterior(self, pattern: str) -> float:
        odds = math.log(self.prior) - math.log1p(-self.prior)
        for vote, g, b in zip(pattern, self.good, self.bad, strict=True):
            if vote not in VOTES:
                continue
            at = VOTES.index(vote)
            odds += math.log(g[at]) - math.log(b[at])
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, odds))))


def fit_votes(counts: dict[str, int], n_rules: int, rounds: int = 200) -> VoteModel:
    """Expectation-maximisation over pattern counts.

    It starts from the count of rejections (none: good, one: probably bad, more: bad), which settles
    which class is which.  There are several ways to be bad, so a rule that rejects a few bad texts is
    informative although it lets the others pass.  An abstention says nothing.
    """
    patterns = sorted(counts)
    n = np.array([counts[p] for p in patterns], float)
    cast = np.array([[[c == v for v in VOTES] for c in p] for p in patterns], float).reshape(-1, n_rules, 2)
    rejections = cast[:, :, 1].sum(axis=1)
    share = np.where(rejections == 0, 0.98, np.where(rejections == 1, 0.2, 0.02))
    # Pseudo counts: a hundredth of a text for either vote, so no rate is zero however few texts there are.
    prior, good, bad = 0.9, np.full((n_rules, 2), 1 / 2), np.full((n_rules, 2), 1 / 2)
    for _ in range(rounds if len(patterns) else 0):
        before = np.concatenate([[prior], good.ravel(), bad.ravel()])
        p, q = n * share, n * (1 - share)
        prior = (p.sum() + 9) / (n.sum() + 10)
        good = np.einsum("p,prv->rv", p, cast) + 0.01
        bad = np.einsum("p,prv->rv", q, cast) + 0.01
        good /= good.sum(axis=1, keepdims=True)
        bad /= bad.sum(axis=1, keepdims=True)
        odds = np.log(prior / (1 - prior)) + np.einsum("prv,rv->p", cast, np.log(good) - np.log(bad))
        share = 1 / (1 + np.exp(-np.clip(odds, -700, 700)))
        if np.abs(np.concatenate([[prior], good.ravel(), bad.ravel()]) - before).max() < 1e-10:
            break
    return VoteModel(float(prior), tuple(map(tuple, good.tolist())), tuple(map(tuple, bad.tolist())))


def base_failed(measure: str) -> Column:
    m = F.col(measure)
    return (m.n_words < 50) | (100 * m.n_repeat_words > 50 * m.n_words)


#: Posterior probability of being good from which on a text is kept.
MIN_PROBABILITY = 0.9


def judge(measured: DataFrame, measure: str, threshold: float = MIN_PROBABILITY) -> DataFrame:
    """Add ``probability`` and ``kept`` to rows that hold a measure struct.

    The pattern table has at most 3 to the number of rules rows, so it is a literal map here.
    """
    pattern = votes(measure)
    counted = measured.groupBy(pattern.alias("pattern")).count().collect()
    model = fit_votes({r["pattern"]: r["count"] for r in counted}, len(RULES))
    probability = {r["pattern"]: model.posterior(r["pattern"]) for r in counted}
    if probability:
        lookup = F.create_map(*[F.lit(x) for item in sorted(probability.items()) for x in item])
    else:
        lookup = F.create_map(F.lit(""), F.lit(0.0))
    # A pattern not seen when the model was fitted cannot occur: both passes read the same rows.
    judged = measured.withColumn("probability", lookup[pattern])
    return judged.withColumn("kept", ~base_failed(measure) & (F.col("probability") >= threshold))


def filter_quality(docs: DataFrame, text: str = "text", threshold: float = MIN_PROBABILITY) -> DataFrame:
    """The rows of ``docs`` that are kept, with the columns of ``docs``."""
    measured = docs.select(F.struct(*docs.columns).alias("_row"), measures(text).alias("_m"))
    return judge(measured, "_m", threshold).filter("kept").select("_row.*")


@query("op7_quality_rules")
def op7_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    # The counts are small; storing them spares a second pass over the texts.
    measured = stage(docs.select("doc_id", measures("text").alias("m")), "rule-measures")
    m = F.col("m")
    return judge(measured, "m").select(
        "doc_id",
        m.n_words.alias("n_words"),
        m.word_chars.alias("word_chars"),
        m.n_symbols.alias("n_symbols"),
        m.n_dup_lines.alias("n_dup_lines"),
        m.n_repeat_words.alias("n_repeat_words"),
        base_failed("m").alias("base_failed"),
        "kept",
        "probability",
        votes("m").alias("votes"),
    )
