"""Text likelihood by a hidden Markov language model, beside a smoothed unigram base.

Words are counted over all training documents by Spark.  The model's symbols are the ``SYMBOLS`` most
frequent words and 64 classes, by the last byte, for all other words; a word of a class has, given the
class, its smoothed share of the class.  That share does not depend on the state, so it stands outside
the recursion and the likelihood of a text stays exact: the scaled forward recursion over its symbols,
times the shares of its class words.

Baum-Welch starts from a bounded sample of training texts; then each pass takes expected counts over
all training documents, one partition at a time, and Spark adds them up.  The parameters have a fixed
size.  Counts of the ``LISTED`` most frequent words go to every task; tokens of other words meet the
count table in a join.

Words are 64-bit hashes.  Defined cases: a null or empty text is the end token alone; equal rows are
separate documents; rows with a null id count as training rows; an empty training set gives every
token the same probability; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import bounded_sample, fold, lower_words, query, small_batches, table

SYMBOLS = 16_384
CLASSES = 64
LISTED = 262_144
STATES = 8
PASSES = 3
#: The sample that the first parameters come from: documents, and tokens of each.
SAMPLE_DOCS, SAMPLE_TOKENS = 800, 512
#: Training takes long texts in parts of so many tokens; scoring never cuts.
SEGMENT = 512
#: Tokens that are worked on at once.
CHUNK = 250_000
#: A word holds no space, so this is none.
END = xxhash.xxh3_64_intdigest(b" end")
_FLUSH = 400_000


def _hashes(tokens: list[bytes]) -> list[int]:
    found = list(map(xxhash.xxh3_64_intdigest, tokens))
    found.append(END)
    return found


def count_words(docs: DataFrame) -> DataFrame:
    """(word, cls, n) over the column ``text``; tasks send sums, not tokens."""
    schema = pa.schema([("word", pa.int64()), ("cls", pa.int32()), ("n", pa.int64())])

    def emit(counts: Counter) -> pa.RecordBatch:
        words, classes, sizes = [0] * len(counts), [0] * len(counts), [0] * len(counts)
        for i, (token, n) in enumerate(counts.items()):
            words[i] = xxhash.xxh3_64_intdigest(token) if token is not None else END
            classes[i] = token[-1] % CLASSES if token is not None else 0
            sizes[i] = n
        return pa.RecordBatch.from_arrays(
            [pa.array(np.array(words, np.uint64).view(np.int64)), pa.array(classes, pa.int32()), pa.array(sizes, pa.int64())],
            schema=schema,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                counts.update(lower_words(text.as_py()))
                counts[None] += 1
                if len(counts) > _FLUSH:
                    yield emit(counts)
                    counts = Counter()
        if counts:
            yield emit(counts)

    partial = docs.select("text").mapInArrow(run, "word long, cls int, n long")
    return partial.groupBy("word").agg(F.min("cls").alias("cls"), F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """What every task needs: listed words with their counts and symbols, and the class totals."""

    words: np.ndarray  # ascending
    counts: np.ndarray
    symbols: np.ndarray
    total: int
    distinct: int
    class_tokens: np.ndarray
    class_words: np.ndarray
    unigram: np.ndarray

    @property
    def base_log(self) -> float:
        return float(np.log10(self.total + (self.distinct + 1)))

    @property
    def class_log(self) -> np.ndarray:
        return np.log10(self.class_tokens + self.class_words + 1.0)


def _level(n):
    """A scale of at most 512 steps over counts."""
    return F.floor(F.log2(n.cast("double")) * 8).cast("int")


def vocabulary(counts: DataFrame, listed: int = LISTED, symbols: int = SYMBOLS) -> tuple[Vocabulary, DataFrame]:
    """The vocabulary, and the counts of the words that are not listed."""
    levels = {r["level"]: r["words"] for r in counts.groupBy(_level(F.col("n")).alias("level")).agg(F.count("*").alias("words")).collect()}
    bound, room = max(levels, default=0) + 1, listed
    for level in sorted(levels, reverse=True):
        if levels[level] > room:
            break
        bound, room = level, room - levels[level]
    top = counts.filter(_level(F.col("n")) >= bound).select("word", "cls", "n").toArrow()  # at most ``listed`` rows
    words = top.column("word").to_numpy().view(np.uint64)
    n, cls = top.column("n").to_numpy(), top.column("cls").to_numpy()
    order = np.lexsort((words, -n))
    words, n, cls = words[order], n[order], cls[order]
    own = min(len(words), symbols)
    symbol = np.where(np.arange(len(words)) < own, np.arange(len(words)), own + cls)
    tokens, kinds = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in counts.groupBy("cls").agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect():
        tokens[r["cls"]], kinds[r["cls"]] = r["n"], r["words"]
    total, distinct = int(tokens.sum()), int(kinds.sum())
    np.subtract.at(tokens, cls[:own], n[:own])
    np.subtract.at(kinds, cls[:own], 1)
    weight = np.concatenate([n[:own].astype(float), tokens + 1.0])
    by_word = np.argsort(words, kind="stable")
    known = Vocabulary(
        words[by_word], n[by_word], symbol[by_word].astype(np.int64), total, distinct, tokens, kinds, weight / weight.sum()
    )
    return known, counts.filter(_level(F.col("n")) < bound)


ENCODED = "row long, id long, held_out boolean, n_tokens long, n_known long, base double, shares double, ids binary, rare array<long>"


def encode(docs: DataFrame, known) -> DataFrame:
    """Symbols of each text (two bytes each), the sums its listed words settle, and its other words."""
    schema = pa.schema([
        ("row", pa.int64()), ("id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()),
        ("shares", pa.float64()), ("ids", pa.binary()), ("rare", pa.list_(pa.int64())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = known.value
        class_log, base_log = v.class_log, v.base_log
        first_class = len(v.unigram) - CLASSES
        listed = np.log10(v.counts + 1.0)
        for batch in batches:
            out = []
            for text in batch.column(3):
                tokens = lower_words(text.as_py())
                h = np.array(_hashes(tokens), np.uint64)
                cls = np.fromiter((t[-1] for t in tokens), np.int64, len(tokens)) % CLASSES
                cls = np.append(cls, 0)
                if len(v.words):
                    at = np.searchsorted(v.words, h)
                    at[at == len(v.words)] = 0
                    hit = v.words[at] == h
                    symbol = np.where(hit, v.symbols[at], first_class + cls)
                    part = np.where(hit, listed[at], 0.0)
                else:
                    hit, symbol, part = np.zeros(len(h), bool), first_class + cls, np.zeros(len(h))
                classed = symbol >= first_class
                shares = part[classed].sum() - class_log[symbol[classed] - first_class].sum()
                out.append((
                    len(h), int(hit.sum()), float(part.sum() - base_log * len(h)), float(shares),
                    symbol.astype("<u2").tobytes(), h[~hit].view(np.int64),
                ))
            made = list(zip(*out)) if out else [[]] * (len(schema) - 3)
            made = [pa.array(c, f.type) for c, f in zip(made, list(schema)[3:])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *made], schema=schema)

    return docs.select("row", F.col("id").cast("long"), "held_out", "text").mapInArrow(run, ENCODED)


@dataclass
class Model:
    """``start[s]``, ``move[s, t]`` and ``emit[symbol, s]``."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray


class Packed:
    """Sequences in time-major order, longest first: step t holds the sequences longer than t."""

    def __init__(self, sequences: list[np.ndarray]):
        sizes = np.array([len(s) for s in sequences])
        self.order = np.argsort(-sizes, kind="stable")
        sizes = sizes[self.order]
        steps = int(sizes[0]) if len(sizes) else 0
        self.active = np.searchsorted(-sizes, -np.arange(steps), side="left")
        self.first = np.concatenate([[0], np.cumsum(self.active)])
        flat = np.concatenate([sequences[i] for i in self.order]).astype(np.int64)
        rank = np.repeat(np.arange(len(sizes)), sizes)
        step = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        self.symbols = np.empty(len(flat), np.int64)
        self.symbols[self.first[step] + rank] = flat

    def forward(self, model: Model, keep: bool = False):
        """Log likelihood (natural) of each sequence; with ``keep`` also scaled alphas, scales and emissions."""
        emit = model.emit[self.symbols]
        likelihood = np.zeros(len(self.order))
        alphas, scales = (np.empty_like(emit), np.empty(len(emit))) if keep else (None, None)
        alpha = None
        for t, n in enumerate(self.active):
            at = slice(self.first[t], self.first[t + 1])
            alpha = (model.start if alpha is None else alpha[:n] @ model.move) * emit[at]
            scale = alpha.sum(axis=1)
            alpha /= scale[:, None]
            likelihood[:n] += np.log(scale)
            if keep:
                alphas[at], scales[at] = alpha, scale
        out = np.empty_like(likelihood)
        out[self.order] = likelihood
        return (out, alphas, scales, emit) if keep else out

    def expected(self, model: Model):
        """Expected counts (start, move, emit) and the log likelihood of all sequences."""
        likelihood, alphas, scales, emit = self.forward(model, keep=True)
        states = len(model.start)
        move = np.zeros((states, states))
        gamma = np.empty_like(alphas)
        beta = np.ones((len(self.order), states))
        for t in range(len(self.active) - 1, -1, -1):
            n = self.active[t]
            at = slice(self.first[t], self.first[t + 1])
            gamma[at] = alphas[at] * beta[:n]
            if t:
                ahead = emit[at] * beta[:n] / scales[at][:, None]
                before = slice(self.first[t - 1], self.first[t - 1] + n)
                move += alphas[before].T @ ahead
                beta[:n] = ahead @ model.move.T
        counts = np.stack(
            [np.bincount(self.symbols, gamma[:, s], len(model.emit)) for s in range(states)], axis=1
        )
        return gamma[: self.active[0]].sum(axis=0), move * model.move, counts, float(likelihood.sum())


def maximise(start: np.ndarray, move: np.ndarray, counts: np.ndarray, unigram: np.ndarray) -> Model:
    """Parameters from expected counts, with the weight of a few tokens on uniform or unigram shares."""
    start = start + 1.0
    move = move + 1.0
    emit = counts + 100.0 * unigram[:, None]
    return Model(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def first_model(sequences: list[np.ndarray], unigram: np.ndarray, states: int = STATES, rounds: int = 20) -> Model:
    """Baum-Welch over a bounded sample, from a seeded disturbance of the unigram shares."""
    rng = np.random.default_rng(5)
    emit = unigram[:, None] * np.exp(0.5 * rng.standard_normal((len(unigram), states)))
    move = np.full((states, states), 0.1 / max(1, states - 1))
    np.fill_diagonal(move, 0.9)
    model = Model(np.full(states, 1 / states), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))
    if sequences:
        packed = Packed(sequences)
        for _ in range(rounds):
            start, moves, counts, _ = packed.expected(model)
            model = maximise(start, moves, counts, unigram)
    return model


def chunks(ids: Iterator[np.ndarray]) -> Iterator[list[np.ndarray]]:
    """Lists of sequences that hold about ``CHUNK`` tokens."""
    part, size = [], 0
    for one in ids:
        part.append(one)
        size += len(one)
        if size >= CHUNK:
            yield part
            part, size = [], 0
    if part:
        yield part


def _windows(pairs, size: int) -> Iterator[list[tuple[int, np.ndarray]]]:
    """Lists of (row, sequence) that hold about ``size`` tokens."""
    part, held = [], 0
    for row, ids in pairs:
        part.append((row, np.frombuffer(ids.as_py(), "<u2")))
        held += len(part[-1][1])
        if held >= size:
            yield part
            part, held = [], 0
    if part:
        yield part


def baum_welch(encoded: DataFrame, model: Model, unigram: np.ndarray) -> Model:
    """One pass over all rows of ``encoded``: expected counts by partition, summed by Spark."""
    states = len(model.start)
    shared = encoded.sparkSession.sparkContext.broadcast(model)
    names = [f"e{s}" for s in range(states)]
    schema = pa.schema([("symbol", pa.int64())] + [(n, pa.float64()) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        start, move, counts = np.zeros(states), np.zeros((states, states)), np.zeros_like(m.emit)

        def segments():
            for batch in batches:
                for ids in batch.column(0):
                    one = np.frombuffer(ids.as_py(), "<u2")
                    for at in range(0, len(one), SEGMENT):
                        yield one[at : at + SEGMENT]

        for part in chunks(segments()):
            s, mv, c, _ = Packed(part).expected(m)
            start += s
            move += mv
            counts += c
        used = np.flatnonzero(counts.sum(axis=1) > 0)
        # Rows -1, -2, ... are the states' moves; the row below them is the start.
        symbols = np.concatenate([used, -1 - np.arange(states + 1)])
        values = np.concatenate([counts[used], move, start[None, :]])
        yield pa.RecordBatch.from_arrays(
            [pa.array(symbols, pa.int64()), *[pa.array(values[:, s]) for s in range(states)]], schema=schema
        )

    sums = encoded.select("ids").mapInArrow(run, "symbol long, " + ", ".join(f"{n} double" for n in names))
    found = sums.groupBy("symbol").agg(*[F.sum(n).alias(n) for n in names]).toArrow()  # one row per symbol
    symbols = found.column("symbol").to_numpy()
    values = np.stack([found.column(n).to_numpy() for n in names], axis=1) if len(symbols) else np.zeros((0, states))
    counts, rest = np.zeros_like(model.emit), np.zeros((states + 1, states))
    counts[symbols[symbols >= 0]] = values[symbols >= 0]
    rest[-1 - symbols[symbols < 0]] = values[symbols < 0]
    return maximise(rest[states], rest[:states], counts, unigram)


def likelihoods(encoded: DataFrame, model: Model) -> DataFrame:
    """(row, likelihood): the log10 likelihood of the whole symbol sequence."""
    shared = encoded.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("row", pa.int64()), ("likelihood", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value

        def numbered():
            for batch in batches:
                yield from zip(batch.column(0).to_pylist(), batch.column(1))

        # Sequences of like length go together, so that few steps have few of them.
        for some in _windows(numbered(), 8 * CHUNK):
            some.sort(key=lambda pair: -len(pair[1]))
            at = 0
            for part in chunks(ids for _, ids in some):
                found = Packed(part).forward(m)
                rows = [row for row, _ in some[at : at + len(part)]]
                at += len(part)
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(found / np.log(10))], schema=schema)

    return encoded.select("row", "ids").mapInArrow(run, "row long, likelihood double")


def score_texts(docs: DataFrame, held_out, key: str = "doc_id", text: str = "text", listed: int = LISTED, symbols: int = SYMBOLS) -> DataFrame:
    """Per row: id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10)."""
    spark = docs.sparkSession
    small_batches(spark)
    source = docs.select(F.col(key).alias("id"), held_out.alias("held_out"), F.col(text).alias("text"))
    counts = stage(count_words(source.filter(~F.col("held_out"))), "word-counts")
    known, others = vocabulary(counts, listed, symbols)
    shared = spark.sparkContext.broadcast(known)
    numbered = source.withColumn("row", F.monotonically_increasing_id())
    encoded = stage(encode(numbered, shared), "encoded")
    training = encoded.filter(~F.col("held_out"))
    sample = bounded_sample(training, "row", SAMPLE_DOCS).select(
        F.substring("ids", 1, 2 * SAMPLE_TOKENS).alias("ids")
    ).collect()
    model = first_model([np.frombuffer(r["ids"], "<u2") for r in sample], known.unigram)
    for _ in range(PASSES):
        model = baum_welch(training, model, known.unigram)
    # Words beside the list: what the counts add to the sums of each row.
    rare = encoded.select("row", F.explode("rare").alias("word"))
    met = rare.join(others.select("word", "n"), "word").groupBy("row").agg(
        F.sum(F.log10(F.col("n") + 1.0)).alias("part"), F.count("*").alias("hits")
    )
    whole = encoded.drop("ids", "rare").join(likelihoods(encoded, model), "row").join(met, "row", "left")
    part = F.coalesce("part", F.lit(0.0))
    return whole.select(
        "id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("hits", F.lit(0))).alias("n_known"),
        F.lit(known.total).cast("long").alias("train_tokens"),
        (F.col("base") + part).alias("base_score"),
        (F.col("likelihood") + F.col("shares") + part).alias("score"),
    )


@query("op4_hmm_scores")
def op4_hmm_scores(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return score_texts(docs, fold("doc_id", 7) == 2).withColumnRenamed("id", "doc_id")
