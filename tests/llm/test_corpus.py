"""Operators over the whole corpus, against brute force on small inputs."""

import itertools
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tablemint.llm import hmm, minhash, mixing, topk
from tablemint.llm.graph import components
from tablemint.llm.minhash import Shingling, near_duplicates
from tablemint.llm.queries import QUERIES
from tests.llm.test_texts import TEXTS, docs_of

SMALL = "/root/testdata/sf0.001"


def tokens(text):
    return (text or "").encode().lower().split()


def sets_of(texts, width):
    out = {}
    for i, text in texts.items():
        t = tokens(text)
        size = min(width, len(t))
        out[i] = {tuple(t[k : k + size]) for k in range(len(t) - size + 1)} if t else set()
    return out


def plain_components(sets, threshold):
    parent = {i: i for i in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        common = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * common >= threshold * (len(sets[a]) + len(sets[b]) - common):
            low, high = sorted((top(a), top(b)))
            parent[high] = low
    return {i: top(i) for i in sets}


def edited(rng, base, share):
    return " ".join(w if rng.random() > share else f"z{rng.randrange(10**6)}" for w in base)


def copies(rng):
    """Groups of copies, chains of edits, and a passage in many otherwise different texts."""
    passage = [f"p{i}" for i in range(30)]
    texts = []
    for g in range(6):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.randint(20, 120))]
        texts += [" ".join(base)] * 3 + [edited(rng, base, s) for s in (0.01, 0.03, 0.05, 0.08, 0.1, 0.12) for _ in range(3)]
    chain = [f"c{i}" for i in range(100)]
    for step in range(12):
        chain[7 * step % 100] = f"n{step}"
        texts.append(" ".join(chain))
    texts += [" ".join(passage + [f"q{rng.randrange(10**6)}" for _ in range(rng.randint(5, 40))]) for _ in range(40)]
    rng.shuffle(texts)
    return texts + TEXTS


@pytest.mark.parametrize("width, threshold", [(2, 80), (5, 80)])
def test_near_duplicates_match_brute_force(spark, width, threshold, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 4)  # several blocks for small lists
    texts = dict(enumerate(copies(random.Random(width))))
    docs = docs_of(spark, list(texts.values()))
    got = near_duplicates(docs, Shingling(width, threshold)).collect()
    sets = sets_of(texts, width)
    want = plain_components(sets, threshold)
    assert len(got) == 2 * len(texts)
    for r in got:
        assert r.n == len(sets[r.id]) and r.component == want[r.id]
    assert near_duplicates(docs.limit(0)).count() == 0


def test_null_ids_and_shared_ids(spark):
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    docs = spark.createDataFrame([(None, a), (None, a), (5, a), (5, b), (7, b), (9, a)], "doc_id long, text string")
    got = sorted(((r.id, r.component) for r in near_duplicates(docs).collect()), key=str)
    assert got == [(5, 5), (5, 5), (7, 5), (9, 5), (None, None), (None, None)]


def test_query_on_the_small_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    want = plain_components(sets_of(texts, 2), 80)
    got = {r.doc_id: (r.component_id, r.kept) for r in QUERIES["op2_minhash"](spark, SMALL).collect()}
    assert got == {i: (c, c == i) for i, c in want.items()}


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 60)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r.id: r.component for r in components(edges).collect()}
    assert got == {i: 1 for i in range(1, 61)} | {100: 100, 101: 100}


# --- language model --------------------------------------------------------------------------------


@pytest.mark.parametrize("listed", [0, 40, 5000])
def test_base_scores_match_brute_force(spark, listed):
    texts = dict(enumerate([*(" ".join(f"w{(i * k) % 97}" for k in range(i)) for i in range(60)), *TEXTS]))
    docs = docs_of(spark, list(texts.values())).filter("doc_id is not null")
    got = hmm.score_texts(docs, hmm.fold("doc_id", 7) == 2, listed=listed, symbols=listed // 2).collect()
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    c = Counter()
    for i, text in texts.items():
        if not held[i]:
            c.update({w: 2 * n for w, n in Counter([*tokens(text), None]).items()})
    total, distinct = sum(c.values()), len(c)
    assert len(got) == 2 * len(texts)
    for r in got:
        words = [*tokens(texts[r.id]), None]
        base = sum(np.log10((c[w] + 1) / (total + distinct + 1)) for w in words)
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[r.id], len(words), total)
        assert r.n_known == sum(c[w] > 0 for w in words)
        assert r.base_score == pytest.approx(base) and np.isfinite(r.score) and r.score < 0
    assert hmm.score_texts(docs.limit(0), F.lit(False)).count() == 0
    untrained = hmm.score_texts(docs, F.lit(True)).first()
    assert untrained.train_tokens == 0 and untrained.n_known == 0


def test_forward_is_exact_and_training_helps():
    rng = np.random.default_rng(1)
    unigram = np.full(5, 0.2)
    model = hmm.first_model([], unigram, states=3)
    sequences = [rng.integers(0, 5, n) for n in (1, 4, 2, 6)]
    got = hmm.Packed(sequences).forward(model)
    for likelihood, seq in zip(got, sequences):
        total = 0.0
        for path in itertools.product(range(3), repeat=len(seq)):
            p = model.start[path[0]] * model.emit[seq[0], path[0]]
            for t in range(1, len(seq)):
                p *= model.move[path[t - 1], path[t]] * model.emit[seq[t], path[t]]
            total += p
        assert likelihood == pytest.approx(np.log(total))
    data = [np.array([0, 1] * 50), np.array([2, 3] * 50)]
    fitted = hmm.first_model(data, unigram, states=3)
    assert hmm.Packed(data).forward(fitted).sum() > hmm.Packed(data).forward(model).sum() + 50


def test_held_out_texts_are_likelier_than_by_the_base(spark):
    rows = [r for r in QUERIES["op4_hmm_scores"](spark, SMALL).collect() if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


# --- nearest rows ----------------------------------------------------------------------------------


def test_top_k_with_ties_hot_vectors_and_bad_vectors(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(4)
    vectors = {i: rng.normal(size=6).round(1).tolist() for i in range(200)}
    vectors |= {i: [0.5] * 6 for i in range(200, 300)}
    bad = {300: None, 301: [1.0, None, 1.0], 302: [float("nan")] * 6, 303: [float("inf")] * 6, 350: []}
    df = spark.createDataFrame([(i, v, 9) for i, v in (vectors | bad).items()], "vec_id long, embedding array<float>, score int")
    got = {}
    for r in topk.top_k(df, lambda key: key % 50 == 0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.id, r.score))
    whole = {i: np.floor(256 * np.array(v, np.float32).astype(float)).astype(int) for i, v in vectors.items()}
    for q in (i for i in vectors if i % 50 == 0):
        best = sorted((-int(whole[q] @ whole[i]), i) for i in vectors if i != q)[:5]
        assert sorted(got.pop(q)) == [(n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert not got and topk.top_k(df.limit(0), lambda key: key % 50 == 0).count() == 0


def test_fewer_rows_than_k(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, [-1.0])], "vec_id long, embedding array<float>")
    rows = topk.top_k(df, lambda key: key % 50 == 0).collect()
    assert sorted((r["rank"], r.id, r.score) for r in rows) == [(1, 1, 256 * 512), (2, 2, -(256 * 256))]


# --- mixing ----------------------------------------------------------------------------------------


def test_raked_shares_meet_their_targets(spark):
    cells = spark.createDataFrame(
        [(s, l, t, 10 + 7 * a + 3 * b + 5 * c) for a, s in enumerate("xyz") for b, l in enumerate("de") for c, t in enumerate("uv")],
        "source string, lang string, topic string, words long",
    )
    goal = {"source": {"x": 0.5, "y": 0.25, "z": 0.25}, "lang": {"d": 0.3, "e": 0.7}}
    rows = mixing.rake(cells, goal).collect()
    mass = sum(r.words * r.factor for r in rows)
    for name, shares in goal.items():
        for value, share in shares.items():
            assert sum(r.words * r.factor for r in rows if r[name] == value) / mass == pytest.approx(share, abs=1e-6)


def test_mix_of_odd_rows(spark):
    docs = docs_of(spark, TEXTS).unionByName(docs_of(spark, ["a b"]).withColumn("doc_id", F.lit(None).cast("long")))
    mixed = mixing.mix(docs)
    assert mixed.count() == docs.count() and set(docs.columns) <= set(mixed.columns)
    assert mixed.filter("_probability < 0 or _probability > 1 or _kept is null").count() == 0
    assert mixing.mix(docs.limit(0)).count() == 0


def test_one_rare_cell_does_not_thin_the_others(spark):
    base = [(i, "a b c " * 20, "xyz"[min(i % 7, 2)], "de"[i % 2]) for i in range(3000)]
    rare = [(9000, "a b c " * 20, None, None)]
    kept = []
    for rows in (base, base + rare):
        got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")).collect()
        kept.append({r.doc_id for r in got if r._kept})
        words = sum(r._words for r in got)
        assert sum(r._words * r._probability for r in got) / words == pytest.approx(mixing.SHARE)
        assert all(r._kept == (r._repeats > 0) for r in got)
    assert len(kept[0] - kept[1]) < 60 and 9000 in kept[1]
    assert next(r for r in got if r.doc_id == 9000)._repeats >= 1


# --- pipeline --------------------------------------------------------------------------------------


def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "pii", "mixing", "packing"]
    columns, before = docs.columns, docs
    for name, work in corpus_pipeline.STAGES[:4]:
        after = work(spark, before, SMALL).cache()
        assert after.columns == columns and 0 < after.count() <= before.count()
        if name == "near_dedup":
            texts = {r.doc_id: r.text for r in before.collect()}
            want = plain_components(sets_of(texts, 5), 80)
            assert {r.doc_id for r in after.collect()} == {i for i, c in want.items() if c == i}
        if name == "pii":
            assert after.filter("n_chars <> length(text)").count() == 0
        before = after
    pieces = corpus_pipeline.packing(spark, before, SMALL).collect()
    assert {r.doc_id for r in pieces} == {r.doc_id for r in before.collect()}
    assert len(pieces) == corpus_pipeline.run(spark, SMALL).count()


def test_pipeline_on_empty_and_odd_tables(spark):
    docs = docs_of(spark, TEXTS).select("doc_id", "text", "lang", "source", "n_chars")
    odd = docs.unionByName(docs.withColumn("doc_id", F.lit(None).cast("long")))
    for frame in (odd, docs.limit(0)):
        for _, work in corpus_pipeline.STAGES:
            out = work(spark, frame, SMALL)
            out.collect()


#: Names that the stages use for columns of their own.
HELPERS = [
    "_pii", "pii", "_hits0", "_gaps0", "_weight", "_wanted", "_probability", "_kept", "_repeats", "_topic", "_words", "_source", "_lang",
    "id", "component", "carried", "_", "first", "n", "row", "words", "piece", "n_words", "_key",
]


def test_stages_keep_columns_of_any_name_and_do_not_depend_on_order(spark):
    base = spark.read.parquet(f"{SMALL}/documents.parquet").limit(80)
    text = F.concat("text", F.lit(" mail a@b.example.com now"))
    docs = base.withColumn("text", F.when(F.col("doc_id") % 3 == 0, text).otherwise(F.col("text")))
    # Rows that share an id but not a text.
    docs = docs.unionByName(docs.filter("doc_id % 5 = 0").withColumn("text", F.concat(F.lit("another text of some words "), "text"))).cache()
    wide = docs.select("*", *[F.concat(F.lit(f"{name} "), "doc_id").alias(name) for name in HELPERS]).cache()
    for name, work in corpus_pipeline.STAGES:
        plain, carried, turned = work(spark, docs, SMALL), work(spark, wide, SMALL), work(spark, docs.orderBy(F.desc("text")).repartition(5), SMALL)
        want = sorted(map(repr, plain.collect()))
        assert sorted(map(repr, carried.select(plain.columns).collect())) == want, name
        assert sorted(map(repr, turned.collect())) == want or name == "packing"
        if name != "packing":
            assert carried.columns == wide.columns
            for r in carried.collect():
                assert all(r[h] == f"{h} {r.doc_id}" for h in HELPERS)


def test_operators_keep_columns_of_any_name(spark):
    from tablemint.llm import pii

    docs = docs_of(spark, [*TEXTS, "mail a@b.example.com"])
    wide = docs.select("*", *[F.concat(F.lit(f"{name} "), "doc_id").alias(name) for name in HELPERS])
    for work, made in ((pii.with_spans, {"pii"}), (mixing.mix, {"_source", "_lang", "_topic", "_words", "_weight", "_probability", "_kept", "_repeats"})):
        plain, carried = work(docs), work(wide)
        # Sums of doubles depend on their order in the last digits.
        exact = [F.round(c, 9).alias(c) if c in ("_weight", "_probability") else c for c in plain.columns]
        assert sorted(map(repr, carried.select(exact).collect())) == sorted(map(repr, plain.select(exact).collect()))
        assert set(carried.columns) == set(wide.columns) | made
        for r in carried.collect():
            assert all(r[h] == f"{h} {r.doc_id}" for h in set(HELPERS) - made)
