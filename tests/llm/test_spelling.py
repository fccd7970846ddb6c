"""Spelling variants against edit distance over all pairs."""

import random
import re
import zlib
from collections import Counter

import pytest

from tablemint.llm import spelling
from tablemint.llm.spelling import damaged, lead_of, near_pairs, roots, runs_of, spelling_groups, vocabulary


def one_edit(a, b):
    """Exactly one inserted, deleted or replaced code point, by trying each."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_words(rows):
    out = Counter()
    upper = {c: c + 32 for c in range(65, 91)}
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = run.translate(upper)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{low}".encode())
            out[low[: h % len(low)] + low[h % len(low) + 1 :] if h % 97 == 0 else low] += 1
    return {w: n for w, n in out.items() if len(w) >= 5 and n >= 3}


def plain_groups(words):
    near = {w: [x for x in words if one_edit(w, x)] for w in words}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = {}
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None)
    return out


def docs_of(spark, rows):
    """Documents with extra columns named like the operator's own."""
    return spark.createDataFrame(
        [(i, t, "w", 1, "k") for i, t in rows], "doc_id long, text string, word string, n int, key string"
    )


def words_of(spark, words):
    return spark.createDataFrame(sorted(words.items()), "word string, n long")


def varied(rng, base):
    """A word one or two random edits away."""
    letters = "abcéÀ÷×xyz"
    for _ in range(rng.randint(1, 2)):
        i = rng.randrange(len(base) + 1)
        kind = rng.randrange(3)
        if kind == 0:
            base = base[:i] + rng.choice(letters) + base[i:]
        elif kind == 1:
            base = base[:i] + base[i + 1 :]
        else:
            base = base[:i] + rng.choice(letters) + base[i + 1 :]
    return base


def vocabulary_of(rng, size, stems):
    found = {}
    bases = ["".join(rng.choice("abcé") for _ in range(rng.randint(5, 14))) for _ in range(stems)]
    while len(found) < size:
        word = varied(rng, rng.choice(bases))
        if len(word) >= 5:
            found[word] = rng.randint(3, 400)
    return found


@pytest.mark.parametrize("limit, rows", [(2_048, 128), (4, 128), (7, 8)])
def test_near_pairs_match_all_pairs(spark, monkeypatch, limit, rows):
    monkeypatch.setattr(spelling, "TILE_WORDS", limit)
    monkeypatch.setattr(spelling, "ROWS", rows)
    words = vocabulary_of(random.Random(limit), 700, 25)
    words |= {"a" * k: k for k in range(5, 40)} | {"ab" * k: 3 for k in range(3, 12)}
    got = [tuple(r) for r in near_pairs(words_of(spark, words)).collect()]
    assert len(got) == len(set(got))
    want = {(a, words[a], b, words[b]) for a in words for b in words if one_edit(a, b)}
    assert set(got) == want and len(want) > 500


def test_long_words_are_compared_whole(spark):
    base = "".join(random.Random(3).choice("abcd") for _ in range(3_000))
    words = {base: 9, base[:-1]: 8, base[1:]: 7, base[:1_500] + "x" + base[1_501:]: 6, base[:-2] + "zz": 5, base + "q": 4}
    got = {(r["word"], r["near"]) for r in near_pairs(words_of(spark, words)).collect()}
    assert got == {(a, b) for a in words for b in words if one_edit(a, b)}


def texts(rng):
    pool = list(vocabulary_of(rng, 250, 12)) + ["Straße", "naïve", "x" * 30, "the", "WORDS", "words", "wordz", "1wordq"]
    word = lambda: pool[int(len(pool) * rng.random() ** 4)]
    return [" ".join(word() + rng.choice(["", ",", "1", "\n"]) for _ in range(rng.randint(0, 120))) for _ in range(150)]


def test_groups_match_plain_code(spark):
    rng = random.Random(8)
    rows = list(enumerate(texts(rng))) + [(900, None), (901, ""), (None, "words words words naïve"), (None, None)]
    rows += [(902, "letters " * 200_000)] + [(903, "copied copied"), (903, "copied copied")]
    rng.shuffle(rows)
    got = {r["word"]: tuple(r)[1:] for r in spelling_groups(docs_of(spark, rows)).collect()}
    want = plain_groups(plain_words(rows))
    assert got == want
    assert sum(v[0] is not None for v in want.values()) > 20


def test_every_word_damaged(spark):
    rows = list(enumerate(["longer words stand here and there"] * 40))
    got = {r["word"]: r["n"] for r in vocabulary(docs_of(spark, rows), damage=1).collect()}
    want = Counter()
    for doc_id, text in rows:
        for run in text.split():
            want[damaged(lead_of(str(doc_id)), run, 1)] += 1
    assert got == {w: n for w, n in want.items() if len(w) >= 5 and n >= 3}


def test_roots_follow_long_chains(spark):
    """A chain of words, each twice as frequent as the one before."""
    chain = ["a" * k for k in range(5, 36)]
    rows = [(w, 3 * 2**i, chain[i + 1] if i + 1 < len(chain) else None) for i, w in enumerate(chain)]
    formed = spark.createDataFrame(rows, "word string, n long, form string")
    got = {r["word"]: r["root"] for r in roots(formed).collect()}
    assert got == {w: chain[-1] for w in chain[:-1]}


def test_slices_cut_no_run(monkeypatch):
    text = "alpha Beta gämma1delta " * 50 + "z" * 40
    want = runs_of(text)
    assert want == {"alpha": 50, "gämma": 50, "delta": 50, "z" * 40: 1}
    for size in (1, 2, 3, 7, 64):
        monkeypatch.setattr(spelling, "SLICE", size)
        assert runs_of(text) == want


def test_empty_table(spark):
    assert spelling_groups(docs_of(spark, [])).collect() == []
