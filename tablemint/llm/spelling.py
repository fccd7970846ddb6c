"""Spelling variants: words one edit apart, and the more frequent form that each leads to.

Two words are one edit apart when their common prefix and common suffix together reach the longer
length minus one.  The test is taken over tiles: blocks of words as padded matrices of code points,
each pair of rows compared at once.

Which blocks meet follows from the same sum.  With a longer length L, prefix or suffix has at least
L // 2 code points; in the rest of t = L - L // 2 the same holds again, so prefix or suffix of the rest
has t // 2.  So two near words share three quarters of their code points in one of four ways, and every
word is posted under these keys, for L its own length and one more.  Words of one key lie side by side
and are compared; a pair counts under the first of the four keys it shares, so it is found once.  A key
with more than ``TILE_WORDS`` words is split into blocks, and each pair of blocks is a tile of its own
in another task.

Defined cases: a null text has no words; a null document id is written as nothing; texts of any length
are read whole, in slices; repeated rows count again; an empty table gives an empty result; only the
named columns are read, whatever others are called.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import query, small_batches, table

LEAST_LENGTH = 5
LEAST_COUNT = 3
#: One in so many (document, word) pairs is damaged.
DAMAGE = 97

#: Words of one key in a tile, rows compared at once, code points of a slice, and words a task holds.
TILE_WORDS = 2_048
ROWS = 128
SLICE = 1 << 20
HELD = 400_000
#: Code points a matrix holds; pairs of longer words are compared one by one.
WIDTH = 128

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LONG_RUN = re.compile(f"[A-Za-zÀ-ÿ]{{{LEAST_LENGTH},}}")
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def runs_of(text: str) -> dict[str, int]:
    """Runs of letters that are long enough, with A-Z lower-cased, and how often each occurs.

    Damage only shortens a run, so shorter ones give no word.
    """
    found: Counter = Counter()
    start = 0
    while start < len(text):
        end = start + SLICE
        while end < len(text) and _RUN.match(text, end - 1, end + 1) and _RUN.match(text, end, end + 1):
            end += 1  # a run is not cut
        found.update(_LONG_RUN.findall(text[start:end]))
        start = end
    lowered: dict[str, int] = {}
    for run, n in found.items():
        if not run.islower():
            run = run.lower() if run.isascii() else run.translate(_LOWER)
        lowered[run] = lowered.get(run, 0) + n
    return lowered


def lead_of(doc_id: str) -> int:
    """Checksum of what stands before each run of a document."""
    return zlib.crc32(f"{doc_id}:".encode("utf-8", "surrogatepass"))


def damaged(lead: int, run: str, damage: int = DAMAGE) -> str:
    """The run, or the run less one code point where the checksum of document and run says so."""
    h = zlib.crc32(run.encode("utf-8", "surrogatepass"), lead)
    if h % damage:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def vocabulary(docs: DataFrame, key: str = "doc_id", text: str = "text", damage: int = DAMAGE) -> DataFrame:
    """(word, n) of all words long and frequent enough, counted in tasks before the shuffle."""
    small_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}

        def flush() -> pa.RecordBatch:
            kept = {word: n for word, n in held.items() if len(word) >= LEAST_LENGTH}
            words, counts = list(kept.keys()), list(kept.values())
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), pa.array(counts, pa.int64())], ["word", "n"]
            )

        for batch in batches:
            for doc_id, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                lead = lead_of("" if doc_id is None else doc_id)
                for run, n in runs_of(content or "").items():
                    word = damaged(lead, run, damage)
                    held[word] = held.get(word, 0) + n
                if len(held) >= HELD:
                    yield flush()
        yield flush()

    rows = docs.select(F.col(key).cast("string"), F.col(text).cast("string"))
    counted = rows.mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def postings(words: DataFrame) -> DataFrame:
    """Eight rows a word: its four keys as the longer word of a pair, and as the shorter one."""
    word, size = F.col("word"), F.length("word")

    def keys(longer: Column) -> list[Column]:
        half = F.floor(longer / 2).cast("int")
        quarter = F.floor((longer - half) / 2).cast("int")
        parts = [
            (F.left(word, half + quarter), F.lit("")),
            (F.left(word, half), F.right(word, quarter)),
            (F.left(word, quarter), F.right(word, half)),
            (F.lit(""), F.right(word, half + quarter)),
        ]
        return [
            F.struct(
                longer.alias("longer"),
                F.lit(way).alias("way"),
                F.concat_ws(" ", longer.cast("string"), F.lit(way).cast("string"), first, last).alias("key"),
            )
            for way, (first, last) in enumerate(parts)
        ]

    return words.select("word", "n", F.explode(F.array(*keys(size), *keys(size + 1))).alias("post")).select(
        "post.*", "word", "n"
    )


def tiles(posted: DataFrame, limit: int | None = None) -> DataFrame:
    """Postings with their tile, and the block of the word in it.

    Keys of at most ``limit`` words are one tile.  The words of a larger key are dealt to blocks of about
    that many by a hash, and sent to every tile of their block with another one or with itself.
    """
    limit = limit or TILE_WORDS
    counted = posted.groupBy("key").agg(F.count("*").alias("m")).filter(F.col("m") > limit)
    large = stage(counted.select("key", F.ceil(F.col("m") / limit).cast("int").alias("blocks")), "large-keys")
    one = F.lit(0).alias("block"), F.lit(True).alias("inside"), F.col("key").alias("tile")
    if large.isEmpty():
        return posted.select("longer", "way", "word", "n", *one)
    small = posted.join(large, "key", "left_anti").select("longer", "way", "word", "n", *one)
    block = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    dealt = posted.join(large, "key").withColumn("block", block)
    spread = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("block", "other").cast("string"), F.greatest("block", "other").cast("string")
    split = spread.select(
        "longer", "way", "word", "n", "block", (F.col("block") == F.col("other")).alias("inside"),
        F.concat_ws(" ", "key", low, high).alias("tile"),
    )
    # In a tile of a block with itself all pairs count; in one of two blocks those between them.
    return small.union(split)


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n): every two words one edit apart, in both directions, once each."""
    placed = tiles(postings(words)).repartition("tile").sortWithinPartitions("tile", "word")
    return placed.mapInArrow(_compare, "word string, n long, near string, near_n long")


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compare rows of one tile, which lie side by side, block by block."""
    names = ["word", "n", "near", "near_n"]
    open_blocks: list[_Rows] = []  # earlier blocks that end in the tile which is still open
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        rest.append(batch)
        if sum(b.num_rows for b in rest) < ROWS:
            continue
        joined = pa.Table.from_batches(rest).combine_chunks()
        whole = joined.num_rows // ROWS * ROWS
        rest = joined.slice(whole).to_batches()
        for start in range(0, whole, ROWS):
            yield _meet(joined.slice(start, ROWS), open_blocks, names)
    if rest:
        yield _meet(pa.Table.from_batches(rest).combine_chunks(), open_blocks, names)


class _Rows:
    """A block of words as a padded matrix of code points."""

    def __init__(self, table: pa.Table):
        self.words = np.array(table["word"].to_pylist(), dtype=object)
        self.n = table["n"].to_numpy()
        self.tiles = np.array(table["tile"].to_pylist(), dtype=object)
        self.ids = np.cumsum(np.r_[0, self.tiles[1:] != self.tiles[:-1]])
        self.block, self.inside = table["block"].to_numpy(), table["inside"].to_numpy(zero_copy_only=False)
        self.longer, self.way = table["longer"].to_numpy(), table["way"].to_numpy()
        self.size = np.array([len(w) for w in self.words])
        self.codes = _matrix(self.words)
        self.back = _matrix([w[: -WIDTH - 1 : -1] for w in self.words])


def _matrix(words) -> np.ndarray:
    """Code points, a word to a column, padded with zeros; in bytes where all are small enough."""
    width = min(max(map(len, words)), WIDTH)
    codes = np.array([w[:width] for w in words], f"U{width}").view(np.uint32).reshape(-1, width).T
    return np.ascontiguousarray(codes.astype(np.uint8) if codes.max() < 256 else codes)


def _common(a: np.ndarray, b: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Length of the common prefix of words of one matrix with words of another, for the pairs marked.

    Marked pairs differ, so they stop being alike before both have ended and only padding is left.
    """
    alive = among.copy()
    length = np.zeros(among.shape, np.int32)
    for one, other in zip(a, b):
        alive &= one[:, None] == other[None, :]
        if not alive.any():
            break
        length += alive
    return length


def _meet(table: pa.Table, open_blocks: list[_Rows], names: list[str]) -> pa.RecordBatch:
    """Near pairs of a block with itself and with the earlier blocks of its first tile."""
    rows = _Rows(table)
    found: list[tuple] = []
    if open_blocks and open_blocks[-1].tiles[-1] != rows.tiles[0]:
        open_blocks.clear()
    for earlier in open_blocks:
        _near(earlier, rows, earlier.tiles[:, None] == rows.tiles[None, :], found)
    _near(rows, rows, np.triu(rows.ids[:, None] == rows.ids[None, :], 1), found)
    if rows.tiles[0] != rows.tiles[-1]:
        open_blocks.clear()
    open_blocks.append(rows)
    columns = [np.concatenate([f[i] for f in found]) if found else [] for i in range(4)]
    types = [pa.string(), pa.int64(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def _near(a: _Rows, b: _Rows, together: np.ndarray, found: list[tuple]) -> None:
    """Pairs of a tile where prefix and suffix reach the longer length minus one."""
    longer = np.maximum(a.size[:, None], b.size[None, :])
    together = together & (longer == a.longer[:, None]) & (np.abs(a.size[:, None] - b.size[None, :]) <= 1)
    together &= (a.block[:, None] != b.block[None, :]) | a.inside[:, None]
    if not together.any():
        return
    prefix, suffix = _common(a.codes, b.codes, together), _common(a.back, b.back, together)
    for i, j in zip(*np.nonzero(together & (longer > WIDTH))):
        first, second = a.words[i], b.words[j]
        prefix[i, j] = len(commonprefix([first, second]))
        suffix[i, j] = len(commonprefix([first[::-1], second[::-1]]))
    near = together & (prefix + suffix >= longer - 1)
    half = longer // 2
    quarter = (longer - half) // 2
    shares = [prefix >= half + quarter, (prefix >= half) & (suffix >= quarter), (suffix >= half) & (prefix >= quarter)]
    first = np.select(shares, [0, 1, 2], 3)
    i, j = np.nonzero(near & (first == a.way[:, None]))
    if len(i):
        found.append((a.words[i], a.n[i], b.words[j], b.n[j]))
        found.append((b.words[j], b.n[j], a.words[i], a.n[i]))


def forms(words: DataFrame, pairs: DataFrame) -> DataFrame:
    """Every word with its number of near words and its form: the most frequent of them, if twice as frequent.

    A word has at most a fixed number of words one edit away for its length, so no group is large.
    """
    best = pairs.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    )
    chosen = F.col("n_near").isNotNull() & (-F.col("best.less") >= 2 * F.col("n"))
    return words.join(best, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(chosen, F.col("best.near")).alias("form"),
        F.when(chosen, -F.col("best.less")).alias("form_n"),
    )


def roots(formed: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form, by following forms two, four, eight steps at once.

    Counts double along a chain, so chains have no more steps than the largest count has binary digits.
    A word that has reached a form without a form of its own takes no part in further joins.
    """
    ends = formed.filter("form is null").select(F.col("word").alias("root"), F.lit(True).alias("done"))
    links = formed.filter("form is not null").select("word", F.col("form").alias("root"))
    links = stage(
        links.join(ends, "root", "left").select("word", "root", F.coalesce("done", F.lit(False)).alias("done")), "forms"
    )
    while not links.filter("not done").isEmpty():
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("next"), F.col("done").alias("next_done"))
        moved = links.filter("not done").join(onward, "root").select("word", F.col("next"), F.col("next_done"))
        links = stage(links.filter("done").union(moved), "forms")
    return links.select("word", "root")


def spelling_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", damage: int = DAMAGE) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of the corpus that is long and frequent enough."""
    words = stage(vocabulary(docs, key, text, damage), "vocabulary")
    formed = stage(forms(words, near_pairs(words)), "near-words")
    ended = formed.join(roots(formed), "word", "left")
    return ended.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


OP12_SQL = r"""
WITH RECURSIVE bits AS (
  SELECT range AS i, list_reduce(list_prepend(range, range(8)),
           lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
  FROM range(256)),
steps AS (SELECT list(c ORDER BY i) AS t FROM bits),
runs AS (
  SELECT doc_id, translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) AS w FROM documents)
  GROUP BY ALL),
hexed AS (SELECT *, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x FROM runs),
hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(
           list_prepend(4294967295, list_transform(range(length(x) // 2),
             lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT)),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h
  FROM hexed, steps),
words AS (
  SELECT word, sum(n)::BIGINT AS n
  FROM (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2)
                    ELSE run END AS word, n FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
cuts AS (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS cut
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
pairs AS (
  SELECT a.word, a.n, b.word AS near, b.n AS near_n
  FROM cuts a JOIN cuts b ON a.cut = b.cut AND a.i = b.i AND a.word <> b.word AND length(a.word) = length(b.word)
  UNION SELECT a.word, a.n, b.word, b.n FROM cuts a JOIN words b ON a.cut = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM cuts a JOIN words b ON a.cut = b.word),
best AS (
  SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, encode(near)) AS form, max(near_n) AS form_n
  FROM pairs GROUP BY word),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near,
         CASE WHEN form_n >= 2 * w.n THEN form END AS form, CASE WHEN form_n >= 2 * w.n THEN form_n END AS form_n
  FROM words w LEFT JOIN best USING (word)),
walk AS (
  SELECT word, word AS root FROM formed WHERE form IS NULL
  UNION ALL SELECT f.word, w.root FROM formed f JOIN walk w ON f.form = w.word)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN walk USING (word)
"""


@query("op12_spelling", OP12_SQL)
def op12_spelling(spark, sf_dir):
    return spelling_groups(table(spark, sf_dir, "documents"))
