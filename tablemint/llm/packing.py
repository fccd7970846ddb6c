"""Packing documents into sequences of a fixed number of tokens.

Documents are tokenised, closed by an end id, and cut only when longer than a sequence.  The pieces
are dealt to groups by a hash of their key.  Inside a group, best fit places them longest first; then
a local search works on the sequences that are not full: it moves one piece, exchanges one for one or
two for one, whenever that increases the sum of squared fills, so that the emptiest sequences run
empty.  Sequences that are full enough are final.  The pieces of the others are dealt anew at a next
level, so that groups share what they could not fill, until one group remains.  The number of groups
follows the pieces that are left, so every group has about ``group_pieces`` of all lengths, whatever
the input.  When a level leaves over half of its pieces, as where lengths do not combine, its rest is
packed once more in as many groups, and all their sequences are final: a group then closes at most
about one sequence more than the lengths in it ask for.

Defined cases: a null or empty text is a document of one end id; equal rows are separate documents;
an empty table gives no pieces; only the key and text columns are read.
"""

from __future__ import annotations

import heapq
import os
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import query, small_batches, table

CAPACITY = 4096
END_ID = 1
#: Pieces a group holds on average, and words in each of the two generations of a worker's memory.
GROUP_PIECES = 5_000
MEMORY = 600_000
#: Texts that are tokenised together.
TEXTS = 500

_tokenizers: dict = {}


#: Punctuation at the end of a word, which becomes a word of its own.
_TAIL = re.compile(rb"[.,!?;:](?<=[a-z0-9].)[.,!?;:]*+(?=[\x20\x09-\x0d]|\Z)")
#: Stands between words that are encoded in one call; no word that is encoded so holds its start.
_BETWEEN = "<|endoftext|>"


class WordTokenizer:
    """Token ids of whole texts, each distinct word encoded once while it is remembered.

    For a vocabulary that lower-cases, drops white space and splits letters from punctuation, no token
    and no special token spans white space, so a text's ids are those of its words in turn, and white
    space before closing punctuation changes nothing.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.between = self.tokenizer.token_to_id(_BETWEEN)
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        # The byte-level alphabet: printable Latin-1 bytes are themselves, the others follow from 256 on.
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        others = [b for b in range(256) if b not in plain]
        self.names = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}
        self.direct = self._is_direct()
        self.packed = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]

    def __call__(self, texts: list[str | bytes | None]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        if len(self.known) > MEMORY:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        chunked, missing = [], set()
        for text in texts:
            raw = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text or b""
            # The strings of special tokens are met as they are written, so such texts keep their case.
            chunks = (raw if b"<|" in raw else _TAIL.sub(rb" \g<0>", raw.lower())).split()
            ids = list(map(known.get, chunks))
            if None in ids:
                missing.update(c for c, found in zip(chunks, ids) if found is None)
                chunked.append(chunks)
            else:
                chunked.append(b"".join(ids))
        unseen = []
        for chunk in missing:
            if chunk in older:
                known[chunk] = older[chunk]
            elif b"<|" in chunk:
                ids = self.tokenizer.encode(chunk.decode("utf-8", "replace"), add_special_tokens=False).ids
                known[chunk] = np.array(ids, "<u4").tobytes()
            else:
                unseen.append(chunk)
        for start in range(0, len(unseen), 2_000):
            self._learn(unseen[start : start + 2_000])
        return [c if isinstance(c, bytes) else b"".join(map(known.__getitem__, c)) for c in chunked]

    def _learn(self, words: list[bytes]) -> None:
        """Words of lower-case letters go to the model itself; all others through the whole tokeniser."""
        rest, model, packed = [], self.tokenizer.model, self.packed
        for word in words:
            text = word.decode("utf-8", "replace")
            if self.direct and text.isalpha() and text == text.lower() and unicodedata.is_normalized("NFC", text):
                name = text if text.isascii() else "".join(map(self.names.__getitem__, word))
                self.known[word] = b"".join([packed[t.id] for t in model.tokenize(name)])
            else:
                rest.append(word)
        if rest:
            self._learn_whole(rest)

    def _is_direct(self) -> bool:
        """Whether words of letters are one unit of the model, written by the byte-level alphabet."""
        words = "a the sentence tokenised überaus élève straße mañana ñandú ß œuvre łódź привет 日本".split()
        for word in words:
            name = "".join(map(self.names.__getitem__, word.encode()))
            want = self.tokenizer.encode(f"{word} {word}", add_special_tokens=False).ids
            if 2 * [t.id for t in self.tokenizer.model.tokenize(name)] != want:
                return False
        return True

    def _learn_whole(self, words: list[bytes]) -> None:
        joined = _BETWEEN.join(w.decode("utf-8", "replace") for w in words)
        ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, "<u4")
        cuts = 4 * np.flatnonzero(ids == self.between)
        packed = ids.tobytes()
        for word, start, stop in zip(words, [0, *(cuts + 4).tolist()], [*cuts.tolist(), len(packed)], strict=True):
            self.known[word] = packed[start:stop]


def _tokenizer(path: str) -> WordTokenizer:
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, row long"


def cut_pieces(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """One row per piece of every document.  ``row`` tells rows with equal keys apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
        encode = _tokenizer(tokenizer)
        end = np.array([END_ID], "<u4").tobytes()
        width = 4 * capacity
        for batch in batches:
            out: list[tuple] = []
            found = []
            for start in range(0, batch.num_rows, TEXTS):
                found += encode(batch.column(1).cast(pa.binary()).slice(start, TEXTS).to_pylist())
            for doc, ids, row in zip(batch.column(0), found, batch.column(2)):
                ids += end
                for piece, at in enumerate(range(0, len(ids), width)):
                    part = ids[at : at + width]
                    out.append((doc.as_py(), piece, at // 4, len(part) // 4, zlib.crc32(part), row.as_py()))
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("doc_id", "piece", "start", "length", "ids_crc32", "row"), r)) for r in out],
                schema=pa.schema(
                    [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                     ("length", pa.int64()), ("ids_crc32", pa.int64()), ("row", pa.int64())]
                ),
            )

    small_batches(docs.sparkSession)
    picked = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return picked.withColumn("row", F.monotonically_increasing_id()).mapInArrow(run, PIECES)


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Best fit, longest first.  Bins are kept by free space, so each placement scans free sizes only."""
    by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
    free_bits = 0  # bit f is set while a bin with f free tokens exists
    bins: list[list[int]] = []
    for i in sorted(range(len(lengths)), key=lambda j: (-lengths[j], j)):
        need = lengths[i]
        fitting = free_bits >> need
        if fitting:
            free = need + (fitting & -fitting).bit_length() - 1
            at = by_free[free].pop()
            if not by_free[free]:
                free_bits &= ~(1 << free)
        else:
            at, free = len(bins), capacity
            bins.append([])
        bins[at].append(i)
        left = free - need
        by_free[left].append(at)
        free_bits |= 1 << left
    return bins


def local_search(bins: list[list[int]], lengths: list[int], capacity: int, rounds: int = 30) -> list[list[int]]:
    """Move, one-for-one and two-for-one exchanges between underfull bins, while they help.

    A change is made when it raises the sum of squared fills, that is, when the fuller of two bins
    becomes fuller still.  Fills are integers and their squares are bounded, so this ends; ``rounds``
    bounds the passes, and a stopped search still leaves a valid packing.
    """
    # With as few bins as the tokens need, none can be emptied any more.
    fewest = -(-sum(lengths[i] for b in bins for i in b) // capacity)
    done = [b for b in bins if sum(lengths[i] for i in b) == capacity]
    open_bins = [b for b in bins if sum(lengths[i] for i in b) < capacity]
    for _ in range(rounds):
        if len(done) + len(open_bins) <= fewest:
            break
        open_bins.sort(key=lambda b: -sum(lengths[i] for i in b))
        changed = False
        # The emptiest bins give to the fullest, so that they run empty.
        for donor_at in range(len(open_bins) - 1, 0, -1):
            donor = open_bins[donor_at]
            for taker in open_bins[:donor_at]:
                if not donor:
                    break
                if taker:
                    changed |= _improve(taker, donor, lengths, capacity)
        done += [b for b in open_bins if b and sum(lengths[i] for i in b) == capacity]
        open_bins = [b for b in open_bins if b and sum(lengths[i] for i in b) < capacity]
        if not changed:
            break
    return done + open_bins


def _improve(taker: list[int], donor: list[int], lengths: list[int], capacity: int) -> bool:
    """Apply the best single change that fills ``taker`` further; False if there is none."""
    filled = sum(lengths[i] for i in taker)
    free = capacity - filled
    given = sum(lengths[i] for i in donor)
    best, change = 0, None
    for i in donor:  # move
        if best < lengths[i] <= free:
            best, change = lengths[i], ((i,), ())
    sizes = sorted((lengths[j], j) for j in taker)
    for i in donor:  # one for one
        for size, j in sizes:
            gain = lengths[i] - size
            if gain <= best:
                break
            if gain <= free:
                best, change = gain, ((i,), (j,))
                break
    if best < free:
        for a in range(len(donor)):  # two for one, either way round
            for b in range(a + 1, len(donor)):
                pair = lengths[donor[a]] + lengths[donor[b]]
                for size, j in sizes:
                    gain = pair - size
                    if gain <= best:
                        break
                    if gain <= free:
                        best, change = gain, ((donor[a], donor[b]), (j,))
                        break
        for a in range(len(sizes)):
            for b in range(a + 1, len(sizes)):
                pair = sizes[a][0] + sizes[b][0]
                for i in donor:
                    gain = lengths[i] - pair
                    if best < gain <= free:
                        best, change = gain, ((i,), (sizes[a][1], sizes[b][1]))
    if change is None or (filled + best) ** 2 + (given - best) ** 2 <= filled**2 + given**2:
        return False
    into, out = change
    for i in into:
        donor.remove(i)
    for j in out:
        taker.remove(j)
    taker += into
    donor += out
    return True


#: Bins the local search compares at once; it takes the least filled ones of a group.
SEARCH_BINS = 150


def pack_group(lengths: list[int], capacity: int) -> list[list[int]]:
    bins = best_fit(lengths, capacity)
    fill = [sum(lengths[i] for i in b) for b in bins]
    loose = heapq.nsmallest(SEARCH_BINS, range(len(bins)), key=lambda k: (fill[k], k))
    chosen = set(loose)
    searched = local_search([bins[k] for k in loose if fill[k] < capacity], lengths, capacity)
    return [b for k, b in enumerate(bins) if k not in chosen or fill[k] == capacity] + searched


PLACED = PIECES + ", sequence_id long, offset long"


def _placer(level: int, last: bool, capacity: int, full: float):
    """Packs one group; below the last level, sequences that are not full enough stay unplaced (-1)."""

    def place(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["doc_id", "row", "piece"], ignore_index=True)
        lengths = frame["length"].tolist()
        sequence = np.full(len(lengths), -1, np.int64)
        offset = np.zeros(len(lengths), np.int64)
        group = int(frame["grp"].iloc[0])
        for number, members in enumerate(pack_group(lengths, capacity)):
            if not last and sum(lengths[i] for i in members) < full * capacity:
                continue
            at = 0
            for i in members:
                # Levels, groups and the sequences of one group have ranges of their own.
                sequence[i] = (level << 58) + (group << 24) + number
                offset[i] = at
                at += lengths[i]
        frame["sequence_id"], frame["offset"] = sequence, offset
        return frame.drop(columns="grp")

    return place


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES, full: float = 0.995) -> DataFrame:
    """Place every piece: ``sequence_id`` and ``offset`` are added.

    ``full``: the share of a sequence from which on it is final at a level below the last.
    """
    level, placed, stalled = 0, [], False
    todo = stage(pieces, "pieces")
    total = todo.count()
    while True:
        groups = max(1, -(-total // group_pieces))
        last = groups == 1 or stalled
        dealt = todo.withColumn("grp", F.pmod(F.xxhash64("doc_id", "piece", "row", F.lit(level)), F.lit(groups)))

        result = stage(dealt.groupBy("grp").applyInPandas(_placer(level, last, capacity, full), PLACED), f"packed-{level}")
        placed.append(result.filter("sequence_id >= 0"))
        if last:
            break
        todo = result.filter("sequence_id < 0").select(*pieces.columns)
        level += 1
        rest = todo.count()
        stalled = rest > 0.5 * total
        total = rest
    out = placed[0]
    for more in placed[1:]:
        out = out.unionByName(more)
    return out


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op5_best_fit_packing")
def op5_best_fit_packing(spark, sf_dir):
    pieces = cut_pieces(table(spark, sf_dir, "documents"), default_tokenizer())
    return pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
