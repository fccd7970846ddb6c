"""Repair of conversations: the cheapest edits that make the turns alternate.

Turns are rows of a conversation in the order of ``turn``.  Edits keep a row, give it another role,
delete it, or insert an empty turn, so that the roles spell ``(s?(ua)+)?``: perhaps one system turn,
then user and assistant in turn.

The rows are aligned to every feasible length of that string by Wagner and Fischer's recurrence.  All
target strings end alike, so the tables of all lengths share their cells when they are filled from the
end; the first audit found bounds the cost (the incumbent), and Ukkonen bands leave out cells whose rows
and targets differ by more than that cost allows.  The lengths of least cost are traced back, at each
step by the letter that comes first, and the audits compared.  A conversation of more than
``ALIGN_ROWS`` rows would need a table that grows with its square; there the tables collapse to the
four states of the grammar, which gives the same audit.

A conversation's rows come to one task, which reads them in order and holds a code of one byte a row.
Texts are held only while they are shorter than ``HELD_BYTES``; the repaired texts of longer ones are
written by a second pass that streams rows beside their finished audit.

Defined cases: a null role or text is one space, as is a null id or turn in a checksum; a null id is a
conversation of its own; turns sort with nulls first, and rows of one turn by role and text; equal rows
are duplicates of the first; an empty role fits nowhere and needs a new one; a role counts by its first
letter; an empty table gives an empty result; only the named columns are read, whatever others are
called.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import query, small_batches, table

#: Costs of the edits; an undeleted truncated row adds ``REROLE`` as well.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3

ALIGN_ROWS = 2_000
HELD_BYTES = 32 << 20

#: White space of a blank text.
_SPACE = " \t\n\v\f\r"
_LARGEST = 2**63 - 1
_NAMES = {"s": "system", "u": "user", "a": "assistant"}


# --- alignment of one conversation ------------------------------------------------------------------
#
# A row's code is "d" when it must be deleted, else the initial of its role ("x" for any other), in
# upper case when its text is truncated.


def _extra(code: str) -> int:
    return TRUNCATED if code.isupper() else 0


def incumbent(codes: str) -> int:
    """Cost of a first repair: insert a turn wherever the next row is not the one expected."""
    cost, state = 0, ""
    for code in codes:
        if code == "d":
            cost += DELETE
            continue
        low = code.lower()
        cost += _extra(code)
        if low == "s" and state == "":
            state = "s"
        elif low in "ua":
            want = "a" if state == "u" else "u"
            cost += 0 if low == want else INSERT
            state = low
        else:
            cost += REROLE
            state = "a" if state == "u" else "u"
    return cost + {"": 0, "a": 0, "u": INSERT, "s": 2 * INSERT}[state]


def aligned(codes: str) -> tuple[int, str]:
    """Least cost and the least of its audits, over all lengths of the alternating string."""
    n = len(codes)
    bound = incumbent(codes)
    left = np.zeros(n + 1, int)  # rows from i on that may stay
    for i in range(n - 1, -1, -1):
        left[i] = left[i + 1] + (codes[i] != "d")
    slack = bound - DELETE * (n - left[0])
    low = np.maximum(left - slack // DELETE, 0)
    high = left + slack // INSERT
    width = int((high - low).max()) + 1
    far = bound + 1
    # cost[i][r - low[i]]: rows from i on against the last r letters of the string.
    cost = np.full((n + 1, width), far)
    cost[n, : high[n] + 1] = INSERT * np.arange(high[n] + 1)

    def row(i: int, lo: int, hi: int) -> np.ndarray:
        """Costs of row i for r in lo..hi; cells outside the band are too dear."""
        out = np.full(hi - lo + 1, far)
        a, b = max(lo, int(low[i])), min(hi, int(high[i]))
        if a <= b:
            out[a - lo : b - lo + 1] = cost[i, a - low[i] : b - low[i] + 1]
        return out

    for i in range(n - 1, -1, -1):
        lo, hi = int(low[i]), int(high[i])
        best = row(i + 1, lo, hi) + DELETE
        if codes[i] != "d":
            r = np.arange(lo, hi + 1)
            letter = np.where(r % 2 == 1, "a", "u")
            use = row(i + 1, lo - 1, hi - 1) + _extra(codes[i]) + np.where(letter == codes[i].lower(), 0, REROLE)
            best = np.minimum(best, np.where(r > 0, use, far))
        steps = INSERT * np.arange(hi - lo + 1)
        cost[i, : hi - lo + 1] = np.minimum(np.minimum.accumulate(best - steps) + steps, far)

    def at(i: int, r: int) -> int:
        return int(cost[i, r - low[i]]) if low[i] <= r <= high[i] else far

    # Starts of the strings of each length: without a system turn, or behind one that is kept.
    starts = [(at(0, r), "", 0, r) for r in range(int(high[0]) + 1) if r % 2 == 0]
    for i, code in enumerate(codes):
        if code in "sS":
            before = DELETE * i + _extra(code)
            starts += [(before + at(i + 1, r), "D" * i + "K", i + 1, r) for r in range(2, int(high[i + 1]) + 1, 2)]
    least = min(s[0] for s in starts)
    return least, min(p + _traced(codes, at, i, r) for c, p, i, r in starts if c == least)


def _traced(codes: str, at, i: int, r: int) -> str:
    """The least audit on a cheapest path from a cell: at each step the first letter that stays on one."""
    audit = []
    while i < len(codes) or r:
        here = at(i, r)
        if i < len(codes) and at(i + 1, r) + DELETE == here:
            audit.append("D")
            i += 1
        elif r and at(i, r - 1) + INSERT == here:
            audit.append("I")
            r -= 1
        else:
            audit.append("K" if codes[i].lower() == ("a" if r % 2 else "u") else "R")
            i, r = i + 1, r - 1
    return "".join(audit)


#: States of the grammar: nothing yet, after the system turn, after a user turn, after an assistant turn.
_NEXT = {0: ("u", 2), 1: ("u", 2), 2: ("a", 3), 3: ("u", 2)}


def collapsed(codes: str) -> tuple[int, str]:
    """As ``aligned``, for all lengths at once in space that grows with the rows: four cells a row."""
    never = 1 << 60
    after = [0, never, never, 0]
    after[2] = INSERT
    after[1] = INSERT + after[2]
    choices = bytearray(4 * len(codes))
    # The end: from each state, inserts only.
    for i in range(len(codes) - 1, -1, -1):
        code, low = codes[i], codes[i].lower()
        extra = _extra(code)
        now, letters = [0] * 4, [""] * 4
        for q, (letter, to) in _NEXT.items():
            options = [(after[q] + DELETE, "D")]
            if code != "d":
                keeps = low == letter
                options.append((after[to] + extra + (0 if keeps else REROLE), "K" if keeps else "R"))
                if q == 0 and low == "s":
                    options.append((after[1] + extra, "K"))
            now[q], letters[q] = min(options)
        # Inserting comes before keeping but after deleting, so a tie goes to it only against K and R.
        for q in (2, 3, 2, 1, 0):
            other = now[_NEXT[q][1]] + INSERT
            if other < now[q] or (other == now[q] and letters[q] > "I"):
                now[q], letters[q] = other, "I"
        after = now
        choices[4 * i : 4 * i + 4] = "".join(letters).encode()
    cost, audit, q, i = after[0], [], 0, 0
    while i < len(codes):
        letter = chr(choices[4 * i + q])
        audit.append(letter)
        if letter == "I":
            q = _NEXT[q][1]
            continue
        if letter != "D":
            q = 1 if letter == "K" and q == 0 and codes[i].lower() == "s" else _NEXT[q][1]
        i += 1
    return cost, "".join(audit) + {0: "", 1: "II", 2: "I", 3: ""}[q]


@lru_cache(maxsize=50_000)
def _audit_of_short(codes: str) -> tuple[int, str]:
    return aligned(codes)


def audit_of(codes: str) -> tuple[int, str]:
    """Cost and audit of a conversation's codes."""
    if len(codes) <= 64:
        return _audit_of_short(codes)
    return aligned(codes) if len(codes) <= ALIGN_ROWS else collapsed(codes)


class Edits:
    """Applies an audit to rows as they come: the repaired turns, without holding any."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, ""

    def _letter(self, kept: str = "") -> str:
        self.state = kept or ("a" if self.state == "u" else "u")
        return self.state

    def inserts(self) -> Iterator[tuple[str, str, str]]:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            yield "I", _NAMES[self._letter()], ""

    def take(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """The turns that stand for the next row: (edit, role, text)."""
        yield from self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self._letter(role[:1])
            yield edit, role, text
        elif edit == "R":
            yield edit, _NAMES[self._letter()], text


# --- whole tables -------------------------------------------------------------------------------------


def turns_of(rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The columns that repair reads, under its own names: conv, turn, role, text and whether the row is there."""
    space = F.lit(" ")
    return rows.select(
        F.col(key).alias("conv"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role).cast("string"), space).alias("role"),
        F.coalesce(F.col(text).cast("string"), space).alias("text"),
        F.lit(True).alias("there"),
    )


def damaged(turns: DataFrame) -> DataFrame:
    """Turns with a fault in a quarter of them, by a checksum of id and turn."""
    named = F.concat_ws(
        ":", F.coalesce(F.col("conv").cast("string"), F.lit(" ")), F.coalesce(F.col("turn").cast("string"), F.lit(" "))
    )
    kind = F.crc32(named) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return turns.select(
        "conv",
        "turn",
        F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(kind == 0, "").otherwise(text).alias("text"),
        (F.col("there") & (kind != 0)).alias("there"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    ).drop("_copy")


class _Conversation:
    """What is known of a conversation while its rows pass."""

    def __init__(self, conv):
        self.conv = conv
        self.codes: list[str] = []
        self.seen: set[bytes] = set()
        self.rows: list[tuple[str, str]] | None = []
        self.bytes = 0
        self.first = self.last = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.before: str | None = None

    def add(self, turn: int | None, role: str, text: str) -> None:
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last = turn
            self.turns += 1
        initial = role[:1]
        self.illegal += self.before is not None and self.before + initial not in ("su", "ua", "au")
        self.before = initial
        body = text.rstrip(_SPACE)
        mark = hashlib.blake2b(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass"), digest_size=16).digest()
        code = initial if initial and initial in "sua" else "x"
        if not body:
            self.blank += 1
            code = "d"
        elif mark in self.seen:
            self.duplicate += 1
            code = "d"
        elif body[-1] not in ".!?":
            self.truncated += 1
            code = code.upper()
        self.seen.add(mark)
        self.codes.append(code)
        self.bytes += len(role) + len(text) + 200
        if self.rows is not None:
            self.rows.append((role, text))
            if self.bytes > HELD_BYTES:
                self.rows = None

    def result(self) -> dict:
        cost, audit = audit_of("".join(self.codes))
        gaps = 0 if self.first is None else min(self.last - self.first + 1 - self.turns, _LARGEST)
        out = {
            "conv": self.conv, "gaps": gaps, "blank": self.blank, "duplicate": self.duplicate,
            "truncated": self.truncated, "illegal": self.illegal, "cost": cost, "audit": audit, "repaired_sha256": None,
        }
        if self.rows is not None:
            digest = _Digest(audit)
            for role, text in self.rows:
                digest.take(role, text)
            out["repaired_sha256"] = digest.finish()
        return out


class _Digest:
    """Hash of the repaired turns as lines ``role:text``."""

    def __init__(self, audit: str):
        self.edits, self.hash, self.between = Edits(audit), hashlib.sha256(), b""

    def _add(self, turns) -> None:
        for _, role, text in turns:
            self.hash.update(self.between + f"{role}:{text}".encode("utf-8", "surrogatepass"))
            self.between = b"\n"

    def take(self, role: str, text: str) -> None:
        self._add(self.edits.take(role, text))

    def finish(self) -> str:
        self._add(self.edits.inserts())
        return self.hash.hexdigest()


FIGURES = (
    "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
)


def audits(turns: DataFrame) -> DataFrame:
    """One row per conversation: its faults, the cost and letters of its edits, the hash of the result."""
    small_batches(turns.sparkSession)
    kind = turns.schema["conv"].dataType.simpleString()
    schema = f"conv {kind}, {FIGURES}"
    ordered = turns.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, types = None, None
        for batch in batches:
            types = types or batch.schema.field("conv").type
            done = []
            for conv, turn, role, text, there in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if current is None or current.conv != conv:
                    if current is not None:
                        done.append(current.result())
                    current = _Conversation(conv)
                if there:
                    current.add(turn, role, text)
            if done:
                yield _batch(done, types)
        if current is not None:
            yield _batch([current.result()], types)

    found = stage(ordered.mapInArrow(work, schema), "audits")
    long = found.filter("repaired_sha256 is null")
    if long.isEmpty():
        return found
    hashes = _streamed(turns, long).mapInArrow(_hashes, f"conv {kind}, hash string")
    joined = long.join(hashes.withColumnRenamed("conv", "_conv"), F.col("conv").eqNullSafe(F.col("_conv")))
    filled = joined.withColumn("repaired_sha256", F.col("hash")).select(*found.columns)
    return found.filter("repaired_sha256 is not null").union(filled)


def _batch(rows: list[dict], conv: pa.DataType) -> pa.RecordBatch:
    types = [conv] + [pa.int64()] * 6 + [pa.string()] * 2
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in zip(rows[0], types)], list(rows[0]))


def _streamed(turns: DataFrame, audited: DataFrame) -> DataFrame:
    """Rows of the audited conversations in order, each conversation led by its audit."""
    lead = audited.select("conv", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.col("audit").alias("text"), F.lit(True).alias("lead"))
    named = audited.select(F.col("conv").alias("_conv"))
    rows = turns.filter("there").join(named, F.col("conv").eqNullSafe(F.col("_conv")), "left_semi")
    rows = rows.select("conv", "turn", "role", "text", F.lit(False).alias("lead"))
    return lead.union(rows).repartition("conv").sortWithinPartitions("conv", F.desc("lead"), "turn", "role", "text")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4)), [batch.schema.field("conv").type] * len(batch))


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    digest, of, kind = None, None, None

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([of], kind), pa.array([digest.finish()])], ["conv", "hash"])

    for conv, role, text, lead, kind in _read(batches):
        if lead:
            if digest is not None:
                yield out()
            digest, of = _Digest(text), conv
        else:
            digest.take(role, text)
    if digest is not None:
        yield out()


def repaired(turns: DataFrame, audited: DataFrame) -> DataFrame:
    """The repaired turns: conv, position from 0, edit (K, R or I), role and text."""
    kind = turns.schema["conv"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edits, of, types, held, position = None, None, None, [], 0

        def take(found) -> None:
            nonlocal position
            for edit, role, text in found:
                held.append((of, position, edit, role, text))
                position += 1

        def out() -> pa.RecordBatch:
            kinds = [types, pa.int64(), pa.string(), pa.string(), pa.string()]
            columns = [pa.array([h[i] for h in held], k) for i, k in enumerate(kinds)]
            held.clear()
            return pa.RecordBatch.from_arrays(columns, ["conv", "position", "edit", "role", "text"])

        for conv, role, text, lead, types in _read(batches):
            if lead:
                if edits is not None:
                    take(edits.inserts())
                edits, of, position = Edits(text), conv, 0
            else:
                take(edits.take(role, text))
            if len(held) >= 1_000:
                yield out()
        if edits is not None:
            take(edits.inserts())
        if held:
            yield out()

    return _streamed(turns, audited).mapInArrow(work, f"conv {kind}, position long, edit string, role string, text string")


@query("op13_conversations")
def op13_conversations(spark, sf_dir):
    turns = damaged(turns_of(table(spark, sf_dir, "conversations")))
    return audits(turns).withColumnRenamed("conv", "conv_id")
