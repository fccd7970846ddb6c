"""Repair of conversations against plain search over all edit scripts."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tablemint.llm import conversations
from tablemint.llm.conversations import aligned, audit_of, audits, collapsed, damaged, incumbent, repaired, turns_of
from tablemint.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def searched(codes):
    """Least (cost, audit, roles) over all scripts with at most three inserts in a row."""
    best = None

    def go(i, cost, audit, roles, inserts):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        # No continuation can mend a string that is no prefix of the grammar.
        if not re.fullmatch(r"s?(ua)*u?", roles):
            return
        if i == len(codes) and re.fullmatch(r"(s?(ua)+)?", roles):
            best = min(best or (cost + 1,), (cost, audit, roles))
        if inserts < 3:
            for role in "ua":
                go(i, cost + 3, audit + "I", roles + role, inserts + 1)
        if i == len(codes):
            return
        code = codes[i]
        go(i + 1, cost + 4, audit + "D", roles, 0)
        if code != "d":
            extra = 3 if code.isupper() else 0
            if code.lower() != "x":
                go(i + 1, cost + extra, audit + "K", roles + code.lower(), 0)
            for role in "ua":
                go(i + 1, cost + extra + 3, audit + "R", roles + role, 0)

    go(0, 0, "", "", 0)
    return best


def test_audits_match_a_search_of_all_scripts():
    for length in range(5):
        for codes in map("".join, itertools.product("suaxdU", repeat=length)):
            cost, audit, _ = searched(codes)
            assert aligned(codes) == (cost, audit), codes
            assert collapsed(codes) == (cost, audit), codes
            assert incumbent(codes) >= cost
    rng = random.Random(4)
    for _ in range(150):
        codes = "".join(rng.choice("suaxdSUAX") for _ in range(rng.randint(5, 7)))
        cost, audit, _ = searched(codes)
        assert aligned(codes) == (cost, audit) == collapsed(codes), codes


def test_bands_and_collapsed_tables_agree_on_long_conversations():
    rng = random.Random(5)
    for length in (60, 200, 700):
        for faults in (0.05, 0.5):
            codes = "".join(
                rng.choice("suaxdSUAX") if rng.random() < faults else "ua"[i % 2] for i in range(length)
            )
            assert aligned(codes) == collapsed(codes)


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        named = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(named.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def plain_result(rows):
    """All figures of one conversation's damaged rows."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
    turns = {r[1] for r in rows} - {None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    codes, seen, counts = "", set(), {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, _, role, text in rows:
        code = role[0] if role[:1] in ("s", "u", "a") else "x"
        body = re.findall(r"[^\x20\x09-\x0D]", text)
        if not body:
            counts["blank"] += 1
            code = "d"
        elif (role, text) in seen:
            counts["duplicate"] += 1
            code = "d"
        elif body[-1] not in ".!?":
            counts["truncated"] += 1
            code = code.upper()
        seen.add((role, text))
        codes += code
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    cost, audit, roles = (0, "", "") if not rows else searched(codes)
    lines, left, given = [], list(rows), list(roles)
    for edit in audit:
        row = left.pop(0) if edit != "I" else None
        if edit != "D":
            role = {"u": "user", "a": "assistant", "s": "system"}[given.pop(0)]
            lines.append(f"{row[2]}:{row[3]}" if edit == "K" else f"{role}:{row[3] if row else ''}")
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return (gaps, *counts.values(), illegal, cost, audit, digest), lines


ROWS = [
    (1, 0, "system", "Be brief."),
    (1, 1, "user", "Hi there."),
    (1, 2, "assistant", "Hello!"),
    (2, None, "assistant", "No turn."),
    (2, 5, "user", None),
    (2, 5, None, "No role."),
    (2, 7, "user", "cut off"),
    (3, 1, "", "Empty role."),
    (3, 2, "tool", " \t\n"),
    (None, 3, "user", "No id."),
    (None, 4, "user", "No id."),
    (4, None, "user", " "),
    (4, None, "user", " "),
    (5, 9, "assistant", "Same turn B."),
    (5, 9, "assistant", "Same turn A."),
    (5, 9, "assistant", "Same turn A."),
    (6, -3, "user", "Long. " * 20_000),
    (6, 3, "assistant", "x" * 100_000),
]


def table_of(spark, rows):
    schema = "turn long, text string, conv_id long, role string, conv string, there boolean, _copy int"
    return spark.createDataFrame([(t, x, c, r, "?", False, 9) for c, t, r, x in rows], schema)


def groups(rows):
    out = {}
    for row in rows:
        out.setdefault(row[0], []).append(row)
    return out


@pytest.mark.parametrize("damage", [False, True])
def test_tables_match_plain_code(spark, damage):
    rng = random.Random(6)
    rows = list(ROWS)
    for conv in range(10, 60):
        for turn in range(rng.randint(1, 7)):
            text = rng.choice(["One.", "Two!", "three", "Four?", f"{rng.random()}."])
            rows.append((conv, turn, rng.choice(["user", "assistant", "user", "assistant", "system"]), text))
    rng.shuffle(rows)
    turns = turns_of(table_of(spark, rows))
    turns = damaged(turns) if damage else turns
    left = groups(plain_damage(rows) if damage else [(c, t, r or " ", " " if x is None else x) for c, t, r, x in rows])
    if not damage:
        left = groups([(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows])
    found = audits(turns)
    got = {r["conv"]: tuple(r[c] for c in COLUMNS) for r in found.collect()}
    assert set(got) == {r[0] for r in rows}
    lines = {}
    for r in repaired(turns, found).orderBy("position").collect():
        lines.setdefault(r["conv"], []).append(f"{r['role']}:{r['text']}")
    for conv in got:
        want, kept = plain_result(left.get(conv, []))
        assert got[conv] == want, conv
        assert lines.get(conv, []) == kept


def test_conversations_too_long_to_hold_give_the_same_rows(spark, monkeypatch):
    rows = ROWS + [(7, i, "ua"[i % 2].replace("u", "user").replace("a", "assistant"), f"Turn {i}.") for i in range(300)]
    turns = damaged(turns_of(table_of(spark, rows)))
    want = sorted(map(repr, audits(turns).collect()))
    monkeypatch.setattr(conversations, "HELD_BYTES", 100)
    monkeypatch.setattr(conversations, "ALIGN_ROWS", 70)
    assert sorted(map(repr, audits(turns).collect())) == want


def test_all_rows_dropped_and_empty_table(spark):
    dropped = next(i for i in range(1_000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    turns = damaged(turns_of(table_of(spark, [(dropped, 0, "user", "Hi.")])))
    got = audits(turns).collect()
    assert [tuple(r) for r in got] == [(dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert audits(damaged(turns_of(table_of(spark, [])))).collect() == []


def test_query_matches_plain_code(spark):
    frame = spark.read.parquet(f"{SMALL}/conversations.parquet")
    rows = [tuple(r) for r in frame.select("conv_id", "turn", "role", "text").collect()]
    left = groups(plain_damage(rows))
    got = QUERIES["op13_conversations"](spark, SMALL)
    assert got.columns == ["conv_id", *COLUMNS]
    found = {r["conv_id"]: tuple(r)[1:] for r in got.collect()}
    assert found == {conv: plain_result(left.get(conv, []))[0] for conv in {r[0] for r in rows}}
    assert got.filter(F.col("cost") > 0).count() > 0


def test_long_codes_take_little_time():
    codes = "ua" * 200_000 + "xdU"
    cost, audit = audit_of(codes)
    assert cost == collapsed(codes)[0] and audit.count("K") >= 400_000
