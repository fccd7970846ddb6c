"""Delimited files against the standard reader, read line by line and whole."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from tablemint.operators.order import ORDER
from tablemint.sources.csv import csv_rows, malformed_rows


def plain(text, names):
    """Rows of a well-formed file: cells trimmed, blanks null."""
    rows = [r for r in csv.reader(text.splitlines(keepends=True)) if any(c.strip() for c in r)]
    return [tuple((c.strip() or None) for c in r) for r in rows[1:]]


def cells(rng):
    return rng.choice(["", " ", "a", "b c", 'say "hi"', '"Go" he said "now"', "x,y", '"', "é", "007", '""'])


def test_escaped_quotes_are_no_fault(spark, tmp_path):
    rng = random.Random(1)
    with open(tmp_path / "a.csv", "w", newline="", encoding="utf-8") as out:
        writer = csv.writer(out)
        writer.writerow(["k", "one", "two"])
        writer.writerows([i, cells(rng), cells(rng)] for i in range(500))
    text = (tmp_path / "a.csv").read_text(encoding="utf-8")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in (before, "700"):  # in one piece, and cut into splits
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            df = csv_rows(spark, str(tmp_path / "a.csv"))
            got = [tuple(r) for r in df.orderBy(ORDER).select("k", "one", "two").collect()]
            assert got == plain(text, 3)
            assert malformed_rows(df).count() == 0
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_faulty_rows_are_kept_with_their_text(spark, tmp_path, rows):
    lines = ["a,b,c", 'x,"broken "inner" quotes",z', "short,row", "one,too,many,cells", '"""Go"" he said ""now""",ok,"a, b"', "", "  ", 'q"u"o,te,d', ",,"]
    (tmp_path / "f.csv").write_text("﻿" + "\r\n".join(lines) + "\r\n", encoding="utf-8")
    df = csv_rows(spark, str(tmp_path / "f.csv"))
    assert rows(df, "a", "b", "c", "_malformed") == sorted(
        [
            ("x", '"broken "inner" quotes"', "z", lines[1]),
            ("short", "row", None, lines[2]),
            ("one", "too", "many", lines[3]),
            ('"Go" he said "now"', "ok", "a, b", None),
            ('q"u"o', "te", "d", None),
            (None, None, None, None),
        ],
        key=repr,
    )


def test_each_file_by_its_own_header(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text("x,y\n1,2\nx,y\n")  # a row that repeats the header is a row
    (tmp_path / "b.csv").write_text("\n y,z\n3,4\n")
    (tmp_path / "c.csv").write_text("x,y\n")
    (tmp_path / "d.csv").write_text("")
    df = csv_rows(spark, f"{tmp_path}/*.csv")
    assert [c for c in df.columns if c != ORDER] == [" y", "z", "x", "y", "_malformed", "file_path"] or set(df.columns) >= {"x", "y", "z"}
    assert rows(df.filter("x is not null"), "x", "y") == [("1", "2"), ("x", "y")]
    assert rows(df.filter("z is not null"), "z") == [("4",)]
    # Conditions on cells never meet the names in a header line.
    assert df.filter(F.col("x").try_cast("int") == 1).count() == 1
    assert csv_rows(spark, str(tmp_path / "a.csv")).filter("x <> 'x' and cast(x as int) = 1").count() == 1
    assert csv_rows(spark, str(tmp_path / "c.csv")).count() == 0 and csv_rows(spark, str(tmp_path / "d.csv")).count() == 0
    named = csv_rows(spark, str(tmp_path / "a.csv"), columns=["p", "q"])
    assert rows(named, "p", "q") == [("1", "2"), ("x", "y")]


@pytest.mark.parametrize("multiline", [None, True])
def test_line_breaks_inside_cells(spark, tmp_path, rows, multiline):
    (tmp_path / "a.csv").write_text('a,b\n1,"two\nlines"\n3,"say ""x"""\n')
    (tmp_path / "b.csv").write_text("b,a\n5,6\n")
    df = csv_rows(spark, f"{tmp_path}/*.csv", multiline=multiline)
    assert rows(df, "a", "b") == [("1", "two\nlines"), ("3", 'say "x"'), ("6", "5")]
    assert malformed_rows(df).count() == 0
