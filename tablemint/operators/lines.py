"""Positioned text runs to visual lines, and the header block of a report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import has_text, iso_date, trimmed
from ..functions.text import SPACE

# What a report header prints.
HEADER_SEPARATOR = " ‖ "
DAY_AND_UNIT = r"(?i)Day:\s*Day\s*(\d+)\s*-\s*([^‖]+)"
SHOOT_DATE = r"(?i)Date:\s*(\d{1,2}/\d{1,2}/\d{2,4})"
PRINT_DATE = r"(\d{1,2}/\d{1,2}/\d{2,4})"


def page_lines(runs: DataFrame) -> DataFrame:
    """``runs(doc, page, x, y, text)`` to ``(doc, page, y, line)``.

    Runs whose rounded baseline is equal share a line, ordered by x and joined with a space;
    white space is collapsed.  Blank runs are left out first, so no line is empty.  The group is
    one visual line, whose text is the result cell itself.
    """
    spoken = runs.filter(has_text("text"))
    baseline = F.floor(F.col("y") + 0.5).cast("bigint")
    # Runs are moved before they are gathered: gathering in the partitions they are read in would sort
    # those, however large they are, and spill them to disk; moved, the number of partitions follows the size.
    placed = spoken.select("doc", "page", baseline.alias("y"), "x", "text").repartition("doc", "page", "y")
    joined = placed.groupBy("doc", "page", "y").agg(
        F.sort_array(F.collect_list(F.struct("x", "text"))).alias("_runs")
    )
    text = F.array_join(F.transform("_runs", lambda r: r["text"]), " ")
    line = trimmed(F.regexp_replace(text, f"{SPACE}+", " "))
    return joined.select("doc", "page", "y", line.alias("line"))


def report_header(lines: DataFrame, page: int = 1, top: int | None = None) -> DataFrame:
    """Print date, shoot day, unit and shoot date from the lines of the first page.

    A field is the first match from the top of the page, however many lines its header has; the
    print date stands on the first line.  ``headings`` are the lines in page order; ``top`` keeps
    the first so many, where a layout is known to have a header of that height.
    """
    first_page = lines.filter(F.col("page") == page)
    header = first_page.groupBy("doc").agg(
        F.array_sort(F.collect_list(F.struct((-F.col("y")).alias("n"), "line"))).alias("_lines")
    )
    headings = F.transform("_lines", lambda r: r["line"])
    if top is not None:
        headings = F.slice(headings, 1, top)
    text = F.array_join("headings", HEADER_SEPARATOR)
    found = lambda value: F.nullif(value, F.lit(""))
    first = F.element_at("headings", 1)
    return header.select("doc", headings.alias("headings")).select(
        "doc",
        "headings",
        iso_date(F.regexp_extract(first, PRINT_DATE, 1)).alias("print_date"),
        found(F.regexp_extract(text, DAY_AND_UNIT, 1)).alias("shoot_day"),
        found(trimmed(F.regexp_extract(text, DAY_AND_UNIT, 2))).alias("unit"),
        iso_date(F.regexp_extract(text, SHOOT_DATE, 1)).alias("shoot_date"),
    )
