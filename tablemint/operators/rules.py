"""Ordered rules, first match wins.

A rule table is configuration, so it compiles to one CASE expression over the row: no join, no
shuffle, and later rules are not evaluated once one has matched.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import _col
from .notes import note_rows


@dataclass(frozen=True)
class SignatureRule:
    """A content signature: what to compare (``basis``), with what, and the resulting type."""

    basis: str
    value: str
    document_type: str
    description: str
    structure: str
    expected_per_day: int | None = None

    def condition(self) -> Column:
        if self.basis == "heading":
            return F.array_contains(F.col("headings"), self.value)
        if self.basis == "xml_root":
            return F.col("xml_root") == self.value
        if self.basis == "header_prefix":
            return F.startswith(F.col("first_line"), F.lit(self.value))
        if self.basis == "text_pattern":
            return F.col("head").rlike(self.value)
        raise ValueError(f"unknown basis {self.basis!r}")


def first_rule(conditions: Iterable[tuple[Column, Column]]) -> Column:
    """The outcome of the first condition that holds; null when none does."""
    chain = None
    for condition, outcome in conditions:
        chain = F.when(condition, outcome) if chain is None else chain.when(condition, outcome)
    return chain


def classify(signatures: DataFrame, rules: list[SignatureRule]) -> DataFrame:
    """Add ``document_type``, ``description``, ``structure`` and ``classified_by``."""
    index = F.coalesce(
        first_rule((r.condition(), F.lit(i)) for i, r in enumerate(rules)), F.lit(-1)
    )
    outcome = lambda attribute: first_rule(
        (F.col("_rule") == i, F.lit(getattr(r, attribute))) for i, r in enumerate(rules)
    )
    return (
        signatures.withColumn("_rule", index)
        .withColumn("document_type", F.coalesce(outcome("document_type"), F.lit("unknown")))
        .withColumn("description", outcome("description"))
        .withColumn("structure", outcome("structure"))
        .withColumn("classified_by", F.coalesce(outcome("basis"), F.lit("unmatched")))
        .drop("_rule")
    )


def unclassified_notes(classified: DataFrame, name: str) -> DataFrame:
    return note_rows(
        classified.filter(F.col("document_type") == "unknown"),
        "unclassifiedDocument",
        F.col(name),
        "no content signature matched; add a rule for it",
    )


def expected_shortfall(classified: DataFrame, rules: list[SignatureRule], day: str) -> DataFrame:
    """Days on which a document type does not arrive as often as its rule expects."""
    expected = first_rule(
        (F.col("document_type") == r.document_type, F.lit(r.expected_per_day))
        for r in rules
        if r.expected_per_day is not None
    )
    return (
        classified.groupBy(day, "document_type")
        .agg(F.count("*").alias("n"))
        .withColumn("expected", expected.cast("bigint"))
        .filter(F.col("expected") != F.col("n"))
    )


def prefix_class(value: Column | str, table: Iterable[tuple[str, str]]) -> Column:
    """The class of the first prefix that the lower-cased value starts with, else null."""
    lowered = F.lower(F.coalesce(_col(value), F.lit("")))
    return first_rule((F.startswith(lowered, F.lit(p)), F.lit(c)) for p, c in table)


def assign_role(name: Column | str, roles: Iterable[tuple[str, str | None]]) -> Column:
    """The first role whose pattern the name matches, ignoring case.

    A name that matches none gets the first role that has no pattern.
    """
    roles = list(roles)
    chain = [
        (_col(name).rlike(f"(?i){pattern}"), F.lit(role)) for role, pattern in roles if pattern
    ]
    fallback = next((role for role, pattern in roles if not pattern), None)
    matched = first_rule(chain) if chain else F.lit(None).cast("string")
    return F.coalesce(matched, F.lit(fallback).cast("string"))


def check_patterns(roles: Iterable[tuple[str, str | None]]) -> None:
    """Fail before any data is read when a pattern is not a pattern."""
    for _, pattern in roles:
        if pattern:
            re.compile(pattern)
