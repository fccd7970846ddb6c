"""Rules that come as a table.

A rule has a number, a basis, a value and an outcome; the smallest number that applies wins.  A table
of few rules is read and compiled to the CASE form, which shuffles nothing.  A larger one is joined by
index: equality bases on the value itself, prefixes on the lengths that occur among the rules, and only
patterns, which no index serves, every different one against every different text.  Both give the same rows.

``rules(rule_no, basis, value, document_type, description, structure, expected_per_day)``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rules import SignatureRule, assign_role, classify, first_rule

#: Rules that are compiled; a longer table is joined.
COMPILED = 500
#: Different patterns of a block on average, and so what a task holds of them at once.
PATTERN_BLOCK = 2_000

BASES = ("heading", "xml_root", "header_prefix", "text_pattern")
OUTCOME = ("document_type", "description", "structure", "basis")


def unknown_bases(rules: DataFrame) -> DataFrame:
    """Rules that name a basis which does not exist."""
    return rules.filter(~F.coalesce(F.col("basis").isin(*BASES), F.lit(False)))


def compiled_rules(rules: DataFrame, limit: int = COMPILED) -> list[SignatureRule] | None:
    """The rules in order, or None when there are more than ``limit``; at most one more is read."""
    rows = rules.orderBy("rule_no").limit(limit + 1).collect()
    if len(rows) > limit:
        return None
    return [
        SignatureRule(r["basis"], r["value"], r["document_type"], r["description"], r["structure"], r["expected_per_day"])
        for r in rows
    ]


def classify_by(signatures: DataFrame, rules: DataFrame, keys: list[str], limit: int = COMPILED) -> DataFrame:
    """As ``classify``, with rules from a table of any size."""
    few = compiled_rules(rules, limit)
    return classify(signatures, few) if few is not None else classify_joined(signatures, rules, keys)


def classify_joined(signatures: DataFrame, rules: DataFrame, keys: list[str], block: int = PATTERN_BLOCK) -> DataFrame:
    """Signatures with the outcome of their first rule, found by joins.

    ``keys`` identify a signature; rows that share them share the first rule any of them meets.  Rules are
    reduced to one per value before they are joined, so a frequent value multiplies nothing.
    """
    own = [F.col(f"`{k}`") for k in keys]

    def indexed(basis: str) -> DataFrame:
        """One rule per value: the smallest number that has it."""
        return rules.filter(F.col("basis") == basis).groupBy("value").agg(F.min("rule_no").alias("_rule"))

    roots = signatures.select(*own, F.col("xml_root").alias("value")).join(indexed("xml_root"), "value")
    headings = signatures.select(*own, F.explode(F.array_distinct("headings")).alias("value")).join(indexed("heading"), "value")
    prefixes = matching_prefixes(signatures, "first_line", keys, indexed("header_prefix"))
    found = [df.select(*own, "_rule") for df in (roots, headings, prefixes)]
    found.append(_pattern_matches(signatures, rules.filter("basis = 'text_pattern'"), keys, block).select(*own, "_rule"))
    first = reduce(DataFrame.union, found).groupBy(*own).agg(F.min("_rule").alias("_rule"))
    outcome = rules.groupBy(F.col("rule_no").alias("_rule")).agg(*[F.min(c).alias(c) for c in OUTCOME])
    marked = first.select(*[F.col(f"`{k}`").alias(f"_key_{i}") for i, k in enumerate(keys)], "_rule")
    same = reduce(Column.__and__, [F.col(f"`{k}`").eqNullSafe(F.col(f"_key_{i}")) for i, k in enumerate(keys)])
    return (
        signatures.join(marked.join(outcome, "_rule"), same, "left")
        .withColumn("document_type", F.coalesce("document_type", F.lit("unknown")))
        .withColumn("classified_by", F.coalesce("basis", F.lit("unmatched")))
        .select(*signatures.columns, "document_type", "description", "structure", "classified_by")
    )


def matching_prefixes(df: DataFrame, column: str, keys: list[str], prefixes: DataFrame) -> DataFrame:
    """``(keys, value, _rule)`` of every prefix of ``prefixes(value, _rule)`` that the column starts with.

    The column is cut at the lengths that prefixes have, and the cuts are looked up: the work grows with
    the number of different lengths, not with the number of prefixes.
    """
    own = [F.col(f"`{k}`") for k in keys]
    sizes = prefixes.agg(F.collect_set(F.length("value"))).scalar()
    texts = df.select(*own, F.col(f"`{column}`").alias("_text"), sizes.alias("_sizes"))
    fitting = F.filter("_sizes", lambda n: n <= F.length("_text"))
    cut = texts.select(*own, "_text", F.explode(fitting).alias("_size"))
    return cut.withColumn("value", F.left("_text", "_size")).join(prefixes, "value").drop("_text", "_size")


def _pattern_matches(signatures: DataFrame, patterns: DataFrame, keys: list[str], block: int) -> DataFrame:
    """``(keys, _rule)`` of the first pattern that the head matches.

    Every different head meets every different pattern, in blocks that a hash fills.  All of it stays in
    Spark, so neither the plan nor the driver grows with the patterns.
    """
    one = patterns.filter("value is not null").groupBy("value").agg(F.min("rule_no").alias("_rule"))
    group = F.pmod(F.xxhash64("value"), F.ceil(one.agg(F.count("*")).scalar() / block))
    blocks = one.groupBy(group.alias("_group")).agg(F.array_sort(F.collect_list(F.struct("_rule", "value"))).alias("_patterns"))
    heads = signatures.filter("head is not null").select("head").distinct()
    met = heads.crossJoin(blocks.select("_patterns"))
    hit = F.filter("_patterns", lambda p: F.rlike("head", p["value"]))
    first = met.select("head", F.get(hit, F.lit(0))["_rule"].alias("_rule")).filter("_rule is not null")
    best = first.groupBy(F.col("head").alias("_head")).agg(F.min("_rule").alias("_rule"))
    return signatures.join(best, F.col("head") == F.col("_head")).select(*[F.col(f"`{k}`") for k in keys], "_rule")


def expected_from(classified: DataFrame, rules: DataFrame, day: str) -> DataFrame:
    """Days on which a document type does not arrive as often as the first rule for it expects."""
    wanted = rules.filter("expected_per_day is not null").groupBy("document_type").agg(
        F.min_by("expected_per_day", "rule_no").cast("long").alias("expected")
    )
    counted = classified.groupBy(day, "document_type").agg(F.count("*").alias("n"))
    return counted.join(wanted, "document_type").filter(F.col("expected") != F.col("n")).select(day, "document_type", "n", "expected")


def prefix_classes(df: DataFrame, column: str, keys: list[str], table: DataFrame, into: str, longest: bool = False) -> DataFrame:
    """The class of the first prefix (or of the longest one) that the lower-cased column starts with.

    ``table(rule_no, prefix, class)`` may be of any size; rows without a match get null.
    """
    by = F.struct(-F.length("value"), F.col("_rule")) if longest else F.col("_rule")
    one = table.groupBy(F.lower("prefix").alias("value")).agg(F.min("rule_no").alias("_rule"), F.min_by("class", "rule_no").alias("_class"))
    lowered = df.select(*[F.col(f"`{k}`") for k in keys], F.lower(F.coalesce(F.col(f"`{column}`"), F.lit(""))).alias("_lowered"))
    distinct = lowered.select("_lowered").distinct()  # values repeat far more often than they differ
    met = matching_prefixes(distinct.withColumn("_cut", F.col("_lowered")), "_cut", ["_lowered"], one)
    best = met.groupBy(F.col("_lowered").alias("_value")).agg(F.min_by("_class", by).alias(into))
    joined = df.withColumn("_lowered", F.lower(F.coalesce(F.col(f"`{column}`"), F.lit(""))))
    return joined.join(best, F.col("_lowered") == F.col("_value"), "left").drop("_lowered", "_value")


def roles_from(names: DataFrame, name: str, roles: DataFrame, into: str = "role", limit: int = COMPILED) -> DataFrame:
    """Names with the first role whose pattern they match, by a table ``roles(role_no, role, pattern)``.

    A name that matches none gets the first role without a pattern.  Longer tables are taken in blocks,
    in order of their numbers: a name that an earlier block has answered is not looked at again.
    """
    last, column = None, F.lit(None).cast("string")
    while True:
        rest = roles.filter("pattern <> ''") if last is None else roles.filter("pattern <> ''").filter(F.col("role_no") > last)
        rows = rest.select("role_no", "role", "pattern").orderBy("role_no").limit(limit).collect()
        if not rows:
            break
        last = rows[-1]["role_no"]
        column = F.coalesce(column, assign_role(name, [(r["role"], r["pattern"]) for r in rows]))
    fallback = roles.filter("coalesce(pattern, '') = ''").agg(F.min_by("role", "role_no")).scalar()
    return names.withColumn(into, F.coalesce(column, fallback))
