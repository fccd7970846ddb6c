"""Data-quality operators.  Each returns notes or violations as a DataFrame."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import is_object_description, is_present
from ..functions.text import SENTINEL
from .notes import note_rows
from .order import data_columns


def duplicate_keys(df: DataFrame, keys: list[str | Column]) -> DataFrame:
    """Keys that more than one row carries, with the count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def duplicate_members(df: DataFrame, parent: list[str], members: list[str]) -> DataFrame:
    """Members repeated within one parent.

    Every occurrence stays in the data; ``repeats`` says how many notes the member earns, one
    per occurrence after the first.
    """
    return (
        df.groupBy(*parent, *members)
        .agg((F.count("*") - 1).alias("repeats"))
        .filter(F.col("repeats") > 0)
    )


def _sentinels(values: dict[str, Column]) -> list[Column]:
    return [F.count_if(value == SENTINEL).alias(name) for name, value in values.items()]


def _tallied(counts: DataFrame) -> DataFrame:
    long = counts.unpivot([], [F.col(f"`{f}`") for f in counts.columns], "field", "n")
    return long.filter(F.col("n") > 0)


def sentinel_tally(df: DataFrame, fields: list[str]) -> DataFrame:
    """How often each field holds the literal ``(null)``; one pass over the table."""
    return _tallied(df.agg(*_sentinels({f: F.col(f"`{f}`") for f in fields})))


def _copied(left: str, right: str) -> Column:
    same = F.bool_and(F.col(f"`{left}`").eqNullSafe(F.col(f"`{right}`")))
    return F.coalesce(same, F.lit(False)).alias("copied")


def is_copied(df: DataFrame, left: str, right: str) -> DataFrame:
    """One row: are the columns equal on every row, nulls included, and is there a row at all."""
    return df.agg(_copied(left, right))


def _leaks(df: DataFrame) -> list[Column]:
    texts = [n for n, t in df.dtypes if t == "string" and n in data_columns(df)]
    return [F.bool_or(F.coalesce(is_object_description(f"`{c}`"), F.lit(False))).alias(c) for c in texts]


def _leaking(found: DataFrame) -> DataFrame:
    long = found.unpivot([], [F.col(f"`{c}`") for c in found.columns], "field", "leaked")
    return long.filter("leaked").select("field")


def leaked_fields(df: DataFrame) -> DataFrame:
    """Names of the text columns that hold an object description anywhere.

    One pass with one boolean per column: no row is unpivoted.
    """
    return _leaking(df.agg(*_leaks(df)))


def column_findings(df: DataFrame, raw: str, left: str | None = None, right: str | None = None) -> DataFrame:
    """One row of what one pass over a table says of its columns, for the three functions below.

    ``leaks`` are those of ``leaked_fields``, ``sentinels`` those of ``sentinel_tally`` over the members of
    the struct ``raw``, and ``copied`` is ``is_copied`` of two columns where they are given.
    """
    members = {c: F.col(raw)[c] for c in df.select(f"{raw}.*").columns}
    copied = [] if left is None else [_copied(left, right)]
    return df.agg(F.struct(*_leaks(df)).alias("leaks"), F.struct(*_sentinels(members)).alias("sentinels"), *copied)


def found_leaks(findings: DataFrame) -> DataFrame:
    return _leaking(findings.select("leaks.*"))


def found_sentinels(findings: DataFrame) -> DataFrame:
    return _tallied(findings.select("sentinels.*"))


def found_copied(findings: DataFrame) -> DataFrame:
    return findings.select("copied")


def distinct_values(value: str | Column) -> Column:
    """Aggregate: distinct values with null counting as one value."""
    value = F.col(value) if isinstance(value, str) else value
    return F.count_distinct(value) + F.max(value.isNull().cast("bigint"))


def single_value(value: str | Column) -> Column:
    """Aggregate: the value when there is exactly one distinct, else null."""
    value = F.col(value) if isinstance(value, str) else value
    return F.when(F.min(value) == F.max(value), F.max(value))


def fallback_day(df: DataFrame, day: str, option: str | None = None) -> DataFrame:
    """Fill a missing day with the one day of the run, else the option, else null.

    A row's own day outranks both.  The run's day is a scalar subquery, so nothing is joined.
    """
    run = df.agg(F.coalesce(single_value(day), F.lit(option)))
    return df.withColumn(day, F.coalesce(F.col(day), run.scalar()))


# --- entity rules ---------------------------------------------------------------------


@dataclass(frozen=True)
class EntityRule:
    """A column rule: ``required``, ``allowed`` values, or a ``pattern`` for present values."""

    column: str
    required: bool = False
    allowed: tuple[str, ...] | None = None
    pattern: str | None = None
    numeric: bool = False

    def failures(self) -> list[Column]:
        value = F.col(f"`{self.column}`")
        text = value.cast("string")
        path = "/" + self.column.replace(".", "/")
        found = []
        if self.required:
            found.append(F.when(~is_present(value), F.lit(f"{path} is required")))
        if self.allowed is not None:
            found.append(
                F.when(is_present(value) & ~text.isin(*self.allowed), F.lit(f"{path} is not an allowed value"))
            )
        if self.pattern is not None:
            found.append(
                F.when(is_present(value) & ~text.rlike(self.pattern), F.lit(f"{path} does not match its pattern"))
            )
        if self.numeric:
            found.append(
                F.when(is_present(value) & text.try_cast("double").isNull(), F.lit(f"{path} is not a number"))
            )
        return found


def validate_entities(
    entities: DataFrame, rules: list[EntityRule], id_column: str = "entity_id", entity_type: str = ""
) -> DataFrame:
    """Failures as ``(entity_type, identifier, error)``; all rules in one narrow pass."""
    known = {r.column for r in rules}
    missing = known - set(entities.columns)
    if missing:
        raise ValueError(f"{entity_type} has no column {', '.join(sorted(missing))}")
    found = [failure for rule in rules for failure in rule.failures()]
    return entities.select(
        F.lit(entity_type).alias("entity_type"),
        F.col(id_column).cast("string").alias("identifier"),
        F.explode(F.array_compact(F.array(*found))).alias("error"),
    )


def unexpected_columns(columns: list[str], allowed: set[str], entity_type: str) -> list[str]:
    """Property columns the target type does not have; a plan-time check."""
    return [f"{entity_type} has no property {c}" for c in columns if c not in allowed]


def uncontrolled_values(df: DataFrame, column: str, allowed: DataFrame) -> DataFrame:
    """Values in use that the allowed list does not hold, with their row counts.

    Values are counted before the anti join, so a hot value joins once.
    """
    used = df.filter(is_present(column)).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    return used.join(allowed.select(F.col("value")), "value", "left_anti")


def shared_identifiers(identifiers: DataFrame) -> DataFrame:
    """Identifiers on more than one entity of ``(entity_type, entity_id, scope, value)``."""
    entity = F.struct("entity_type", "entity_id")
    return (
        identifiers.groupBy("scope", "value")
        .agg(F.min(entity).alias("_a"), F.max(entity).alias("_b"))
        .filter(F.col("_a") != F.col("_b"))
        .select("scope", "value")
    )


# --- manifests ------------------------------------------------------------------------


def exactly_one(files: DataFrame, days: DataFrame, patterns: list[tuple[str, str, bool]]) -> DataFrame:
    """Roles of a day that do not have exactly one file.

    ``files(day, name)``; ``patterns`` are ``(role, pattern, required)``.  A role without a file
    is a violation only where required.  All matching names are reported for an ambiguous role,
    one row per file, so no name list grows with the delivery.
    """
    roles = F.array(
        *[F.when(F.col("name").rlike(p), F.lit(r)) for r, p, _ in patterns]
    )
    matched = files.select("day", "name", F.explode(F.array_compact(roles)).alias("role"))
    counted = matched.groupBy("day", "role").agg(F.count("*").alias("n"))
    wanted = days.select("day").distinct().select(
        "day",
        F.inline(F.array(*[F.struct(F.lit(r).alias("role"), F.lit(q).alias("required")) for r, _, q in patterns])),
    )
    state = wanted.join(counted, ["day", "role"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    none = state.filter((F.col("n") == 0) & F.col("required")).select(
        "day", "role", F.lit("none").alias("problem"), F.col("n"), F.lit(None).cast("string").alias("name")
    )
    ambiguous = (
        state.filter(F.col("n") > 1)
        .join(matched, ["day", "role"])
        .select("day", "role", F.lit("ambiguous").alias("problem"), "n", "name")
    )
    return none.unionByName(ambiguous)


@dataclass(frozen=True)
class Role:
    role: str
    label: str
    required: bool = False
    max_files: int | None = None


def check_manifest(
    inputs: DataFrame, runs: DataFrame, roles: list[Role], min_files: int = 1, max_files: int | None = None
) -> DataFrame:
    """All problems of all runs at once, as ``(run_id, kind, detail)``.

    ``inputs(run_id, role, file_name, ref)``, ``runs(run_id)``.  The declared roles are
    configuration, so the counts of one run are one aggregated row and every per-run check reads
    that row.
    """
    known = [r.role for r in roles]
    shown = F.coalesce("file_name", F.lit("(unnamed)"))
    per_file = F.array_compact(
        F.array(
            F.when(
                ~is_present("ref"),
                F.struct(
                    F.lit("inputWithoutRef").alias("kind"),
                    F.concat(F.lit('"'), shown, F.lit('" names no place to read from')).alias("detail"),
                ),
            ),
            F.when(
                F.col("role").isNull() | ~F.col("role").isin(*known),
                F.struct(
                    F.lit("unknownRole").alias("kind"),
                    F.concat(
                        F.lit('"'), F.coalesce("file_name", "ref", F.lit("(unnamed)")),
                        F.lit('": role "'), F.coalesce("role", F.lit("")), F.lit('" is not declared'),
                    ).alias("detail"),
                ),
            ),
        )
    )
    file_problems = inputs.select("run_id", F.explode(per_file).alias("_p")).select("run_id", "_p.*")

    counts = inputs.groupBy("run_id").agg(
        F.count("*").alias("_files"),
        *[F.count_if(F.col("role") == r.role).alias(f"_n{i}") for i, r in enumerate(roles)],
    )
    zero = {c: 0 for c in counts.columns if c != "run_id"}
    state = runs.select("run_id").distinct().join(counts, "run_id", "left").fillna(zero)

    def problem(condition: Column, kind: str, *detail) -> Column:
        parts = [F.lit(d) if isinstance(d, str) else d.cast("string") for d in detail]
        return F.when(condition, F.struct(F.lit(kind).alias("kind"), F.concat(*parts).alias("detail")))

    files = F.col("_files")
    checks = [problem(files < min_files, "tooFewFiles", "files: ", files, f", wanted {min_files} or more")]
    if max_files is not None:
        checks.append(problem(files > max_files, "tooManyFiles", "files: ", files, f", wanted {max_files} or fewer"))
    for i, r in enumerate(roles):
        n = F.col(f"_n{i}")
        if r.required:
            checks.append(problem(n == 0, "missingRequiredRole", f'role "{r.role}" ({r.label}) has no file'))
        if r.max_files is not None:
            checks.append(
                problem(n > r.max_files, "tooManyForRole", f'files of role "{r.role}": ', n, f", wanted {r.max_files} or fewer")
            )
    run_problems = state.select("run_id", F.explode(F.array_compact(F.array(*checks))).alias("_p")).select("run_id", "_p.*")
    return file_problems.unionByName(run_problems)


def inputs_for_role(inputs: DataFrame, role: str) -> DataFrame:
    return inputs.filter(F.col("role") == role)


# --- landed pages ---------------------------------------------------------------------


def page_completeness(pages: DataFrame) -> DataFrame:
    """Endpoints whose landed pages do not form one finished chain.

    ``pages(endpoint, position, rows, has_more, cursor, next)``; offset endpoints leave the cursors
    null.  Problems: the last page says there is more although it has rows (``unfinished``), a
    cursor is followed twice (``repeatedCursor``), or a page names a next page that was not landed
    (``missingPage``).  A page that claims more but is empty ends its chain.
    """
    last = pages.groupBy("endpoint").agg(
        F.max_by(F.struct("has_more", "rows"), "position").alias("_last")
    )
    unfinished = last.filter(F.col("_last.has_more") & (F.col("_last.rows") > 0)).select(
        "endpoint", F.lit("unfinished").alias("problem"), F.lit(None).cast("string").alias("cursor")
    )
    named = (
        pages.filter(F.col("next").isNotNull())
        .groupBy("endpoint", F.col("next").alias("cursor"))
        .agg(F.count("*").alias("n"))
    )
    repeated = named.filter(F.col("n") > 1).select("endpoint", F.lit("repeatedCursor").alias("problem"), "cursor")
    landed = pages.filter(F.col("cursor").isNotNull()).select("endpoint", "cursor")
    missing = named.join(landed, ["endpoint", "cursor"], "left_anti").select(
        "endpoint", F.lit("missingPage").alias("problem"), "cursor"
    )
    return unfinished.unionByName(repeated).unionByName(missing)


def missing_sources(expected: DataFrame, landed: DataFrame, kind: str = "endpointUnavailable") -> DataFrame:
    """Notes for the expected sources that did not land; the rest of the run goes on."""
    return note_rows(
        expected.select("source").join(landed.select("source").distinct(), "source", "left_anti"),
        kind,
        F.col("source"),
        "expected but not landed",
    )


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """Fail, once the plan runs, when a run has no rows at all."""
    count = df.agg(F.count("*").alias("_n"))
    checked = count.select(
        F.when(F.col("_n") == 0, F.raise_error(F.lit(message))).otherwise(F.col("_n")).alias("rows")
    )
    return checked


# --- catalogue counters ---------------------------------------------------------------


def source_versions(df: DataFrame, version: str, target: str) -> DataFrame:
    """Versions found with their counts, and whether each needs an upgrade."""
    return (
        df.filter(is_present(version))
        .groupBy(F.col(version).alias("version"))
        .agg(F.count("*").alias("n"))
        .withColumn("migrated", F.col("version") != target)
    )


def table_counts(tables: dict[str, DataFrame], section: str = "tables") -> DataFrame:
    """``report(section, name, value)`` rows: one count per table."""
    frames = [
        df.agg(F.count("*").alias("value")).select(
            F.lit(section).alias("section"), F.lit(name).alias("name"), "value"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, frames)


def report_rows(df: DataFrame, section: str, name: str | Column) -> DataFrame:
    """``report`` rows: rows of ``df`` per value of ``name``."""
    return (
        df.groupBy((F.col(name) if isinstance(name, str) else name).alias("name"))
        .agg(F.count("*").alias("value"))
        .select(F.lit(section).alias("section"), "name", "value")
    )
