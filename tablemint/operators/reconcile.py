"""Cross-checking two independent exports of the same facts."""

from __future__ import annotations

from collections.abc import Callable
from copy import copy
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import compare_value, is_present
from ..session import stage
from .fingerprints import BUCKETS, differing_buckets, rows_of_buckets
from .nested import Path, canonical_text, is_nested, path_steps, record_of, records_without
from .order import ORDER, last_wins, order_of, top_sample

DIFFERENCES = "array<struct<field:string,left_value:string,right_value:string,difference:string>>"


@dataclass(frozen=True)
class Field:
    """A field of a field map: its name on each side, or None where a side lacks it.

    ``total`` says that every text that is present has a normal form.
    """

    name: str
    left: str | None
    right: str | None
    normalize: Callable[[Column], Column] | None = None
    note: str | None = None
    total: bool = False


def shared_fields(fields: list[Field]) -> list[Field]:
    return [f for f in fields if f.left and f.right]


def left_only_fields(fields: list[Field]) -> list[Field]:
    return [f for f in fields if f.left and not f.right]


def unequal_fields(fields: list[Field], left: Column, right: Column) -> Column:
    """The fields two rows disagree on, with both values and the kind of difference.

    Texts that are equal as they stand are not normalized: equal texts have equal normal forms.
    """
    none = F.array().cast(DIFFERENCES)

    def unequal(f: Field) -> Column:
        given, found = left[f.left], right[f.right]
        texts = given.cast("string"), found.cast("string")
        kind = lambda name: F.array(
            F.struct(
                F.lit(f.name).alias("field"), texts[0].alias("left_value"), texts[1].alias("right_value"),
                F.lit(name).alias("difference"),
            )
        )
        if f.total or f.normalize is None:
            a, b = (f.normalize(t) if f.normalize else t for t in texts)
            there = is_present(given), is_present(found)
            apart = F.when(there[0] & there[1], F.when(a == b, none).otherwise(kind("mismatch")))
            apart = apart.when(there[0] | there[1], kind("one_sided")).otherwise(none)
        else:
            a, b = compare_value(given, f.normalize), compare_value(found, f.normalize)
            apart = F.when(a.eqNullSafe(b), none).when(a.isNull() | b.isNull(), kind("one_sided")).otherwise(kind("mismatch"))
        return F.when(texts[0].eqNullSafe(texts[1]), none).otherwise(apart)

    # Lists of one or none are put together, not filtered: a filter has no generated code, nor has what it reads.
    compared = [unequal(f) for f in shared_fields(fields)]
    return F.flatten(F.array(*compared)) if compared else none


def _read_cells(fields: list[Field], side: str, keys: list[str]) -> list[str]:
    return sorted({getattr(f, side) for f in shared_fields(fields)} - set(keys))


@dataclass(frozen=True)
class Reconciliation:
    """Both sides, one row per key, and what their comparison says.

    Each side is reduced to its last row per key before the join, so keys are unique on both
    sides and no key can multiply rows.  Differences are picked out inside the joined row:
    equal fields never become rows.
    """

    left: DataFrame
    right: DataFrame
    keys: list[str]
    fields: list[Field]
    delivered: bool = True
    _joined: DataFrame = field(init=False, repr=False, compare=False, default=None)

    def __post_init__(self):
        def side(df: DataFrame, name: str) -> DataFrame:
            read = _read_cells(self.fields, name, self.keys)
            kept = [*self.keys, *read] + ([ORDER] if ORDER in df.columns else [])
            unique = last_wins(df.select(*[F.col(f"`{c}`") for c in kept]), self.keys)
            row = F.struct(*[F.col(f"`{c}`") for c in [*self.keys, *read]]).alias(f"_{name}")
            return unique.select(*self.keys, row)

        joined = side(self.left, "left").join(
            side(self.right, "right"), self.keys, "full_outer"
        )
        # A column of its own, so that what reads it more than once compares the fields once.
        unequal = F.when(self._both, unequal_fields(self.fields, F.col("_left"), F.col("_right")))
        object.__setattr__(self, "_joined", joined.withColumn("_unequal", unequal))

    def stored(self) -> Reconciliation:
        """The same comparison with its outcome per key written to the shared folder, for several outputs."""
        present = lambda side: F.when(F.col(side).isNotNull(), True).alias(side)
        outcome = self._joined.select(*self.keys, present("_left"), present("_right"), "_unequal")
        held = copy(self)
        object.__setattr__(held, "_joined", stage(outcome, "reconciled"))
        return held

    @property
    def _both(self) -> Column:
        return F.col("_left").isNotNull() & F.col("_right").isNotNull()

    def differences(self) -> DataFrame:
        """One row per key and field the sides disagree on."""
        return (
            self._joined.filter(self._both)
            .select(*self.keys, F.explode("_unequal").alias("_d"))
            .select(*self.keys, "_d.*")
        )

    def only_left(self) -> DataFrame:
        return self._joined.filter(F.col("_right").isNull()).select(*self.keys)

    def only_right(self) -> DataFrame:
        return self._joined.filter(F.col("_left").isNull()).select(*self.keys)

    def matched(self) -> DataFrame:
        return self._joined.filter(self._both).select(*self.keys)

    def summary(self) -> DataFrame:
        """One row: keys matched and on one side only, differences, and the verdict.

        A value missing on one side is reported but does not fail the comparison.
        """
        unequal = F.col("_unequal")
        count = lambda kind: F.coalesce(
            F.sum(F.size(F.filter(unequal, lambda d: d["difference"] == kind))), F.lit(0)
        ).cast("bigint")
        counted = self._joined.agg(
            F.count_if(self._both).alias("matched"),
            F.count_if(F.col("_right").isNull()).alias("only_left"),
            F.count_if(F.col("_left").isNull()).alias("only_right"),
            count("mismatch").alias("mismatches"),
            count("one_sided").alias("one_sided"),
        )
        clean = (F.col("only_left") + F.col("only_right") + F.col("mismatches")) == 0
        verdict = (
            F.when(clean, "PASS").otherwise("DIFFERENCES FOUND")
            if self.delivered
            else F.lit("NOT DELIVERED")
        )
        return counted.withColumn("verdict", verdict)

    def by_field(self) -> DataFrame:
        """Differences per field and kind, so one systematic difference reads as one line."""
        notes = F.coalesce(
            *[F.when(F.col("field") == f.name, F.lit(f.note)) for f in self.fields if f.note],
            F.lit(None).cast("string"),
        )
        counted = self.differences().groupBy("field", "difference").agg(F.count("*").alias("n"))
        return counted.withColumn("note", notes)

    def sample(self, n: int = 12) -> DataFrame:
        return top_sample(self.differences(), n, *self.keys, "field")


@dataclass(frozen=True)
class Witness:
    """The other side of a comparison, the fields it is compared in, and whether it was delivered at all."""

    rows: DataFrame
    fields: list[Field]
    delivered: bool = True


def reconcile_witnesses(
    left: DataFrame, witnesses: dict[str, Witness], keys: list[str], carried: tuple[str, ...] = ()
) -> tuple[dict[str, Reconciliation], DataFrame]:
    """``left`` compared with each witness as ``Reconciliation(...).stored()`` would, all in one grouping.

    Also gives the last row per key of ``left`` as ``keys`` and the columns ``carried``.  Every side is read,
    shuffled and sorted once, and the outcomes of all comparisons are one table in the shared folder.
    """
    sides = [(left, sorted({c for w in witnesses.values() for c in _read_cells(w.fields, "left", keys)} | set(carried) - set(keys)))]
    sides += [(w.rows, _read_cells(w.fields, "right", keys)) for w in witnesses.values()]

    def tagged(i: int, df: DataFrame, read: list[str]) -> DataFrame:
        kept = df.select(*[F.col(f"`{c}`") for c in [*keys, *read]], *([ORDER] if ORDER in df.columns else []))
        # A key that is null in part meets no other side, as in a join.
        alone = F.when(reduce(or_, [F.col(f"`{k}`").isNull() for k in keys]), F.lit(i))
        row = F.struct(*[F.col(f"`{c}`") for c in [*keys, *read]])
        return kept.select(*keys, alone.alias("_alone"), row.alias(f"_row_{i}"), F.struct(order_of(kept)).alias(f"_order_{i}"))

    rows = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), [tagged(i, *side) for i, side in enumerate(sides)]
    )
    last = rows.groupBy(*keys, "_alone").agg(*[F.max_by(f"_row_{i}", f"_order_{i}").alias(f"_{i}") for i in range(len(sides))])
    present = lambda i: F.when(F.col(f"_{i}").isNotNull(), True)
    outcomes = [present(0).alias("_left"), *[F.col("_0")[c].alias(f"_carried_{c}") for c in carried]]
    for i, w in enumerate(witnesses.values(), 1):
        both = F.col("_0").isNotNull() & F.col(f"_{i}").isNotNull()
        outcomes.append(present(i).alias(f"_right_{i}"))
        outcomes.append(F.when(both, unequal_fields(w.fields, F.col("_0"), F.col(f"_{i}"))).alias(f"_unequal_{i}"))
    stored = stage(last.select(*keys, *outcomes), "reconciled")

    compared = {}
    for i, (name, w) in enumerate(witnesses.items(), 1):
        held = object.__new__(Reconciliation)
        held.__dict__.update(left=left, right=w.rows, keys=keys, fields=w.fields, delivered=w.delivered)
        met = stored.filter(F.col("_left").isNotNull() | F.col(f"_right_{i}").isNotNull())
        outcome = met.select(*keys, "_left", F.col(f"_right_{i}").alias("_right"), F.col(f"_unequal_{i}").alias("_unequal"))
        held.__dict__["_joined"] = outcome
        compared[name] = held
    found = stored.filter("_left is not null").select(*keys, *[F.col(f"_carried_{c}").alias(c) for c in carried])
    return compared, found


def cross_tab(
    reference: DataFrame, witness: DataFrame, keys: list[str], flag: str, label: str, unique: bool = False
) -> DataFrame:
    """Counts of a witness flag against the reference's own class.

    Every witness row counts, while the reference is its last row per key, which ``unique`` says it has
    only one of.  Witness rows are counted per key and flag first, so a hot key joins as one row.
    """
    blank = lambda name: F.coalesce(F.col(name).cast("string"), F.lit("(blank)"))
    counted = witness.groupBy(*keys, blank(flag).alias("flag")).agg(F.count("*").alias("_n"))
    kept = [*keys, label] + ([ORDER] if ORDER in reference.columns else [])
    classes = reference.select(*keys, label) if unique else last_wins(reference.select(*kept), keys)
    return (
        counted.join(classes, keys)
        .groupBy("flag", blank(label).alias("label"))
        .agg(F.sum("_n").alias("n"))
    )


def golden_diff(expected: DataFrame, actual: DataFrame, keys: list[str], ignore: tuple[Path, ...] = ()) -> DataFrame:
    """Entities missing, extra or differing, compared in canonical form.

    ``ignore`` names run-specific columns, or paths inside nested ones such as
    ``customData[].value.shootDay``.  The canonical form is JSON over columns in name order; where a
    column is nested, its members are in name order at every depth too, so neither order is a difference.
    """
    paths = [path_steps(p) for p in ignore]
    dropped = {p[0] for p in paths if len(p) == 1}
    inside = [p for p in paths if len(p) > 1]

    def compared(df: DataFrame) -> list[str]:
        return sorted(c for c in df.columns if c not in keys and c not in dropped)

    # What the types of both sides tell is left out before records are made; one form for both.
    trimmed = [records_without(df, compared(df), inside) if inside else None for df in (expected, actual)]
    early = dict(zip("ea", trimmed, strict=True)) if all(r is not None for r in trimmed) else {}

    def canonical(df: DataFrame, name: str) -> DataFrame:
        columns = compared(df)
        if early:
            return df.select(*keys, canonical_text(early[name[1:]]).alias(name))
        if inside or any(is_nested(df.schema[c].dataType) for c in columns):
            return df.select(*keys, canonical_text(record_of(columns), inside).alias(name))
        return df.select(*keys, F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns])).alias(name))

    joined = canonical(expected, "_e").join(canonical(actual, "_a"), keys, "full_outer")
    state = (
        F.when(F.col("_a").isNull(), "missing")
        .when(F.col("_e").isNull(), "extra")
        .when(F.col("_a") != F.col("_e"), "differing")
    )
    return joined.withColumn("state", state).filter(F.col("state").isNotNull()).select(*keys, "state")


def run_difference(
    first: DataFrame, second: DataFrame, prints: tuple[DataFrame, DataFrame] | None = None, buckets: int = BUCKETS
) -> DataFrame:
    """Rows two runs do not share, as multisets; empty when a re-run changed nothing.

    One aggregation over both runs, which counts equal rows before the shuffle.  ``copies`` says
    how many more of a row the run named in ``only_in`` has.  Given the runs' fingerprints (of these
    columns, in as many buckets), only rows of buckets that differ are shuffled.
    """
    second = second.select(*[f"`{c}`" for c in first.columns])
    if prints is not None:
        wanted = differing_buckets(*prints)
        first, second = (rows_of_buckets(df, wanted, buckets) for df in (first, second))
    signed = first.withColumn("_n", F.lit(1)).unionAll(second.withColumn("_n", F.lit(-1)))
    counted = signed.groupBy(*[f"`{c}`" for c in first.columns]).agg(F.sum("_n").alias("_n")).filter(F.col("_n") != 0)
    return (
        counted.withColumn("only_in", F.when(F.col("_n") > 0, "first").otherwise("second"))
        .withColumn("copies", F.abs("_n"))
        .drop("_n")
    )
