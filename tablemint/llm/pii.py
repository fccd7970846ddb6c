"""Personal data: patterns propose spans, checksums confirm them, context words adjust the score.

Everything here is SQL functions.  For each kind the matches of a pattern and the text between them
give the positions (in code points): a match starts where the pieces before it end.  Patterns use
possessive repeats and look-behind, so their time is linear in the text even for one endless run of
digits or letters; they find what the plain leftmost greedy patterns find.

The four base kinds are kept whenever their format and checksum hold; context only sets their score.
The added kinds need a score of at least ``MIN_SCORE``.

Defined cases: a null or empty text has no spans; rows are read one by one, so repeated rows repeat
and an empty table gives an empty result; columns of the input that share a name with a result column
are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import put_back, query, set_apart, table

_LOCAL = "[A-Za-z0-9._%+-]"
#: Code points before and after a match that are searched for context words.
CONTEXT = 48
MIN_SCORE = 0.6


@dataclass(frozen=True)
class Kind:
    """``needs``: a character every match holds, which spares the pattern on texts without it."""

    name: str
    pattern: str
    context: str
    base: bool = True
    needs: str = ""
    start: float = 0.5


#: In the order that sorts spans with one start.
KINDS = (
    Kind("email", rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         r"mail|contact|write|reply|correo|kontakt", needs="@"),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"\bip\b|server|host|addr|login", needs="."),
    # A chain of 12 to 19 digits, each after at most one space or hyphen, that cannot be extended.
    Kind("card", r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){11,18}+(?![ -]?[0-9])",
         r"card|visa|credit|debit|karte|tarjeta|carte"),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", r"phone|call|tel|mobile|fax|fon", needs="+"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}+(?![A-Za-z0-9])",
         r"iban|account|bank|konto|cuenta|compte", base=False),
    Kind("national_id", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
         r"\bssn\b|social|security|national|tax", base=False, needs="-", start=0.4),
)


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _characters(value: Column) -> Column:
    """Single characters, with an empty string at the end."""
    return F.split(value, "(?!^)")


def luhn(digits: Column) -> Column:
    """True when every second digit from the right, doubled, brings the digit sum to a multiple of ten."""
    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("sum"))

    def add(acc: Column, c: Column) -> Column:
        d = F.ascii(c) - 48
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        step = F.when(c == "", 0).when(acc.at % 2 == 1, twice).otherwise(d)
        return F.struct((acc.at + 1).alias("at"), (acc["sum"] + step).alias("sum"))

    return F.aggregate(_characters(F.reverse(digits)), start, add, lambda acc: acc["sum"] % 10 == 0)


def mod97(code: Column) -> Column:
    """True when the code, its first four characters moved behind and letters read as 10 to 35, is 1 mod 97."""
    moved = F.concat(F.substr(code, F.lit(5)), F.substring(code, 1, 4))

    def add(acc: Column, c: Column) -> Column:
        a = F.ascii(c)
        return (
            F.when(c == "", acc)
            .when(a >= 65, (acc * 100 + (a - 55)) % 97)
            .otherwise((acc * 10 + (a - 48)) % 97)
        )

    return F.aggregate(_characters(moved), F.lit(0), add) == 1


def _octet(part: Column) -> Column:
    short = F.regexp_replace(part, "^0+(?=[0-9])", "")
    return (F.length(short) < 3) | ((F.length(short) == 3) & (short <= "255"))


def _confirmed(kind: Kind, hit: Column) -> Column:
    if kind.name == "ip":
        return F.forall(F.split(hit, r"\."), _octet)
    if kind.name == "card":
        return luhn(_digits(hit))
    if kind.name == "phone":
        return F.length(_digits(hit)).between(9, 15)
    if kind.name == "iban":
        code = F.replace(hit, F.lit(" "), F.lit(""))
        return F.length(code).between(15, 34) & mod97(code)
    return F.lit(True)


def _spans(number: int, kind: Kind, gaps: Column, hits: Column) -> Column:
    """Confirmed spans of one kind from its matches and the pieces between them."""
    pieces = F.zip_with(
        F.arrays_zip(F.slice(gaps, 1, F.size(hits)).alias("gap"), F.slice(gaps, 2, F.size(hits)).alias("next")),
        hits,
        lambda around, hit: F.struct(
            F.length(around.gap).alias("skip"),
            F.length(hit).alias("size"),
            F.when(_confirmed(kind, hit), hit).alias("hit"),
            F.lower(F.concat(F.right(around.gap, F.lit(CONTEXT)), F.lit(" "), F.left(around.next, F.lit(CONTEXT)))).alias("near"),
        ),
    )
    span = "array<struct<start:int,kind:int,stop:int,hit:string,score:double>>"
    start = F.struct(F.lit(0).alias("at"), F.array().cast(span).alias("found"))

    def add(acc: Column, p: Column) -> Column:
        first = (acc.at + p.skip).cast("int")
        stop = (first + p["size"]).cast("int")
        confirmed = 0.3 if kind.name in ("card", "iban") else 0.1
        score = F.lit(kind.start + confirmed) + F.when(p.near.rlike(kind.context), 0.2).otherwise(0.0)
        one = F.array(F.struct(
            first.alias("start"), F.lit(number).alias("kind"), stop.alias("stop"), p.hit.alias("hit"), score.alias("score")
        )).cast(span)
        keep = p.hit.isNotNull() if kind.base else p.hit.isNotNull() & (score >= MIN_SCORE)
        return F.struct(stop.alias("at"), F.when(keep, F.concat(acc.found, one)).otherwise(acc.found).alias("found"))

    return F.aggregate(pieces, start, add, lambda acc: acc.found)


def with_spans(docs: DataFrame, text: str = "text", into: str = "pii") -> DataFrame:
    """``docs`` with an array of (start, kind, stop, hit, score), ordered by start, then kind.

    The array takes the place of a column called ``into``; all others pass through, whatever their names.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    hits, gaps = {}, {}
    for i, kind in enumerate(KINDS):
        matches = F.regexp_extract_all(body, F.lit(kind.pattern), F.lit(0))
        if kind.needs:
            matches = F.when(F.contains(body, F.lit(kind.needs)), matches).otherwise(F.array().cast("array<string>"))
        hits[f"_hits{i}"] = matches
        gaps[f"_gaps{i}"] = F.when(F.size(F.col(f"_hits{i}")) > 0, F.split(body, kind.pattern, -1))
    # Each step is a projection of its own: its columns are used more than once, so Spark keeps them.
    df = set_apart(docs, text).withColumns(hits).withColumns(gaps)
    none = F.array().cast("array<struct<start:int,kind:int,stop:int,hit:string,score:double>>")
    found = [
        F.when(F.size(f"_hits{i}") > 0, _spans(i, kind, F.col(f"_gaps{i}"), F.col(f"_hits{i}"))).otherwise(none)
        for i, kind in enumerate(KINDS)
    ]
    done = df.withColumn("_found", F.array_sort(F.concat(*found)))
    return put_back(done, docs.columns, text, keep={into: F.col("_found")})


def kind_name(number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(k.name) for k in KINDS]), number + 1)


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", kind_name(s.kind), s.start, s.stop)), ",")


def redact(docs: DataFrame, text: str = "text", into: str = "pii") -> DataFrame:
    """Replace every span of ``into`` by its kind in brackets; overlapping spans become one."""
    body = F.col(text)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def add(acc: Column, s: Column) -> Column:
        mark = F.concat(F.lit("["), F.upper(kind_name(s.kind)), F.lit("]"))
        before = F.substr(body, acc.at + 1, F.greatest(s.start - acc.at, F.lit(0)))
        out = F.when(s.start >= acc.at, F.concat(acc.out, F.array(before, mark))).otherwise(acc.out)
        return F.struct(F.greatest(acc.at, s.stop).alias("at"), out.alias("out"))

    clean = F.aggregate(
        F.col(into), start, add,
        lambda acc: F.array_join(F.concat(acc.out, F.array(F.substr(body, acc.at + 1))), ""),
    )
    return docs.withColumn(text, F.when(F.size(into) > 0, clean).otherwise(body))


@query("op1_pii")
def op1_pii(spark, sf_dir):
    docs = with_spans(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    base = [i for i, kind in enumerate(KINDS) if kind.base]
    spans = F.col("pii")

    def number_of(name: str) -> Column:
        wanted = next(i for i, kind in enumerate(KINDS) if kind.name == name)
        return F.size(F.filter(spans, lambda s: s.kind == wanted)).cast("long")

    return docs.select(
        "doc_id",
        number_of("email").alias("n_email"),
        number_of("ip").alias("n_ip"),
        number_of("card").alias("n_card"),
        number_of("phone").alias("n_phone"),
        F.sha2(spans_text(F.filter(spans, lambda s: s.kind <= max(base))), 256).alias("base_sha256"),
        spans_text(spans).alias("spans"),
        F.array_join(F.transform(spans, lambda s: F.format_number(s.score, 2)), ",").alias("scores"),
    )
