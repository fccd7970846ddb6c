"""Mixing to target weights by iterative proportional fitting.

Each document stands for its number of words.  The words of every (source, language, topic) cell are
summed, and the cell weights are raked: scaled in turn so that the sums by source, by language and by
topic meet their targets.  A target is a share given by name, or a tempered share: the power ``temper``
of the share found, which lifts what is rare.  A document is wanted c times its cell's factor.  c is
solved over the cells so that the expected words of the kept documents are ``share`` of all words, each
document taken once: a wanted number under one is the probability to be kept, one of one or more keeps
the document, and ``_repeats`` says how often to take it so that the words have the raked shares.  So
a rare cell takes nothing from the others.  Without a share, c makes the most wanted cell's number
one.  The draw is a hash of the id: the same for every run and order.

Defined cases: a null source or language is a value of its own, written as an empty string; a null or
empty text has no words, weighs nothing and gets its cell's probability (0 in a cell without words);
equal rows share the same draw; null ids draw as empty text; an empty table gives an empty result;
the columns of the input pass through and only those named below are added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import put_back, query, set_apart, table

DIMENSIONS = ("source", "lang", "topic")
ROUNDS = 8
TEMPER = 0.9
#: Expected words of the kept documents, as a share of all words.
SHARE = 0.7


def topic_of(text: str = "text") -> Column:
    """A topic from the form of the text, by SQL functions alone."""
    body = F.coalesce(F.col(text), F.lit(""))
    return (
        F.when(F.contains(body, F.lit("@")), "contact")
        .when(F.contains(body, F.lit(" | ")), "listing")
        .when(F.length(body) < 1000, "note")
        .when(F.length(body) < 4000, "article")
        .otherwise("longform")
    )


def word_count(text: str = "text") -> Column:
    body = F.coalesce(F.col(text), F.lit(""))
    return F.regexp_count(body, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def rake(cells: DataFrame, targets: dict[str, dict[str, float]] | None = None, temper: float = TEMPER, rounds: int = ROUNDS) -> DataFrame:
    """Cells (source, lang, topic, words) with ``factor``: target words over words."""
    targets = targets or {}
    cells = stage(cells.withColumn("w", F.col("words").cast("double")), "rake-cells")
    total = cells.agg(F.coalesce(F.sum("w"), F.lit(0.0))).first()[0]
    wanted = {}
    for name in DIMENSIONS:
        share = cells.groupBy(name).agg(F.sum("w").alias("have"))
        if name in targets:
            given = F.create_map(*[F.lit(x) for item in targets[name].items() for x in item])
            goal = F.coalesce(given[F.col(name)], F.lit(0.0))
        else:
            goal = F.when(F.col("have") > 0, F.pow(F.col("have") / F.lit(total or 1.0), F.lit(temper))).otherwise(0.0)
        goals = share.select(name, goal.alias("goal"))
        whole = goals.agg(F.sum("goal")).first()[0] or 1.0
        wanted[name] = stage(goals.select(name, (F.col("goal") * (total / whole)).alias("goal")), f"rake-{name}")
    state = cells
    for _ in range(rounds):
        for name in DIMENSIONS:
            sums = state.groupBy(name).agg(F.sum("w").alias("have")).join(wanted[name], name)
            scale = sums.select(name, F.when(F.col("have") > 0, F.col("goal") / F.col("have")).otherwise(0.0).alias("scale"))
            state = state.join(scale, name).select(*DIMENSIONS, "words", (F.col("w") * F.col("scale")).alias("w"))
        state = stage(state, "rake-round")
    return state.withColumn("factor", F.when(F.col("words") > 0, F.col("w") / F.col("words")).otherwise(0.0))


def scale_of(factors: DataFrame, share: float) -> float:
    """c for which the words of all cells, each times min(1, c * factor), sum to ``share`` of all words.

    Cells that reach one are taken whole and c rises for the others, until no more cells reach one.
    Where the cells of factor zero hold more than the rest of the words, all other cells are whole.
    """
    words = F.col("words").cast("double")
    total = factors.agg(F.coalesce(F.sum(words), F.lit(0.0))).first()[0]
    c = share
    while True:
        whole = F.col("factor") * F.lit(c) >= 1
        taken, rest = factors.agg(
            F.coalesce(F.sum(F.when(whole, words)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~whole, words * F.col("factor"))), F.lit(0.0)),
        ).first()
        if rest <= 0 or (share * total - taken) / rest <= c * (1 + 1e-9):
            return c
        c = (share * total - taken) / rest


def draw(key: str) -> Column:
    """A number in [0, 1) from the id."""
    digits = F.substring(F.md5(F.coalesce(F.col(key).cast("string"), F.lit(""))), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / float(1 << 52)


def mix(
    docs: DataFrame, key: str = "doc_id", text: str = "text", targets=None, temper: float = TEMPER, share: float | None = SHARE
) -> DataFrame:
    """``docs`` with ``_source``, ``_lang``, ``_topic``, ``_words``, ``_weight`` (the factor), ``_probability``,
    ``_kept`` and ``_repeats``.

    These take the place of columns of their names; all others pass through, whatever they are called.
    """
    read = list(dict.fromkeys([key, text, "source", "lang"]))
    described = set_apart(docs, *read).withColumns({"_topic": topic_of(text), "_words": word_count(text)})
    name = {"_source": F.coalesce("source", F.lit("")), "_lang": F.coalesce("lang", F.lit(""))}
    described = described.withColumns(name)
    cells = described.groupBy(
        F.col("_source").alias("source"), F.col("_lang").alias("lang"), F.col("_topic").alias("topic")
    ).agg(F.sum("_words").alias("words"))
    factors = stage(rake(cells, targets, temper), "rake-factors")
    if share is None:
        wanted = F.col("factor") / F.lit(factors.agg(F.max("factor")).first()[0] or 1.0)
    else:
        wanted = F.col("factor") * F.lit(scale_of(factors, share))
    lookup = factors.select(
        F.col("source").alias("_source"), F.col("lang").alias("_lang"), F.col("topic").alias("_topic"),
        F.col("factor").alias("_weight"), F.least(wanted, F.lit(1.0)).alias("_probability"), wanted.alias("_wanted"),
    )
    joined = described.join(lookup, ["_source", "_lang", "_topic"], "left")
    more = draw(key) < F.col("_wanted") - F.floor("_wanted")
    repeats = F.floor("_wanted") + more.cast("long")
    made = {name: F.col(name) for name in ("_source", "_lang", "_topic", "_words", "_weight", "_probability")}
    made |= {"_kept": draw(key) < F.col("_probability"), "_repeats": repeats}
    return put_back(joined, docs.columns, *read, keep=made)


def _sql(rounds: int = ROUNDS, temper: float = TEMPER) -> str:
    """The same raking as one chain of named steps."""
    steps = [
        """d AS MATERIALIZED (
  SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang,
         CASE WHEN contains(coalesce(text, ''), '@') THEN 'contact'
              WHEN contains(coalesce(text, ''), ' | ') THEN 'listing'
              WHEN length(coalesce(text, '')) < 1000 THEN 'note'
              WHEN length(coalesce(text, '')) < 4000 THEN 'article' ELSE 'longform' END AS topic,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS n_words,
         CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13)) AS BIGINT) / 4503599627370496.0 AS u
  FROM documents)""",
        """s0 AS MATERIALIZED (
  SELECT source, lang, topic, sum(n_words) AS words, CAST(sum(n_words) AS DOUBLE) AS w FROM d GROUP BY ALL)""",
    ]
    for name in DIMENSIONS:
        steps.append(
            f"g_{name} AS MATERIALIZED (SELECT {name}, p * (SELECT sum(w) FROM s0) / sum(p) OVER () AS goal FROM ("
            f"SELECT {name}, CASE WHEN sum(w) > 0 THEN pow(sum(w) / (SELECT sum(w) FROM s0), {temper}) ELSE 0 END AS p "
            f"FROM s0 GROUP BY {name}))"
        )
    at = 0
    for _ in range(rounds):
        for name in DIMENSIONS:
            steps.append(
                f"s{at + 1} AS MATERIALIZED (SELECT s.source, s.lang, s.topic, words, "
                f"CASE WHEN h.have > 0 THEN w * goal / h.have ELSE 0 END AS w FROM s{at} s "
                f"JOIN (SELECT {name}, sum(w) AS have FROM s{at} GROUP BY {name}) h ON s.{name} = h.{name} "
                f"JOIN g_{name} g ON s.{name} = g.{name})"
            )
            at += 1
    steps.append(
        f"f AS MATERIALIZED (SELECT source, lang, topic, CASE WHEN words > 0 THEN w / words ELSE 0 END AS factor FROM s{at})"
    )
    return "WITH " + ",\n".join(steps) + """
SELECT doc_id, d.source, d.lang, d.topic, n_words, round(factor, 6) AS weight,
       round(factor / (SELECT max(factor) FROM f), 6) AS probability,
       u < factor / (SELECT max(factor) FROM f) AS kept
FROM d JOIN f ON d.source = f.source AND d.lang = f.lang AND d.topic = f.topic"""


OP10_SQL = _sql()


@query("op10_mixing", OP10_SQL)
def op10_mixing(spark, sf_dir):
    mixed = mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang"), share=None)
    return mixed.select(
        "doc_id",
        F.col("_source").alias("source"),
        F.col("_lang").alias("lang"),
        F.col("_topic").alias("topic"),
        F.col("_words").alias("n_words"),
        F.round("_weight", 6).alias("weight"),
        F.round("_probability", 6).alias("probability"),
        F.col("_kept").alias("kept"),
    )
