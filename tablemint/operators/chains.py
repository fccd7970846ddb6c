"""Following landed pages from cursor to cursor.

A page answers a cursor (null for the first page of an endpoint) and names the next one, or none.  Which
pages a reader would have met, and in which order, is a walk of one step a page; here it takes one round
of joins per doubling of the distance, over all endpoints at once.  Long chains are first shortened, by
rounds that each leave three quarters of the steps, so all rounds together move a fixed multiple of the
pages.  Rounds are written to the shared folder, so a lost executor costs one round.  Every join is on one
page's own cursor, so an endpoint with most of the pages is spread like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage

#: The id of a first page; other ids begin with a sign of their own, so no cursor equals it.
_FIRST = ""

#: Steps that are followed by doubling; more are shortened first.
DOUBLED_STEPS = 200_000


def _page_id(cursor: str):
    return F.coalesce(F.concat(F.lit("="), F.col(cursor)), F.lit(_FIRST))


def _answers(pages: DataFrame) -> DataFrame:
    """One row per cursor that was answered: the page it leads to, and how many answers differ.

    Where answers differ, the smallest next cursor is followed.
    """
    named = F.when(F.col("next").isNotNull(), _page_id("next"))
    return (
        pages.select("endpoint", _page_id("cursor").alias("id"), named.alias("to"))
        .groupBy("endpoint", "id")
        .agg(F.min("to").alias("to"), (F.count_distinct("to") + F.max(F.col("to").isNull().cast("int"))).alias("answers"))
    )


def chain_positions(pages: DataFrame) -> DataFrame:
    """``(endpoint, id, position)`` of every cursor met from the first page on, which has position 0.

    ``pages(endpoint, cursor, next)``.  A chain that returns to a page stops there, and one that names a
    page which has not landed stops before it.
    """
    return _positions(stage(_answers(pages), "page-answers"))


def _positions(answers: DataFrame) -> DataFrame:
    landed = answers.select("endpoint", F.col("id").alias("to"))
    steps = answers.select("endpoint", "id", "to").join(landed, ["endpoint", "to"])
    steps = stage(steps.select("endpoint", "id", "to", F.lit(1).cast("long").alias("length")), "page-steps")
    count, bypassed = steps.count(), []
    while count > DOUBLED_STEPS:
        steps, passed = _shortened(steps, len(bypassed))
        bypassed.append(passed)
        # Steps of one page onto itself are never passed by, so a round may find nothing more.
        before, count = count, steps.count()
        if count > before * 0.95:
            break
    met = _doubled(answers, steps)
    for passed in reversed(bypassed):
        behind = passed.join(met, ["endpoint", "id"]).groupBy("endpoint", F.col("to").alias("id")).agg(F.min(F.col("position") + F.col("length")))
        met = stage(met.union(behind), "met-pages")
    return met


def _shortened(steps: DataFrame, number: int) -> tuple[DataFrame, DataFrame]:
    """Steps past about a quarter of the pages, and the steps that led to those pages.

    A page is passed by when it draws 0 and the page it leads to draws 1, so no two pages in a row are, and
    the step that leads to one continues to the next page.  First pages draw 1, as no step leads to them.
    """
    draw = lambda page: F.when(F.col(page) == _FIRST, 1).otherwise(F.pmod(F.xxhash64("endpoint", page, F.lit(number)), F.lit(2)))
    drawn = steps.withColumn("_own", draw("id")).withColumn("_next", draw("to"))
    between = (F.col("_own") == 0) & (F.col("_next") == 1)
    kept = drawn.filter(~between)
    passed = drawn.filter(between).select("endpoint", F.col("id").alias("to"), F.col("to").alias("onward"), F.col("length").alias("_further"))
    # Only a step whose target drew 0 may lead to a page that is passed by.
    led = stage(kept.filter("_next = 0").select("endpoint", "id", "to", "length").join(passed, ["endpoint", "to"], "left"), "led-steps")
    column = lambda further, plain: F.when(F.col("onward").isNotNull(), further).otherwise(plain)
    longer = led.select(
        "endpoint", "id", column(F.col("onward"), F.col("to")).alias("to"),
        column(F.col("length") + F.col("_further"), F.col("length")).alias("length"),
    )
    rest = kept.filter("_next = 1").select("endpoint", "id", "to", "length")
    return stage(rest.union(longer), "page-steps"), led.filter("onward is not null").select("endpoint", "id", "to", "length")


def _doubled(answers: DataFrame, jumps: DataFrame) -> DataFrame:
    met = stage(
        answers.filter(F.col("id") == _FIRST).select("endpoint", "id", F.lit(0).cast("long").alias("position")), "met-pages"
    )
    known = met.count()
    while True:
        # Everything within some number of steps of the start is known; a jump of as many doubles that.
        ahead = met.join(jumps, ["endpoint", "id"]).select("endpoint", F.col("to").alias("id"), F.col("position") + F.col("length"))
        met = stage(met.union(ahead).groupBy("endpoint", "id").agg(F.min("position").alias("position")), "met-pages")
        found = met.count()
        if found == known:
            return met
        known = found
        onward = jumps.select("endpoint", F.col("id").alias("to"), F.col("to").alias("onward"), F.col("length").alias("_further"))
        jumps = stage(
            jumps.join(onward, ["endpoint", "to"]).select(
                "endpoint", "id", F.col("onward").alias("to"), (F.col("length") + F.col("_further")).alias("length")
            ),
            "page-jumps",
        )


def in_chain_order(pages: DataFrame) -> DataFrame:
    """Pages with ``chain_position``: how many pages stand before each; null where no chain leads to it."""
    met = chain_positions(pages).withColumnRenamed("endpoint", "_endpoint").withColumnRenamed("position", "chain_position")
    joined = pages.withColumn("_id", _page_id("cursor")).join(
        met, (F.col("endpoint") == F.col("_endpoint")) & (F.col("_id") == F.col("id")), "left"
    )
    return joined.select(*pages.columns, "chain_position")


def chain_problems(pages: DataFrame) -> DataFrame:
    """What keeps an endpoint's pages from being one finished chain, as ``(endpoint, problem, cursor)``.

    ``pages(endpoint, cursor, next, rows, has_more)``, one row a landed page.  Problems:

    * ``noFirstPage``: pages landed, but none that a chain could start from;
    * ``differingAnswers``: one cursor was answered by different next cursors;
    * ``loop``: a page met on the chain leads back to a page met no later;
    * ``missingPage``: a page met on the chain names one that has not landed;
    * ``repeatedCursor``: pages of different cursors, at least one off the chain, name the same next one;
    * ``unreached``: a landed page that the chain from the first page never meets;
    * ``unfinished``: the page that ends the chain has rows and says that there are more.
    """
    answers = stage(_answers(pages), "page-answers")
    met = stage(_positions(answers), "met-pages")
    placed = stage(answers.join(met, ["endpoint", "id"], "left"), "placed-pages")
    targets = placed.select(
        "endpoint", F.col("id").alias("to"), F.col("position").alias("to_position"), F.lit(True).alias("landed")
    )
    led = placed.filter(F.col("to").isNotNull()).join(targets, ["endpoint", "to"], "left")
    on_chain = F.col("position").isNotNull()

    def problem(df: DataFrame, name: str, page: str | None) -> DataFrame:
        cursor = F.lit(None).cast("string") if page is None else F.when(F.col(page) != _FIRST, F.substring(F.col(page), 2, 2**31 - 1))
        return df.select("endpoint", F.lit(name).alias("problem"), cursor.alias("cursor"))

    starts = answers.groupBy("endpoint").agg(F.max((F.col("id") == _FIRST).cast("int")).alias("started"))
    loops = led.filter(on_chain & (F.col("to_position") <= F.col("position")))
    missing = led.filter(on_chain & F.col("landed").isNull())
    # Naming pages are counted per cursor before anything is joined, so a hot cursor is one row.
    named = led.groupBy("endpoint", "to").agg(F.count("*").alias("n"), F.max(F.col("position").isNull().cast("int")).alias("off"))
    last = F.when(F.col("next").isNull() & F.col("has_more") & (F.col("rows") > 0), True)
    ends = pages.filter(last).select("endpoint", _page_id("cursor").alias("id")).distinct()
    return (
        problem(starts.filter("started = 0"), "noFirstPage", None)
        .union(problem(answers.filter("answers > 1"), "differingAnswers", "id"))
        .union(problem(loops, "loop", "to"))
        .union(problem(missing, "missingPage", "to"))
        .union(problem(named.filter("n > 1 and off = 1"), "repeatedCursor", "to"))
        .union(problem(placed.filter(~on_chain), "unreached", "id"))
        .union(problem(ends.join(met, ["endpoint", "id"], "left_semi"), "unfinished", "id"))
    )
