"""Comment threads: comments with one level of replies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import is_present, positive_count
from .notes import note_rows

COMMENT_COLUMNS = [
    "file_id", "comment_id", "text", "author", "author_email",
    "frame", "created_at", "updated_at", "reply_to",
]


def flatten_threads(threads: DataFrame) -> DataFrame:
    """Comments and their replies as rows of one shape; a reply names its parent.

    ``threads(file_id, id, text, owner<name,email>, timestamp, created_at, updated_at,
    replies array<...>)``.  A comment and its replies leave one row through one generator, so
    the table is scanned once and nothing is shuffled.
    """
    def line(source, parent):
        return F.struct(
            source("id").alias("comment_id"),
            source("text").alias("text"),
            source("owner")["name"].alias("author"),
            source("owner")["email"].alias("author_email"),
            source("timestamp").alias("frame"),
            source("created_at").alias("created_at"),
            source("updated_at").alias("updated_at"),
            parent.alias("reply_to"),
        )

    own = F.array(line(F.col, F.lit(None).cast(threads.schema["id"].dataType)))
    replies = F.transform(
        F.coalesce(F.col("replies"), F.array()), lambda r: line(lambda n: r[n], F.col("id"))
    )
    return threads.select("file_id", F.inline(F.concat(own, replies)))


def wanted_children(parents: DataFrame, count: str) -> DataFrame:
    """Only the parents that declare at least one child."""
    return parents.filter(positive_count(count) > 0)


def child_shortfall(parents: DataFrame, threads: DataFrame, count: str) -> DataFrame:
    """Parents that declare more children than arrived; replies count as children.

    The thread rows are summed per parent before the join.
    """
    arrived = threads.groupBy("file_id").agg(
        F.count("*").alias("comments"),
        F.sum(1 + F.coalesce(F.size("replies"), F.lit(0))).cast("bigint").alias("got"),
    )
    expected = wanted_children(parents, count).select(
        "file_id", positive_count(count).cast("bigint").alias("expected")
    )
    return (
        expected.join(arrived, "file_id", "left")
        .withColumn("got", F.coalesce("got", F.lit(0).cast("bigint")))
        .withColumn("comments", F.coalesce("comments", F.lit(0).cast("bigint")))
        .filter(F.col("got") < F.col("expected"))
    )


def shortfall_notes(shortfall: DataFrame) -> DataFrame:
    return note_rows(
        shortfall, "commentCountShort", F.col("file_id"),
        F.concat(
            F.lit("the count says "), "expected", F.lit(" but "), "got", F.lit(" came back ("),
            "comments", F.lit(" comment(s) and their replies)"),
        ),
    )


def fill_author(replies: DataFrame, listing: DataFrame) -> DataFrame:
    """Give replies without an author the one a second listing names.

    ``listing(comment_id, author)`` has one author per comment; an author it does not know
    stays null and the text is kept.  ``author_known`` tells the two apart.
    """
    known = listing.groupBy("comment_id").agg(F.max("author").alias("_author"))
    filled = replies.join(known, "comment_id", "left")
    return (
        filled.withColumn("author", F.coalesce("author", "_author"))
        .withColumn("author_known", F.col("author").isNotNull())
        .drop("_author")
    )


def author_notes(filled: DataFrame) -> DataFrame:
    return note_rows(
        filled.filter(F.col("reply_to").isNotNull() & ~F.col("author_known")),
        "replyAuthorUnavailable",
        F.col("comment_id"),
        "the reply is kept without its author",
    )


def textless(comments: DataFrame) -> DataFrame:
    """One row: comments that carry no text."""
    return comments.agg(F.count_if(~is_present("text")).alias("n"))


def textless_notes(comments: DataFrame, where: str) -> DataFrame:
    return note_rows(
        textless(comments).filter("n > 0"), "commentWithoutText", where, F.concat("n", F.lit(" comment(s) carry no text"))
    )
