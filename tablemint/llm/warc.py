"""WARC archives: writing, reading, and replacing repeated payloads by revisit records.

Archives are written and read by Spark's text source, so they lie on any file system Spark reaches and
a task that is run again leaves nothing twice: a record is one row, and the two line breaks that close
a record separate the rows.  Reading cuts at the version mark and holds each cut against the record's
``Content-Length``.  Where a payload holds the mark itself, the records of that file are put together
again in one streaming pass that holds one record at a time.

``deduplicate`` shuffles headers, never payloads, by payload digest.  One record of each digest stays a
response; the others become revisit records with headers that name it.  Payloads meet the decisions on
the record id, which is unique, so no hot digest gathers payloads in one task; while the decisions are
small enough Spark broadcasts them and payloads are not shuffled at all.

Defined cases: a null payload is empty; a null key or address leaves its header out and reads back as
null; line breaks in an address are written as %0D and %0A; of equal payloads the record with the
largest key stays, numbers before other keys, null below all, and of equal keys the largest record id,
so repeated rows are one response and revisits of it; payloads of any length are written whole; a file
that ends inside a record gives it with ``complete`` false; an empty table gives an archive without
records; only the named columns are read, whatever others are called.  Record ids are unique, as the
format asks.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, stage
from .common import query, table

#: Fixed values of the format.
MARK = "WARC/1."
END = "\r\n\r\n"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "application/http"

#: Payloads below this many bytes are always kept: a revisit record would be no smaller.
LEAST_BYTES = 1_000

#: What a record is, without its payload.
HEADS = [
    "record_type", "record_id", "key", "target_uri", "date", "payload_digest", "payload_bytes",
    "refers_to", "refers_to_uri", "refers_to_date", "content_type", "http", "complete",
]


def page_records(pages: DataFrame, key: str, url: str, payload: str) -> DataFrame:
    """A response record with a fresh id for every row."""
    body = F.coalesce(F.col(payload).cast("binary"), F.lit("").cast("binary"))
    address = F.replace(F.replace(F.col(url).cast("string"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    rows = pages.select(F.col(key).cast("string").alias("key"), address.alias("target_uri"), body.alias("payload"))
    size = F.octet_length("payload").cast("long")
    fields = {
        "record_type": F.lit("response"),
        "record_id": F.concat(F.lit("<urn:uuid:"), F.expr("uuid()"), F.lit(">")),
        "date": F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        "payload_digest": F.sha1("payload"),
        "payload_bytes": size,
        "refers_to": F.lit(None).cast("string"),
        "refers_to_uri": F.lit(None).cast("string"),
        "refers_to_date": F.lit(None).cast("string"),
        "content_type": F.lit(f"{HTTP}; msgtype=response"),
        "http": F.concat(
            F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size.cast("string")
        ),
        "complete": F.lit(True),
    }
    return rows.withColumns(fields).select(*HEADS, "payload")


def write_records(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """Write records as archives: one folder of files, one record per row."""
    body = F.coalesce(F.col("payload").cast("string"), F.lit(""))
    block = F.when(F.col("http").isNull(), body).otherwise(F.concat("http", F.lit(END), body))
    head = F.concat_ws(
        "\r\n",
        F.lit("WARC/1.1"),
        _field("WARC-Type", F.col("record_type")),
        _field("WARC-Record-ID", F.col("record_id")),
        _field("WARC-Date", F.col("date")),
        _field("WARC-Target-URI", F.col("target_uri")),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        _field("WARC-Profile", F.when(F.col("record_type") == "revisit", SAME_PAYLOAD)),
        _field("WARC-Refers-To", F.col("refers_to")),
        _field("WARC-Refers-To-Target-URI", F.col("refers_to_uri")),
        _field("WARC-Refers-To-Date", F.col("refers_to_date")),
        _field("X-Key", F.col("key")),
        _field("Content-Type", F.col("content_type")),
        _field("Content-Length", F.octet_length(block).cast("string")),
    )
    text = records.select(F.concat(head, F.lit(END), block).alias("value"))
    text.write.option("lineSep", END).option("compression", compression).text(path)


def _field(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of archives, compressed or not: ``HEADS`` and the payload.

    The digest of a response is that of the payload as read; that of other records is the one stated.
    """
    pieces = _pieces(spark, path)
    # Files where a cut does not agree with the stated lengths; nearly always none.
    torn = stage(pieces.filter((F.col("value") != "") & ~_whole()).select("file").distinct(), "torn-archives")
    cut = pieces.filter(F.col("value") != "")  # a file begins with a mark, so with an empty piece
    if torn.isEmpty():
        return _parsed(cut.select("value"))
    ordered = (
        pieces.join(torn, "file", "left_semi")
        .select("file", "block", "at", F.col("value").cast("binary").alias("value"))
        .repartition("file")
        .sortWithinPartitions("file", "block", "at")
    )
    mended = ordered.mapInArrow(_mend, "value binary").select(F.col("value").cast("string").alias("value"))
    return _parsed(cut.join(torn, "file", "left_anti").select("value").union(mended))


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """What stands between version marks, with its place; the mark itself is left out."""
    return (
        spark.read.option("lineSep", MARK)
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("at"),
            "value",
        )
    )


def _head() -> Column:
    return F.substring_index("value", END, 1)


def _stated(name: str) -> Column:
    """A header field of the record, or null."""
    return F.nullif(F.regexp_extract(_head(), rf"(?im)^{name}:[ \t]*([^\r\n]*?)[ \t]*$", 1), F.lit(""))


def _whole() -> Column:
    """Whether a piece is exactly the record that its header states."""
    size = F.octet_length(_head()) + 8 + _stated("Content-Length").try_cast("long")
    return F.coalesce((F.substring("value", 2, 2) == "\r\n") & (F.octet_length("value") == size), F.lit(False))


def _parsed(pieces: DataFrame) -> DataFrame:
    start = (F.octet_length(_head()) + 5).cast("int")
    length = F.coalesce(_stated("Content-Length").try_cast("int"), F.lit(0))
    raw = pieces.select(
        _stated("WARC-Type").alias("record_type"),
        _stated("WARC-Record-ID").alias("record_id"),
        _stated("X-Key").alias("key"),
        _stated("WARC-Target-URI").alias("target_uri"),
        _stated("WARC-Date").alias("date"),
        F.lower(F.regexp_replace(_stated("WARC-Payload-Digest"), "(?i)^sha1:", "")).alias("_digest"),
        _stated("WARC-Refers-To").alias("refers_to"),
        _stated("WARC-Refers-To-Target-URI").alias("refers_to_uri"),
        _stated("WARC-Refers-To-Date").alias("refers_to_date"),
        _stated("Content-Type").alias("content_type"),
        _whole().alias("complete"),
        F.substring(F.col("value").cast("binary"), start, length).alias("_block"),
    )
    is_http = F.col("content_type").startswith(HTTP)
    http = F.when(is_http, F.substring_index(F.col("_block").cast("string"), END, 1))
    split = raw.withColumn("http", http)
    body = F.when(
        is_http, F.substring("_block", (F.octet_length("http") + 5).cast("int"), F.octet_length("_block"))
    ).otherwise(F.col("_block"))
    full = split.withColumn("payload", body)
    sent = F.regexp_extract("http", r"(?im)^Content-Length:[ \t]*(\d+)", 1).try_cast("long")
    revisit = F.col("record_type") == "revisit"
    return full.withColumns(
        {
            "payload_digest": F.when(F.col("record_type") == "response", F.sha1("payload")).otherwise(F.col("_digest")),
            "payload_bytes": F.when(revisit, sent).otherwise(F.octet_length("payload").cast("long")),
        }
    ).select(*HEADS, "payload")


def _mend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records from pieces in file order: a record takes pieces until its stated length is reached."""
    mark, end = MARK.encode(), END.encode()
    file, held, wanted = None, bytearray(), 0

    def size_of(piece: bytes) -> int:
        head, found, _ = piece.partition(end)
        for line in head.split(b"\r\n"):
            name, _, value = line.partition(b":")
            if found and name.strip().lower() == b"content-length" and value.strip().isdigit():
                return len(head) + 8 + int(value)
        return 0

    for batch in batches:
        done = []
        for row in batch.to_pylist():
            if row["file"] == file and held and len(held) < wanted:
                held += mark + row["value"]
                continue
            if held:
                done.append(bytes(held))
            file, held, wanted = row["file"], bytearray(row["value"]), size_of(row["value"])
        yield pa.RecordBatch.from_arrays([pa.array(done, pa.binary())], ["value"])
    if held:
        yield pa.RecordBatch.from_arrays([pa.array([bytes(held)], pa.binary())], ["value"])


def originals(heads: DataFrame) -> DataFrame:
    """The response that stays for every digest that several records have.

    An aggregate with a map-side step, so a digest of a third of all records costs a task one row.
    """
    rank = F.struct(F.col("key").try_cast("decimal(38,0)"), "key", "record_id", "target_uri", "date")
    return (
        heads.groupBy("payload_digest")
        .agg(F.count("*").alias("_n"), F.max(F.when(F.col("record_type") == "response", rank)).alias("original"))
        .filter("_n > 1 and original is not null")
        .select("payload_digest", "original")
    )


def revisits(heads: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """Headers of the records that repeat a payload, each with fresh headers naming the original."""
    shared = heads.filter(F.col("record_type").isin("response", "revisit") & (F.col("payload_bytes") >= least))
    repeated = shared.join(originals(shared), "payload_digest").filter("record_id <> original.record_id")
    return repeated.withColumns(
        {
            "record_type": F.lit("revisit"),
            "refers_to": F.col("original.record_id"),
            "refers_to_uri": F.col("original.target_uri"),
            "refers_to_date": F.col("original.date"),
        }
    ).select(*HEADS)


def deduplicate(spark: SparkSession, source: str, target: str, least: int = LEAST_BYTES) -> None:
    """Write the archives of ``source`` anew, each payload once.

    Records of other types pass unchanged; a revisit record whose digest has a response is pointed at
    the response that stays.
    """
    records = read_records(spark, source)
    heads = stage(records.select(*HEADS), "warc-headers")
    repeated = stage(revisits(heads, least), "warc-revisits")
    kept = records.join(repeated.select("record_id"), "record_id", "left_anti").select(*HEADS, "payload")
    write_records(kept.union(repeated.withColumn("payload", F.lit(None).cast("binary"))), target)


def resolved(records: DataFrame) -> DataFrame:
    """Every record's headers with ``original_key``: for a revisit the key of the response it refers to."""
    heads = records.select(*HEADS)
    named = heads.filter("record_type = 'response'").select(
        F.col("record_id").alias("_target"), F.col("key").alias("original_key")
    )
    pointing = heads.filter("record_type = 'revisit'")
    return (
        pointing.join(named, pointing["refers_to"] == named["_target"], "left")
        .drop("_target")
        .unionByName(heads.filter("record_type <> 'revisit'").withColumn("original_key", F.lit(None).cast("string")))
    )


OP11_SQL = """
WITH heads AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
  FROM pages),
chosen AS (
  SELECT *, CASE WHEN payload_bytes >= 1000
                 THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS original
  FROM heads)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> original THEN original END AS refers_to
FROM chosen
"""


@query("op11_warc", OP11_SQL)
def op11_warc(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    captured, archives = scratch_path(spark, "warc-captured"), scratch_path(spark, "warc-archives")
    write_records(page_records(pages, "page_id", "url", "html"), captured)
    deduplicate(spark, captured, archives)
    return resolved(read_records(spark, archives)).select(
        F.col("key").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("original_key").cast("long").alias("refers_to"),
    )
