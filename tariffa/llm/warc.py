"""A content-addressed web archive.

Payload bytes are stored once, under their SHA-256; the exact header bytes of every record (the
WARC fields and the HTTP head) are stored apart, with that digest as reference.  Joining the two on the
digest gives the original records back, byte for byte.  Writing checks that payloads sharing a digest are
equal byte for byte, reading checks every payload against its digest; either raises an error otherwise.

A null payload counts as empty and a null URL is left out of the header.  Of records with equal payloads
the one with the smallest identifier is the response (a null identifier comes last; of repeated rows the
first in the files), the others revisit it.  Payloads below ``min_bytes`` are never revisits.  An empty table
gives an empty archive; further columns are ignored.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffa.llm.common import with_locator
from tariffa.session import new_table_path
from tariffa.sources.sinks import stored

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"


def sha1_base32(content: Column) -> Column:
    """Bare upper-case base32: five hex digits are four letters of five bits."""
    hexed = F.sha1(content)
    letters = []
    for start in range(1, 41, 5):
        bits = F.conv(F.substring(hexed, start, 5), 16, 10).cast("int")
        letters += [
            F.substring(F.lit(BASE32), (F.shiftright(bits, shift) % 32 + 1).cast("int"), F.lit(1)) for shift in (15, 10, 5, 0)
        ]
    return F.concat(*letters)


def _headers(date: str) -> Column:
    """Header bytes of a record; the row has id, url, bytes, sha1, response and first."""

    def line(name: str, value: Column) -> Column:
        # a null value leaves the line out
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))

    def record_id(key: Column) -> Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(key.cast("string"), F.lit("")), F.lit(">"))

    kind = F.when(F.col("response"), "response").otherwise("revisit")
    revisit = ~F.col("response")
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("bytes").cast("string"),
        F.lit(END),
    )
    length = F.octet_length(http) + F.when(F.col("response"), F.col("bytes")).otherwise(0)
    return F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", kind),
        line("WARC-Record-ID", record_id(F.col("id"))),
        line("WARC-Date", F.lit(date)),
        # a line break in an address would end the field
        line("WARC-Target-URI", F.regexp_replace("url", r"[\r\n]", " ")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        line("WARC-Profile", F.when(revisit, PROFILE)),
        line("WARC-Refers-To", F.when(revisit, record_id(F.col("first")))),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", length.cast("string")),
        F.lit("\r\n"),
        http,
    )


def write_archive(
    pages: DataFrame,
    folder: str,
    id: str = "page_id",
    url: str = "url",
    payload: str = "html",
    min_bytes: int = 0,
    date: str = "2024-01-01T00:00:00Z",
) -> str:
    """Write the two stores below ``folder``: ``payloads`` (digest, payload) and ``headers`` (header, digest)."""
    content = F.encode(F.coalesce(F.col(payload), F.lit("")), "UTF-8")
    full = with_locator(pages, id, url, payload).select(
        F.col(id).alias("id"), F.col(url).alias("url"), content.alias("payload"), "_file", "_row"
    ).withColumn("digest", F.sha2("payload", 256))

    # equal digests are combined inside each task; both ends of their byte order must meet
    spans = full.groupBy("digest").agg(F.min("payload").alias("least"), F.max("payload").alias("most"))
    checked = F.when(F.col("least") == F.col("most"), F.col("least")).otherwise(
        F.raise_error(F.concat(F.lit("different payloads under digest "), F.col("digest")))
    )
    spans.select("digest", checked.alias("payload")).write.option("compression", "zstd").parquet(
        os.path.join(folder, "payloads")
    )

    # identifiers that are null come after all others
    order = F.struct(F.isnull("id").alias("unknown"), "id", "_file", "_row")
    narrow = stored(
        full.select("id", "url", "digest", F.octet_length("payload").cast("long").alias("bytes"), sha1_base32(F.col("payload")).alias("sha1"), order.alias("place")),
        "records",
    )
    first = narrow.groupBy("digest").agg(F.min("place").alias("start"))
    placed = narrow.join(first, "digest").select(
        "id",
        "url",
        "digest",
        "bytes",
        "sha1",
        ((F.col("bytes") < min_bytes) | (F.col("place") == F.col("start"))).alias("response"),
        F.col("start.id").alias("first"),
    )
    placed.select(F.encode(_headers(date), "UTF-8").alias("header"), "digest").write.option("compression", "zstd").parquet(
        os.path.join(folder, "headers")
    )
    return folder


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """The original records, rebuilt by a join: record bytes, and the payload they stand for with its length and SHA-1.

    Digests and lengths are taken once for each payload, before the join: a payload that a third of all records revisit is
    digested once, and the records that revisit it are narrow rows.
    """
    headers = spark.read.parquet(os.path.join(folder, "headers"))
    payloads = spark.read.parquet(os.path.join(folder, "payloads"))
    sound = F.when(F.sha2("payload", 256) == F.col("digest"), F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("damaged payload "), F.col("digest")))
    )
    known = payloads.select(
        "digest",
        sound.alias("payload"),
        sha1_base32(F.col("payload")).alias("payload_sha1"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
    )
    joined = headers.join(known, "digest")
    # a revisit's block is the HTTP head alone
    response = F.encode(F.lit("WARC/1.1\r\nWARC-Type: response\r\n"), "UTF-8")
    own = F.when(F.startswith("header", response), F.col("payload")).otherwise(
        F.encode(F.lit(""), "UTF-8")
    )
    return joined.select(
        F.concat("header", own, F.encode(F.lit(END), "UTF-8")).alias("record"),
        "payload",
        "payload_sha1",
        "payload_bytes",
        F.octet_length("header").alias("head_bytes"),
    )


def parse_records(records: DataFrame) -> DataFrame:
    """Fields of each record, read from the record's bytes."""
    head = F.decode(F.substring(F.col("record"), F.lit(1), F.col("head_bytes")), "UTF-8")

    def value(name: str) -> Column:
        # only the WARC fields: they end at the first empty line
        found = F.regexp_extract(F.substring_index("head", END, 1), rf"(?:^|\r\n){name}: ([^\r\n]*)", 1)
        return F.when(found != "", found)

    def page(name: str) -> Column:
        return F.regexp_extract(value(name), r"^<urn:page:(.*)>$", 1)

    parsed = records.withColumn("head", head).select(
        F.nullif(page("WARC-Record-ID"), F.lit("")).cast("long").alias("id"),
        value("WARC-Type").alias("record_type"),
        value("WARC-Target-URI").alias("url"),
        F.substring(value("WARC-Payload-Digest"), 6, 32).alias("payload_digest"),
        F.nullif(page("WARC-Refers-To"), F.lit("")).cast("long").alias("refers_to"),
        value("Content-Length").cast("long").alias("content_length"),
        "record",
        "payload",
        "payload_sha1",
        "payload_bytes",
    )
    return parsed


def archive_and_read(pages: DataFrame, folder: str | None = None, **names) -> DataFrame:
    """Write an archive, read it back and check the digest each header states against its payload."""
    spark = pages.sparkSession
    folder = write_archive(pages, folder or new_table_path(spark, "archive"), **names)
    parsed = parse_records(read_records(spark, folder))
    stated = F.when(F.col("payload_sha1") == F.col("payload_digest"), F.col("payload_digest")).otherwise(
        F.raise_error(F.lit("a header's digest differs from its payload"))
    )
    return parsed.withColumn("payload_digest", stated).drop("payload_sha1")
