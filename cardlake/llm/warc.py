"""WARC as a content-addressed archive.

Two tables make the archive: ``payloads`` (one row per distinct payload, under
its SHA-256, deflated) and ``records`` (the exact header block of every record, the
digest, and nothing of the payload).  ``read_records`` rebuilds the original
bytes of a record by joining the two.

The payload of a page is its html in UTF-8 (null: empty).  Of records with
equal payloads of at least ``revisit_min_bytes`` the one with the largest key
is the ``response`` and the others are ``revisit`` records that carry no
payload of their own and name the response in WARC-Refers-To; smaller
payloads are all ``response``.

Defined cases: a null url is written as an empty target URI; white space
other than a plain space in a url (it could break a header line) is percent
encoded; a null key is kept (record id ``urn:page:null``) and counts as the
smallest; a key that is no whole number is percent encoded in the header and
read back as ``key_type``; repeated rows give repeated records, of which exactly one can be
the response (the tie is broken by url, then by a row number inside the tie);
an empty table gives an empty archive; extra columns are ignored.

Skew: payloads are collapsed by digest with a map-side combine (one copy a
task at most), so a payload shared by a third of all pages doesn't travel a
third of all times; the join that rebuilds records has plain keys on both
sides, which adaptive execution splits where one is hot.
"""

from __future__ import annotations

import hashlib
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CRLF = "\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_headers(kind: Column, key: Column, url: Column, date: str, sha1: Column,
                   refers_to: Column, length: Column) -> Column:
    """The header block of a record, up to and including the empty line, as text."""
    revisit = kind == "revisit"
    urn = F.concat(F.lit("<urn:page:"), F.coalesce(key.cast("string"), F.lit("null")), F.lit(">"))
    target = F.regexp_replace(F.coalesce(url, F.lit("")), "[\\x00-\\x1F\\x7F]", "%20")
    lines = [F.lit("WARC/1.1"),
             F.concat(F.lit("WARC-Type: "), kind),
             F.concat(F.lit("WARC-Record-ID: "), urn),
             F.concat(F.lit("WARC-Target-URI: "), target),
             F.lit(f"WARC-Date: {date}"),
             F.concat(F.lit("WARC-Payload-Digest: sha1:"), sha1),
             # concat_ws leaves out nulls: these two lines stand in revisit records only
             F.when(revisit, F.concat(F.lit("WARC-Refers-To: <urn:page:"),
                                      refers_to.cast("string"), F.lit(">"))),
             F.when(revisit, F.lit(f"WARC-Profile: {REVISIT_PROFILE}")),
             F.lit("Content-Type: text/html; charset=utf-8"),
             F.concat(F.lit("Content-Length: "),
                      F.when(revisit, F.lit(0)).otherwise(length).cast("string"))]
    return F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF + CRLF))


WHOLE = ("tinyint", "smallint", "int", "bigint")


def _named(key: Column, kind: str) -> Column:
    """A key as headers name it: whole numbers as they are, others so that they can't break a line.

    The text "null" is encoded, too, so that it differs from no key.
    """
    if kind in WHOLE:
        return key
    text = key.cast("string")
    return F.when(text == "null", F.lit("%6Eull")).otherwise(F.url_encode(text))


def write_archive(pages: DataFrame, path: str, key: str = "page_id", url: str = "url",
                  html: str = "html", date: str = "2024-01-01T00:00:00Z",
                  revisit_min_bytes: int = 1000) -> None:
    """Write ``path/payloads`` and ``path/records`` (see the module text)."""
    spark = pages.sparkSession
    kind = dict(pages.dtypes)[key]
    src = pages.select(F.col(key).alias("key"), F.col(url).alias("url"),
                       F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload"))
    packed = src.mapInArrow(_pack, f"key {kind}, url string, sha256 string, "
                                   "packed binary")
    (packed.groupBy("sha256")
     .agg(F.max(F.struct("key", "url")).alias("top"), F.first("packed").alias("packed"))
     .write.mode("overwrite").parquet(f"{path}/payloads"))
    top = spark.read.parquet(f"{path}/payloads").select("sha256", "top")
    # repeated rows become a count, so that one of them can be told apart
    # without a sort of a whole group
    rows = (src.select("key", "url", F.sha2("payload", 256).alias("sha256"),
                       F.sha1("payload").alias("sha1"),
                       F.octet_length("payload").cast("long").alias("n_bytes"))
            .groupBy("sha256", "key", "url", "sha1", "n_bytes").agg(F.count("*").alias("copies")))
    is_top = F.col("key").eqNullSafe(F.col("top.key")) & F.col("url").eqNullSafe(F.col("top.url"))
    revisit = (F.col("n_bytes") >= revisit_min_bytes) & ~(is_top & (F.col("copy") == 0))
    (rows.join(top, "sha256")
     .withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies").cast("int") - 1)))
     .withColumn("kind", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")))
     .select("sha256", record_headers(F.col("kind"), _named(F.col("key"), kind), F.col("url"), date,
                                      F.col("sha1"), _named(F.col("top.key"), kind), F.col("n_bytes"))
             .cast("binary").alias("header"))
     .write.mode("overwrite").parquet(f"{path}/records"))


def _pack(batches):
    for b in batches:
        payloads = b["payload"].to_pylist()
        yield pa.RecordBatch.from_arrays(
            [b["key"], b["url"],
             pa.array([hashlib.sha256(p).hexdigest() for p in payloads], pa.string()),
             pa.array([zlib.compress(p, 4) for p in payloads], pa.binary())],
            names=["key", "url", "sha256", "packed"])


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Original records: ``header``, ``payload`` and ``record`` (the bytes as written).

    The payload is joined by its digest and the digest is computed again from
    the bytes that came back; a payload that doesn't match its address fails
    the job.  A revisit record has no payload of its own; ``payload`` is that
    of the record it refers to.
    """
    records = spark.read.parquet(f"{path}/records")
    payloads = spark.read.parquet(f"{path}/payloads").select("sha256", "packed")
    return records.join(payloads, "sha256").mapInArrow(
        _unpack, "sha256 string, header binary, payload binary, record binary")


def _unpack(batches):
    for b in batches:
        payloads, records = [], []
        for digest, header, packed in zip(b["sha256"].to_pylist(), b["header"].to_pylist(),
                                          b["packed"].to_pylist()):
            payload = zlib.decompress(packed)
            if hashlib.sha256(payload).hexdigest() != digest:
                raise ValueError(f"payload doesn't match its digest {digest}")
            revisit = b"\r\nWARC-Type: revisit\r\n" in header
            payloads.append(payload)
            records.append(header + (b"" if revisit else payload) + b"\r\n\r\n")
        yield pa.RecordBatch.from_arrays(
            [b["sha256"], b["header"], pa.array(payloads, pa.binary()),
             pa.array(records, pa.binary())], names=["sha256", "header", "payload", "record"])


def parse_records(records: DataFrame, key_type: str = "bigint") -> DataFrame:
    """Header fields and payload facts read back out of the records; keys of ``key_type``."""
    # the line end before the empty line stays, so that every field ends in one
    head = F.concat(F.substring_index(F.col("record").cast("string"), CRLF + CRLF, 1), F.lit(CRLF))

    def field(name: str) -> Column:
        return F.regexp_extract(head, f"\r\n{name}: ([^\r\n]*)", 1)

    def page(name: str) -> Column:
        if key_type not in WHOLE:
            named = F.regexp_extract(head, f"\r\n{name}: <urn:page:([^\r\n>]*)>", 1)
            there = head.rlike(f"\r\n{name}: ") & (named != "null")
            return F.when(there, F.url_decode(F.when(there, named))).try_cast(key_type)
        return F.regexp_extract(head, f"\r\n{name}: <urn:page:(-?[0-9]+)>", 1).try_cast(key_type)

    return records.select(
        page("WARC-Record-ID").alias("key"), field("WARC-Target-URI").alias("url"),
        field("WARC-Type").alias("record_type"), page("WARC-Refers-To").alias("refers_to"),
        F.regexp_replace(field("WARC-Payload-Digest"), "^sha1:", "").alias("payload_digest"),
        field("Content-Length").cast("long").alias("content_length"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        (F.octet_length("record") - F.octet_length("header") - 4).cast("long").alias("stored_bytes"),
        F.sha1("payload").alias("sha1"), "sha256", "header", "record")
