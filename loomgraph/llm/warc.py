"""WARC (operator 10): a content-addressed archive.

archive() writes two tables into a folder: payloads, each distinct one once under its SHA-256, and headers, the
exact header block of every record with the digest of its payload. records() reconstructs the records, byte for
byte, by joining the two, verifies each payload against its digest and parses what it put together; parse()
reads any WARC bytes. Only digests and ids are grouped; a payload crosses the network once, to its store.

Defined results: null html is an empty payload; null url is an empty target; rows with a null or repeated page_id
get records of their own, of which those that carry the smallest id of a payload are its responses; an empty
table makes empty archives; other columns are not stored.
"""

from __future__ import annotations

import base64
import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

VERSION = b"WARC/1.1"


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def header(kind: str, page_id, url: str, size: int, digest: str, refers_to) -> bytes:
    """The exact header block, with the empty line that ends it."""
    lines = [f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{page_id}>", f"WARC-Target-URI: {url}", "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}"]
    if kind == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {size if kind == 'response' else 0}"]
    return VERSION + b"\r\n" + "\r\n".join(x.replace("\r", " ").replace("\n", " ") for x in lines).encode() + b"\r\n\r\n"


def parse(data: bytes) -> list[tuple[dict[str, str], bytes]]:
    """(fields, block) of each record."""
    out, at = [], 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/", at):
            raise ValueError(f"no record at byte {at}")
        fields = dict(line.split(": ", 1) for line in data[at:end].decode().split("\r\n")[1:])
        size = int(fields["Content-Length"])
        block = data[end + 4 : end + 4 + size]
        if len(block) != size or data[end + 4 + size : end + 8 + size] != b"\r\n\r\n":
            raise ValueError(f"a record's block is cut short at byte {end + 4}")
        out.append((fields, block))
        at = end + 8 + size
    return out


def _digests(batches):
    for b in common.slices(batches):
        raw = [x or b"" for x in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(map(len, raw), pa.int64()), pa.array([digest32(x) for x in raw], pa.string()), pa.array([hashlib.sha256(x).digest() for x in raw], pa.binary()), b.column(2)], ["page_id", "size", "digest", "strong", "url"])


def _headers(batches):
    for b in batches:
        rows = [b.column(i).to_pylist() for i in range(6)]
        kinds = ["response" if first is None or i is None or i == first else "revisit" for i, first in zip(rows[0], rows[5])]
        blocks = [header(k, i, url or "", n, d, first) for k, i, n, d, url, first in zip(kinds, rows[0], rows[1], rows[2], rows[4], rows[5])]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(3), pa.array(blocks, pa.binary())], ["page_id", "strong", "header"])


def archive(pages: DataFrame, folder: str) -> None:
    """Writes folder/headers and folder/payloads for pages (page_id, url, html)."""
    spark = pages.sparkSession
    src = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("html", F.lit("")).cast("binary").alias("payload"), "url")
    seen = src.mapInArrow(_digests, "page_id long, size long, digest string, strong binary, url string")
    seen.write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/seen")
    seen = spark.read.parquet(f"{folder}/seen")
    first = seen.groupBy("strong").agg(F.min("page_id").alias("first_id"))
    named = seen.join(first, "strong").select("page_id", "size", "digest", "strong", "url", "first_id")
    named.mapInArrow(_headers, "page_id long, strong binary, header binary").write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/headers")
    keyed = src.select(F.sha2("payload", 256).alias("h"), "payload", "page_id").withColumn("strong", F.unhex("h"))
    # once each: the response's payload; several rows of one id and payload, or of null ids only, are made one
    owners = first.withColumn("own", F.coalesce("first_id", F.lit(-1)))
    store = keyed.withColumn("own", F.coalesce("page_id", F.lit(-1))).join(owners, ["strong", "own"], "left_semi").dropDuplicates(["strong", "own"])
    store.select("strong", "payload").write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/payloads")


def _read(batches):
    for b in common.slices(batches, text=2):
        cols: list[list] = [[] for _ in range(5)]
        for strong, head, payload in zip(*(b.column(i).to_pylist() for i in range(3))):
            if hashlib.sha256(payload).digest() != strong:
                raise ValueError(f"payload {strong.hex()} is not what its digest says")
            revisit = b"\r\nWARC-Type: revisit\r\n" in head
            (fields, block), = parse(head + (b"" if revisit else payload) + b"\r\n\r\n")
            if digest32(payload) != fields["WARC-Payload-Digest"].removeprefix("sha1:"):
                raise ValueError("the record's digest is not its payload's")
            number = lambda x: None if x is None or x == "<urn:page:None>" else int(x[10:-1])
            for c, v in zip(cols, (number(fields["WARC-Record-ID"]), len(payload), fields["WARC-Payload-Digest"][5:], fields["WARC-Type"], number(fields.get("WARC-Refers-To")))):
                c.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()))], ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])


def reconstruct(spark: SparkSession, folder: str) -> DataFrame:
    """strong, header, payload of every record; a revisit's payload is that of the response it refers to."""
    return spark.read.parquet(f"{folder}/headers").join(spark.read.parquet(f"{folder}/payloads"), "strong").select("strong", "header", "payload")


def records(spark: SparkSession, folder: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, read back from the archive."""
    return reconstruct(spark, folder).mapInArrow(_read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def through_archive(pages: DataFrame) -> DataFrame:
    spark = pages.sparkSession
    scratch = common.Scratch(spark, "warc")
    with common.freeing(spark):
        archive(pages, scratch.root)
    scratch.sweep()
    scratch.drop("seen")
    return records(spark, scratch.root)
