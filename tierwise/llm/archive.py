"""Operator 7: content-addressed WARC archive.

The archive is two Parquet tables in shared storage. ``payloads`` holds each distinct payload once,
deflated, under its SHA-256; ``records`` holds the exact header block of every WARC record with the digest of the
payload it describes. Joining the two on the digest gives every record back byte for byte. On reading, each payload
is inflated and its digest computed anew, so a damaged payload fails the read instead of
returning wrong bytes. ``export_warc`` writes plain WARC files from the same records.

Edge cases: NULL html is an empty payload; NULL url leaves the target header out; payloads under 100 bytes are always
``response`` records; rows that tie for the smallest page_id of a payload are all responses; a NULL
page_id orders last (a group of NULLs only has responses); an empty table gives an empty archive.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import bounded_batches, materialise, read_table, text_slices

MIN_SHARED_BYTES = 100
VERSION = "WARC/1.1"
# Fixed capture time: the tables carry none, and reruns must give equal bytes.
CAPTURE_DATE = "2020-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _payloads(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes], list[str]]]:
    """Slices of rows with their payloads and digests."""
    for whole in batches:
        for b in text_slices(whole, "html"):
            raw = [(x or "").encode("utf-8") for x in b.column("html").to_pylist()]
            yield b, raw, [hashlib.sha256(x).hexdigest() for x in raw]


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(page_id, url, html) -> (page_id, url, digest, bytes)."""
    for b, raw, digests in _payloads(batches):
        yield pa.RecordBatch.from_arrays([
            b.column("page_id"), b.column("url"), pa.array(digests, pa.string()), pa.array([len(x) for x in raw], pa.int64())],
            names=["page_id", "url", "digest", "bytes"])


def _bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(html) -> (digest, body): body is the deflated payload, once for each digest of a slice."""
    for _, raw, digests in _payloads(batches):
        own = dict(zip(digests, raw))
        yield pa.RecordBatch.from_arrays([pa.array(list(own), pa.string()),
                                          pa.array([zlib.compress(x, 6) for x in own.values()], pa.binary())],
                                         names=["digest", "body"])


def record_header(page_id, url, digest: str, size: int, refers_to) -> bytes:
    """Header block of one record, up to and including the blank line."""
    lines = [VERSION, f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
             f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {CAPTURE_DATE}"]
    if url is not None:
        # A header value is one line: anything that would end it is percent-encoded.
        lines.append("WARC-Target-URI: " + re.sub(r"[\r\n%]", lambda m: f"%{ord(m[0]):02X}", url))
    lines.append(f"WARC-Payload-Digest: sha256:{digest}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {size if refers_to is None else 0}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode("utf-8")


def parse_header(block: bytes) -> dict[str, str]:
    """Fields of a header block; raises if it isn't one."""
    lines = block.decode("utf-8").split("\r\n")
    if lines[0] != VERSION or lines[-2:] != ["", ""]:
        raise ValueError("not a WARC header block")
    return dict(x.split(": ", 1) for x in lines[1:-2])


def _headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        c = {n: b.column(n).to_pylist() for n in ("page_id", "url", "digest", "bytes", "refers_to")}
        blocks = [record_header(*x) for x in zip(c["page_id"], c["url"], c["digest"], c["bytes"], c["refers_to"])]
        yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("digest"), pa.array(blocks, pa.binary())],
                                         names=["page_id", "digest", "header"])


def write_archive(pages: DataFrame, path: str) -> None:
    """Archive (page_id, url, html) rows under ``path``: ``path/payloads`` and ``path/records``.

    ``pages`` is read twice: for the digests, from which the headers follow, and for the payloads, which are stored nowhere else.
    """
    spark = pages.sparkSession
    bounded_batches(spark)
    kind = dict(pages.dtypes)["page_id"]
    rows = materialise(pages.select("page_id", "url", "html").mapInArrow(
        _digests, f"page_id {kind}, url string, digest string, bytes long"), "warc_digests")
    first = rows.groupBy("digest").agg(F.min("page_id").alias("first_id"))
    keyed = rows.join(first, "digest")
    shared = (F.col("bytes") >= MIN_SHARED_BYTES) & ~F.coalesce(F.col("page_id") == F.col("first_id"),
                                                                F.col("first_id").isNull())
    keyed = keyed.withColumn("refers_to", F.when(shared, F.col("first_id")))
    keyed.select("page_id", "url", "digest", "bytes", "refers_to").mapInArrow(
        _headers, f"page_id {kind}, digest string, header binary").write.option("compression", "zstd") \
        .parquet(f"{path}/records")
    # Rows of one digest hold the same bytes, so any of them will do: one shuffle, after combining in the map tasks.
    bodies = pages.select("html").mapInArrow(_bodies, "digest string, body binary")
    bodies.groupBy("digest").agg(F.first("body").alias("body")).write.option("compression", "none") \
        .parquet(f"{path}/payloads")


def _rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for b in text_slices(whole, "body", 1 << 20):
            out = []
            for page_id, digest, header, body in zip(*(b.column(n).to_pylist()
                                                       for n in ("page_id", "digest", "header", "body"))):
                if body is None:
                    raise ValueError(f"payload {digest} is missing from the archive")
                payload = zlib.decompress(body)
                if hashlib.sha256(payload).hexdigest() != digest:
                    raise ValueError(f"payload {digest} is damaged")
                fields = parse_header(header)
                if fields["WARC-Payload-Digest"] != f"sha256:{digest}":
                    raise ValueError(f"header of {page_id} names another payload")
                own = payload if fields["WARC-Type"] == "response" else b""
                if int(fields["Content-Length"]) != len(own):
                    raise ValueError(f"length of record {page_id} is wrong")
                refers = fields.get("WARC-Refers-To")
                out.append((page_id, len(payload), digest, fields["WARC-Type"],
                            refers[len("<urn:page:"):-1] if refers else None, header + own + b"\r\n\r\n", payload))
            cols = list(zip(*out)) or [()] * 7
            types = [b.column("page_id").type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary(),
                     pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=[
                "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record", "payload"])


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Every record of an archive, rebuilt and verified: (page_id, payload_bytes, payload_digest, record_type,
    refers_to, record, payload); ``record`` is the exact WARC record, ``payload`` the full payload, also of a revisit."""
    bounded_batches(spark)
    records, payloads = spark.read.parquet(f"{path}/records"), spark.read.parquet(f"{path}/payloads")
    kind = dict(records.dtypes)["page_id"]
    joined = records.join(payloads, "digest", "left").select("page_id", "digest", "header", "body")
    return joined.mapInArrow(_rebuild, f"page_id {kind}, payload_bytes long, payload_digest string, record_type string, "
                                       "refers_to string, record binary, payload binary") \
        .withColumn("refers_to", F.col("refers_to").cast(kind))


def export_warc(records: DataFrame, path: str, per_file: int = 10_000) -> None:
    """Write records as uncompressed WARC files of at most ``per_file`` records (a record ends in CRLF CRLF)."""
    text = F.decode(F.expr("substring(record, 1, octet_length(record) - 4)"), "utf-8")
    records.select(text.alias("value")).write.option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", per_file).text(path)


def op7_warc_archive(spark, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "llm", "warc")
    write_archive(read_table(spark, sf_dir, "pages"), path)
    return read_archive(spark, path).drop("record", "payload")


OP7_SQL = """
WITH p AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM p GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM first_id AND first_id IS NOT NULL THEN 'revisit' ELSE 'response' END
         AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM p JOIN f USING (payload_digest)
"""
