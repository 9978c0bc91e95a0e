"""WARC archives with segmented records: write, read back, reassemble.

A payload is framed in chunks (HTTP/1.1 chunked transfer coding). A record block above ``segment`` bytes is cut into segments, each
a record of its own: the first keeps the record's type, the others are continuations that name the first as their origin.
Reading groups the segments of an origin, orders them by number, holds the sum of their lengths against the total
that the last one states, and decodes the framing. Of records with equal payloads one is a response, the others are revisits.

Archives are ordinary Spark output below the cluster's shared folder, gzip files of whole records.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.llm.helpers import store
from lakeloom.session import workspace

SEGMENT = 32 << 10        # bytes of a record block
CHUNK = 8 << 10           # bytes of a transfer chunk
FILE_RECORDS = 512        # records of an archive: it has at most this many segments and their headers
EPOCH = "1970-01-01T00:00:00Z"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    parts = [b"%X\r\n%s\r\n" % (len(payload[i:i + size]), payload[i:i + size]) for i in range(0, len(payload), size)]
    return b"".join([*parts, b"0\r\n\r\n"])


def dechunked(body: bytes) -> bytes | None:
    """The payload of a chunked body, None if the framing is broken. Chunk extensions and trailers are skipped."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        head = re.match(rb"[0-9A-Fa-f]+", body[at:end]) if end >= 0 else None
        if not head:
            return None
        n, at = int(head[0], 16), end + 2
        if n == 0:
            return b"".join(out) if body[at:at + 2] == b"\r\n" or body.endswith(b"\r\n\r\n") else None
        if len(body) < at + n + 2 or body[at + n:at + n + 2] != b"\r\n":
            return None
        out.append(body[at:at + n])
        at += n + 2


def payload_of(block: bytes) -> bytes | None:
    """The payload of an HTTP response block."""
    head, gap, body = block.partition(b"\r\n\r\n")
    if not gap:
        return None
    return dechunked(body) if re.search(rb"(?i)^transfer-encoding:\s*chunked\s*$", head, re.M) else body


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(kind: str, rid: str, block: bytes, *fields: tuple[str, object]) -> bytes:
    """A record without its very last line end, which the file writer adds."""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{rid}>", f"WARC-Date: {EPOCH}",
             *(f"{k}: {_line(v)}" for k, v in fields), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n"


def _line(value: object) -> str:
    return re.sub(r"[\r\n]+", " ", str(value))


def segments(kind: str, rid: str, block: bytes, fields: list[tuple[str, object]], size: int) -> list[bytes]:
    """The record, in one piece or as segments numbered from 1."""
    if len(block) <= size:
        return [record(kind, rid, block, *fields)]
    parts = [block[i:i + size] for i in range(0, len(block), size)]
    out = [record(kind, rid, parts[0], *fields, ("WARC-Segment-Number", 1))]
    for k, part in enumerate(parts[1:], 2):
        last = [("WARC-Segment-Total-Length", len(block))] if k == len(parts) else []
        out.append(record("continuation", f"{rid}:{k}", part, ("WARC-Segment-Origin-ID", f"<{rid}>"),
                          ("WARC-Segment-Number", k), *last))
    return out


def first_of_equal(pages: DataFrame) -> DataFrame:
    """(tag, page_id, url, html, n_bytes, digest, refers_to, refers_tag): tag numbers the rows, refers_* name the response of a revisit.

    Only digests that occur more than once are looked up again, so where payloads differ no html moves.
    """
    html = F.coalesce("html", F.lit(""))
    tagged = pages.select("page_id", "url", html.alias("html"), F.monotonically_increasing_id().alias("tag"))
    names = store(tagged.select("tag", "page_id", F.sha1(F.col("html").cast("binary")).alias("digest")), "digests")
    order = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "tag")
    firsts = names.groupBy("digest").agg(F.min(order).alias("first"), F.count("*").alias("n")).filter("n > 1")
    other = names.join(firsts, "digest").filter(F.col("tag") != F.col("first.tag")).select(
        F.col("tag").alias("_tag"), F.col("first.page_id").alias("refers_to"), F.col("first.tag").alias("refers_tag"))
    other = store(other, "revisits")
    return tagged.join(other, F.col("tag") == F.col("_tag"), "left").drop("_tag")


def write(pages: DataFrame, path: str, least: int = 0, segment: int = SEGMENT) -> None:
    """Archives of all rows of ``pages`` (page_id, url, html) below ``path``.

    Rows with equal payloads of at least ``least`` bytes refer to the one with the smallest page_id (null last); of rows that repeat even
    that, to the first. A missing html is an empty payload.
    """
    rows = first_of_equal(pages)
    small = F.octet_length("html") < least
    rows = rows.select("tag", F.col("page_id").cast("string").alias("page"), "url", F.col("html").cast("binary"),
                       F.when(~small, F.col("refers_tag")).alias("refers"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for tag, page, url, html, refers in zip(*(c for c in b.columns)):
                payload, rid = html.as_py(), f"urn:page:{tag.as_py()}"
                fields = [("WARC-Target-URI", url.as_py() or "urn:none"), ("WARC-Payload-Digest", f"sha1:{digest_of(payload)}")]
                if page.is_valid:
                    fields.append(("X-Page-ID", page.as_py()))
                if refers.is_valid:
                    fields += [("WARC-Refers-To", f"<urn:page:{refers.as_py()}>"), (
                        "WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
                    out.append(record("revisit", rid, b"", *fields))
                else:
                    fields.append(("Content-Type", "application/http; msgtype=response"))
                    out += segments("response", rid, HTTP + chunked(payload), fields, segment)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    rows.mapInArrow(run, "value binary").select(F.col("value").cast("string")).write.option("lineSep", "\r\n").option(
        "maxRecordsPerFile", FILE_RECORDS).option("compression", "gzip").text(path)


def parsed(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields by lower-case name, block) of every record; a broken rest of a file ends it."""
    at = 0
    while (start := data.find(b"WARC/1.", at)) >= 0:
        end = data.find(b"\r\n\r\n", start)
        if end < 0:
            return
        lines = data[start:end].decode("utf-8", "replace").split("\r\n")[1:]
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        if not fields.get("content-length", "").isdigit():
            return
        n = int(fields["content-length"])
        if len(data) < end + 4 + n:
            return
        yield fields, data[end + 4:end + 4 + n]
        at = end + 4 + n


RECORDS = ("kind string, rid string, origin string, segment int, total long, page string, digest string, refers string, "
           "block binary, payload_bytes long, payload_digest string")


def _unbracketed(value: str | None) -> str | None:
    return value.strip("<>") if value else None


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record. A record in one piece is decoded here; ``block`` is kept for segments only."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import gzip

        for b in batches:
            for x in b.column(0):
                data, rows = x.as_py(), []
                for f, block in parsed(gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data):
                    number = f.get("warc-segment-number")
                    payload = payload_of(block) if number is None and f.get("warc-type") == "response" else None
                    rows.append((
                        f.get("warc-type"), _unbracketed(f.get("warc-record-id")), _unbracketed(f.get("warc-segment-origin-id")),
                        int(number) if number else None, int(f["warc-segment-total-length"])
                        if "warc-segment-total-length" in f else None, f.get("x-page-id"),
                        (f.get("warc-payload-digest") or "").removeprefix("sha1:") or None, _unbracketed(f.get("warc-refers-to")),
                        block if number else None, None if payload is None else len(payload),
                        None if payload is None else digest_of(payload)))
                    if len(rows) == 256:
                        yield _batch(rows)
                        rows = []
                if rows:
                    yield _batch(rows)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, RECORDS)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [x.split()[0] for x in RECORDS.split(", ")]
    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    types = [kinds[x.split()[1]] for x in RECORDS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def reassembled(records: DataFrame) -> DataFrame:
    """(rid, payload_bytes, payload_digest) of segmented records, null where a segment is missing, the total is wrong or the framing broken.

    A segment given twice counts once. The segments of one origin, no more than one payload, meet in one task.
    """
    origin = F.coalesce("origin", "rid")
    parts = records.filter("segment IS NOT NULL").groupBy(origin.alias("rid"), "segment").agg(
        F.max("total").alias("total"), F.first("block").alias("block"))
    whole = parts.groupBy("rid").agg(
        F.sort_array(F.collect_list(F.struct("segment", "block"))).alias("parts"), F.max("total").alias("total"))

    def block(parts: list[dict], total: int | None) -> bytes | None:
        data = b"".join(p["block"] for p in parts)
        sound = [p["segment"] for p in parts] == list(range(1, len(parts) + 1)) and len(data) == total
        return data if sound else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            blocks = [block(p.as_py(), n.as_py()) for p, n in zip(b.column(1), b.column(2))]
            got = [None if x is None else payload_of(x) for x in blocks]
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array([None if p is None else len(p) for p in got], pa.int64()),
                pa.array([None if p is None else digest_of(p) for p in got], pa.string())],
                ["rid", "payload_bytes", "payload_digest"])

    return whole.select("rid", "parts", "total").mapInArrow(
        run, "rid string, payload_bytes long, payload_digest string")


def read(spark: SparkSession, path: str, page_type: T.DataType | None = None) -> DataFrame:
    """One row per page in the archives: page_id, payload_bytes, payload_digest, record_type, refers_to, complete.

    A revisit takes length and digest from the response it names. ``complete`` is false where a payload could not be put together or its digest
    is not the one that the record states.
    """
    records = store(read_records(spark, path), "records")
    heads = records.filter("kind IN ('response', 'revisit')").drop("block", "origin", "total")
    whole = reassembled(records).select(F.col("rid").alias("_rid"), F.col("payload_bytes").alias("_n"),
                                        F.col("payload_digest").alias("_d"))
    heads = heads.join(whole, F.col("rid") == F.col("_rid"), "left").withColumns({
        "payload_bytes": F.coalesce("payload_bytes", "_n"), "payload_digest": F.coalesce("payload_digest", "_d")}).drop(
            "_rid", "_n", "_d")
    heads = store(heads, "heads")
    named = heads.filter("kind = 'response'").join(
        heads.filter("refers IS NOT NULL").select(F.col("refers").alias("rid")).distinct(), "rid").select(
            F.col("rid").alias("_rid"), F.col("page").alias("_page"), F.col("payload_bytes").alias("_n"),
            F.col("payload_digest").alias("_d"))
    rows = heads.join(named, F.col("refers") == F.col("_rid"), "left")
    kind = page_type or T.LongType()
    found = F.coalesce("payload_digest", "_d")
    return rows.select(
        F.col("page").cast(kind).alias("page_id"), F.coalesce("payload_bytes", "_n").alias("payload_bytes"),
        found.alias("payload_digest"), F.col("kind").alias("record_type"), F.col("_page").cast(kind).alias("refers_to"),
        F.coalesce(found == F.col("digest"), F.lit(False)).alias("complete"))


def round_trip(pages: DataFrame, least: int = 0, segment: int = SEGMENT) -> DataFrame:
    """``read`` of what ``write`` makes of ``pages``."""
    path = workspace(pages.sparkSession, "archives")
    write(pages, path, least, segment)
    return read(pages.sparkSession, path, pages.schema["page_id"].dataType)
