"""Web archives: pages written as WARC records, and archives read back with their segments put together.

Writing: of pages with equal payloads the one with the largest id becomes a
response, the others revisit records that name it.  A response's block is an
HTTP message with chunked transfer framing; a block that is longer than a
segment goes into the record itself and continuation records.  Spark's text
writer puts the records into files, so a lost executor leaves no half archive.

Reading: each file is parsed record by record by its declared lengths.
Continuation records are grouped by the identifier of their origin, ordered by
segment number and checked against the declared total length; then the chunk
framing is decoded and the payload's digest compared with the declared one.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import scratch

SEGMENT_BYTES = 32 << 10
CHUNK_BYTES = 8 << 10
FILE_RECORDS = 2000  # so that a file, unpacked, has at most this many segments
SALTS = 32  # parts of a group of equal payloads
DATE = "1970-01-01T00:00:00Z"
_END = "\r\n\r\n"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class WarcError(ValueError):
    """An archive that does not say what it should."""


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _cuts(data: bytes, size: int) -> Iterator[bytes]:
    """data in pieces of at most size bytes, none of which cuts a UTF-8 character."""
    start, n = 0, len(data)
    while start < n:
        end = min(start + size, n)
        while end < n and data[end] & 0xC0 == 0x80:
            end -= 1
        yield data[start:end]
        start = end


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    return b"".join([b"%x\r\n%b\r\n" % (len(c), c) for c in _cuts(payload, size)]) + b"0\r\n\r\n"


def dechunked(body: bytes) -> bytes:
    """The payload of a body in chunked transfer framing; chunk extensions and trailers are passed over."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        try:
            size = int(body[at:end].split(b";")[0], 16) if end >= 0 else -1
        except ValueError:
            size = -1
        if size < 0:
            raise WarcError("bad chunk size")
        if size == 0:
            return b"".join(out)
        at = end + 2 + size
        if body[at : at + 2] != b"\r\n":
            raise WarcError("chunk without its end")
        out.append(body[end + 2 : at])
        at += 2


def _record(fields: list[tuple[str, object]], block: bytes) -> str:
    head = "".join([f"{k}: {v}\r\n" for k, v in fields if v is not None])
    return f"WARC/1.1\r\n{head}Content-Length: {len(block)}{_END}{block.decode()}"


def _name(page_id: int | None, digest: str) -> str:
    return f"urn:page:{'' if page_id is None else page_id}:{digest}"


def page_records(number: int, page_id: int | None, url: str | None, html: str | None, refers_to: int | None, digest: str, size: int, segment_bytes: int = SEGMENT_BYTES, chunk_bytes: int = CHUNK_BYTES) -> Iterator[str]:
    """The records of a page, without the two line ends that follow each.

    A record's identifier is made of the page's id and its payload's digest.
    number tells segments of rows that share both apart.
    """
    name = _name(page_id, digest)
    uri = None if url is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
    shared: list[tuple[str, object]] = [("WARC-Date", DATE), ("WARC-Target-URI", uri), ("WARC-Payload-Digest", f"sha1:{digest}")]
    http = ("Content-Type", "application/http; msgtype=response")
    if refers_to is not None:
        block = _HTTP + b"Content-Length: %d\r\n\r\n" % size
        yield _record([("WARC-Type", "revisit"), ("WARC-Record-ID", f"<{name}>"), *shared, ("WARC-Refers-To", f"<{_name(refers_to, digest)}>"), ("WARC-Profile", _PROFILE), http], block)
        return
    block = _HTTP + b"Transfer-Encoding: chunked\r\n\r\n" + chunked((html or "").encode(), chunk_bytes)
    first = [("WARC-Type", "response"), ("WARC-Record-ID", f"<{name}>"), *shared, http]
    if len(block) <= segment_bytes:
        yield _record(first, block)
        return
    segments = list(_cuts(block, segment_bytes))
    for k, segment in enumerate(segments, 1):
        fields = first if k == 1 else [("WARC-Type", "continuation"), ("WARC-Record-ID", f"<{name}:{k}>"), ("WARC-Date", DATE), ("WARC-Segment-Origin-ID", f"<{name}>")]
        yield _record([*fields, ("Page-Copy", number), ("WARC-Segment-Number", k), ("WARC-Segment-Total-Length", len(block) if k == len(segments) else None)], segment)


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 0, segment_bytes: int = SEGMENT_BYTES, chunk_bytes: int = CHUNK_BYTES, file_records: int = FILE_RECORDS, compression: str = "gzip") -> None:
    """Write a record, or several segments, for every row of pages to WARC files under path.

    Null html is an empty payload, a null url gives a record without target,
    and a null id stays null.  Rows that repeat an id and a payload repeat the
    record's identifier.  Of equal payloads of at least least_bytes bytes
    the row with the largest id is the response; rows that repeat that id are
    responses too, and where all ids are null all rows are.
    """
    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), html.alias("html"))
    rows = rows.withColumn("digest", F.sha1(F.encode("html", "UTF-8"))).withColumn("bytes", F.octet_length("html").cast("long"))
    groups = rows.where(F.col("bytes") >= least_bytes).groupBy("digest").agg(F.max("page_id").alias("newest"), F.count("*").alias("n")).where("n > 1 AND newest IS NOT NULL")
    groups = groups.select("digest", "newest", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    dealt = salted.join(groups, ["digest", "salt"], "left")
    refers = F.when(F.col("newest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("newest")), F.col("newest"))
    dealt = dealt.withColumn("refers_to", refers).select("page_id", "url", F.when(F.col("refers_to").isNull(), F.col("html")).alias("html"), "refers_to", "digest", "bytes", F.monotonically_increasing_id().alias("number"))

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, size = [], 0
            for page_id, url, html, refers_to, digest, n, number in zip(*[c.to_pylist() if c.type != pa.string() else c for c in batch.columns], strict=True):
                url, html, digest = url.as_py(), html.as_py(), digest.as_py()
                out += page_records(number, page_id, url, html, refers_to, base64.b32encode(bytes.fromhex(digest)).decode(), n, segment_bytes, chunk_bytes)
                size += n
                if size > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])
                    out, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])

    dealt.mapInArrow(records, "value string").write.option("lineSep", _END).option("maxRecordsPerFile", file_records).option("compression", compression).text(path)


def parse_archive(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields by lower-case name, block) of each record of an archive, compressed or not."""
    if content[:2] == b"\x1f\x8b":
        content = gzip.decompress(content)
    at = 0
    while at < len(content):
        end = content.find(b"\r\n\r\n", at)
        if content[at : at + 5] != b"WARC/" or end < 0:
            raise WarcError(f"no record at byte {at}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in content[at:end].decode().split("\r\n")[1:])}
        start = end + 4
        at = start + int(fields["content-length"])
        if content[at : at + 4] != b"\r\n\r\n":
            raise WarcError(f"record before byte {at} has not the declared length")
        yield fields, content[start:at]
        at += 4


_PARTS = "origin string, segment int, total long, page_id long, record_type string, refers_to long, digest string, block binary, payload_bytes long"
_NAMES = [x.split()[0] for x in _PARTS.split(", ")]
_TYPES = [{"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}[x.split()[1]] for x in _PARTS.split(", ")]


def _page(name: str) -> int | None:
    m = re.match(r"<urn:page:(-?\d*)[:>]", name)
    return int(m[1]) if m and m[1] else None


def _payload(block: bytes, digest: str | None) -> bytes:
    """The payload of a whole HTTP block, checked against the declared digest."""
    head, _, body = block.partition(b"\r\n\r\n")
    if re.search(rb"(?im)^transfer-encoding:.*\bchunked\b", head):
        body = dechunked(body)
    if digest is not None and payload_digest(body) != digest:
        raise WarcError("the payload has not the declared digest")
    return body


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each record; whole records are decoded, segments keep their block."""
    for batch in batches:
        for content in batch["content"]:
            rows = []
            for fields, block in parse_archive(content.as_py()):
                kind, name = fields["warc-type"], fields["warc-record-id"]
                if kind not in ("response", "revisit", "continuation"):
                    continue
                digest = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
                refers = _page(fields["warc-refers-to"]) if "warc-refers-to" in fields else None
                segment = int(fields["warc-segment-number"]) if "warc-segment-number" in fields else None
                total = int(fields["warc-segment-total-length"]) if "warc-segment-total-length" in fields else None
                origin, size = fields.get("warc-segment-origin-id", name) + fields.get("page-copy", ""), None
                if kind == "revisit":
                    m = re.search(rb"(?im)^content-length:\s*(\d+)", block)
                    size, block = int(m[1]) if m else None, None
                elif segment is None:
                    size, block = len(_payload(block, digest)), None
                rows.append((origin, segment, total, _page(origin), kind, refers, digest, block, size))
            columns = zip(*rows, strict=True) if rows else [()] * len(_NAMES)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)], names=_NAMES)


def assembled(rows: list[dict]) -> tuple[dict, bytes]:
    """(first segment's row, payload) of a record's segments in order."""
    if [r["segment"] for r in rows] != list(range(1, len(rows) + 1)) or rows[0]["record_type"] == "continuation":
        raise WarcError(f"{rows[0]['origin']}: segments are missing or repeated")
    block = b"".join([r["block"] for r in rows])
    if rows[-1]["total"] != len(block):
        raise WarcError(f"{rows[0]['origin']}: total length is {len(block)}, not {rows[-1]['total']}")
    return rows[0], _payload(block, rows[0]["digest"])


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record under path, segments put together.

    An archive whose lengths, segments or digests disagree raises an error.
    """

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[dict] = []

        def done() -> list[tuple]:
            first, payload = assembled(waiting)
            return [(first["page_id"], len(payload), first["digest"], first["record_type"], first["refers_to"])]

        for batch in batches:
            whole = pc.is_null(batch["segment"])
            some = batch.filter(whole)
            yield some.select(["page_id", "payload_bytes", "digest", "record_type", "refers_to"])
            rows = []
            for row in batch.filter(pc.invert(whole)).to_pylist():
                if waiting and waiting[0]["origin"] != row["origin"]:
                    rows += done()
                    waiting = []
                waiting.append(row)
            yield from packed(rows)
        if waiting:
            yield from packed(done())

    def packed(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()), strict=True)], names=["page_id", "payload_bytes", "digest", "record_type", "refers_to"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")
    parts = files.mapInArrow(_parts, _PARTS).repartition("origin").sortWithinPartitions("origin", "segment")
    return parts.mapInArrow(assemble, "page_id long, payload_bytes long, digest string, record_type string, refers_to long").withColumnRenamed("digest", "payload_digest")


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every row of pages, from archives written and read back.

    See write_warc() for nulls and repeated rows.  An empty table gives an
    empty result.  Other columns are not looked at.
    """
    path = scratch(pages.sparkSession, "warc")
    write_warc(pages, path, **options)
    return read_warc(pages.sparkSession, path)
