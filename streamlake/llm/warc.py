"""WARC archives with revisit records for repeated payloads.

Payload headers are shuffled by digest: the record with the smallest id among equal
payloads stays a response, the others become revisit records that name it. A payload below
the size limit is always written whole, as a revisit header would save nothing. Archives
are gzip files with one member per record, as readers of WARC expect, and begin with a
warcinfo record. Headers are written anew: a response is an HTTP response of the payload.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlake.llm.files import WholeFile, open_input
from streamlake.llm.tasks import released

MIN_REVISIT_BYTES = 100  # smaller payloads are never replaced by a revisit
FILE_BYTES = 64 << 20
GZIP_LEVEL = 3
ROWS_OUT = 4096
READ_BYTES = 1 << 20

# The record format and the profile of revisits with an identical payload.
_VERSION = "WARC/1.1"
_SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
DATE = "2000-01-01T00:00:00Z"  # of the records, where the caller has none; fixed, so that a repeated task writes the same bytes

MANIFEST = "path string, n_records long, n_bytes long"
RECORDS = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, "
    "payload binary, path string, at long"
)


def resolve_revisits(headers: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Adds ``refers_to`` and ``refers_to_url`` to ``(page_id, url, payload_bytes, payload_digest,
    ...)``: the smallest page_id among equal payloads and its url, null for that record itself
    and for small payloads.

    Originals are found by an aggregate that combines before the shuffle; only digests that
    repeat are joined back, so a payload with a third of all records is a skewed join side,
    which adaptive execution splits. A record without a page_id is always a response and
    never an original.
    """
    large = F.col("payload_bytes") >= min_bytes
    originals = (
        headers.filter(large)
        .groupBy("payload_digest")
        .agg(
            F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url"))).alias("original"),
            F.count(F.lit(1)).alias("n"),
        )
        .filter((F.col("n") > 1) & F.col("original").isNotNull())
        .select("payload_digest", F.col("original.page_id").alias("_original"), F.col("original.url").alias("_url"))
    )
    digest = F.when(large, F.col("payload_digest"))
    joined = headers.withColumn("_digest", digest).join(
        originals.withColumnRenamed("payload_digest", "_digest"), "_digest", "left"
    )
    other = F.col("page_id") != F.col("_original")
    found = {"refers_to": F.when(other, F.col("_original")), "refers_to_url": F.when(other, F.col("_url"))}
    return joined.withColumns(found).drop("_digest", "_original", "_url")


def payload_headers(pages: DataFrame) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest (hex SHA-256) of the UTF-8 html; null html is empty."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        "url",
        F.length(payload).cast("long").alias("payload_bytes"),
        F.sha2(payload, 256).alias("payload_digest"),
    )


def record_urn(page_id: int | None, url: str | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{page_id}|{url}')}>"


def target_uri(page_id: int | None, url: str | None) -> str:
    """The record's target; a page without a url is its own."""
    return record_urn(page_id, url)[1:-1] if url is None else quote(url, safe="!#$&'()*+,/:;=?@[]~%-._")


def _record(headers: list[tuple[str, object]], content: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", len(content))])
    return f"{_VERSION}\r\n{head}\r\n".encode() + content + b"\r\n\r\n"


def format_info(name: str, date: str) -> bytes:
    """The warcinfo record at the head of an archive."""
    content = b"software: streamlake\r\nformat: WARC File Format 1.1\r\n"
    urn = f"<urn:uuid:{uuid.uuid5(_NAMESPACE, name)}>"
    headers = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", urn), ("WARC-Date", date), ("WARC-Filename", name)]
    return _record([*headers, ("Content-Type", "application/warc-fields")], content)


def format_record(row: dict, payload: bytes, date: str = DATE) -> bytes:
    """The text of one record; a revisit has the headers of its payload and no content."""
    revisit = row["refers_to"] is not None
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_urn(row["page_id"], row["url"])),
        ("WARC-Date", date),
        ("WARC-Target-URI", target_uri(row["page_id"], row["url"])),
        ("WARC-Payload-Digest", f"sha256:{row['payload_digest']}"),
        ("X-Payload-Length", row["payload_bytes"]),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if row["url"] is not None:
        headers.append(("X-Url", quote(row["url"], safe="")))  # exact, whatever characters it has
    if row["page_id"] is not None:
        headers.append(("X-Page-ID", row["page_id"]))
    if not revisit:
        return _record(headers, _HTTP.format(len(payload)).encode() + payload)
    original = (row["refers_to"], row["refers_to_url"])
    headers += [
        ("WARC-Profile", _SAME_PAYLOAD),
        ("WARC-Refers-To", record_urn(*original)),
        ("WARC-Refers-To-Target-URI", target_uri(*original)),
        ("WARC-Refers-To-Date", date),
        ("X-Refers-To-Page-ID", row["refers_to"]),
    ]
    return _record(headers, b"")


def write_warc(pages: DataFrame, root: str, min_bytes: int = MIN_REVISIT_BYTES, date: str = DATE) -> DataFrame:
    """Write ``(page_id, url, html)`` as archives below ``root``; returns their manifest.

    ``date`` is that of all records (UTC, as ``2000-01-01T00:00:00Z``).

    Only headers are shuffled by digest; html is joined with its decision by page_id, which
    has no hot key. Repeated rows of one page_id and payload are decided alike. Null html
    is an empty payload; a null page_id is left out of the record, and one without a url has
    its own name as target. Other columns are
    ignored, and an empty table gives no archive.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, out, n = TaskContext.get().partitionId(), 0, None, 0

        def finish() -> pa.RecordBatch:
            out.close()
            row = {"path": path, "n_records": n, "n_bytes": out.size}
            return pa.RecordBatch.from_pylist([row], schema=kinds)

        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                if out is None:
                    name = f"part-{part:06d}-{seq:05d}.warc.gz"
                    path = f"{root}/archives/{name}"
                    out, n = WholeFile(path), 0
                    out.write(gzip.compress(format_info(name, date), GZIP_LEVEL, mtime=0))
                record = format_record(row, (row["html"] or "").encode(), date)
                out.write(gzip.compress(record, GZIP_LEVEL, mtime=0))
                n += 1
                if out.size >= FILE_BYTES:
                    yield finish()
                    out, seq = None, seq + 1
        if out is not None:
            yield finish()

    kinds = pa.schema([("path", pa.string()), ("n_records", pa.int64()), ("n_bytes", pa.int64())])
    spark = pages.sparkSession
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    revisits = (
        resolve_revisits(payload_headers(pages), min_bytes)
        .filter(F.col("refers_to").isNotNull())
        .select("page_id", "payload_digest", "refers_to", "refers_to_url")
        .distinct()
    )
    whole = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        "url",
        "html",
        F.length(payload).cast("long").alias("payload_bytes"),
        F.sha2(payload, 256).alias("payload_digest"),
    )
    decided = whole.join(revisits, ["page_id", "payload_digest"], "left")
    decided.mapInArrow(released(write), MANIFEST).write.parquet(f"{root}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{root}/manifest")


class MemberReader:
    """Reads a gzip file member by member in bounded steps."""

    def __init__(self, stream):
        self._stream, self._left, self.at = stream, b"", 0

    def next(self) -> bytes | None:
        """Content of the next member, None at the end; a cut-off member raises."""
        inflate, content, used = zlib.decompressobj(wbits=31), [], 0
        while not inflate.eof:
            data = self._left or self._stream.read(READ_BYTES)
            if not data:
                if used:
                    raise ValueError("the archive ends inside a record")
                return None
            content.append(inflate.decompress(data))
            self._left = inflate.unused_data
            used += len(data) - len(self._left)
        self.at += used
        return b"".join(content)


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, content) of a record; a damaged one raises."""
    head, _, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    headers = dict(line.split(": ", 1) for line in lines)
    size = int(headers["Content-Length"])
    if version != _VERSION or rest[size:] != b"\r\n\r\n":
        raise ValueError("not a whole record")
    return headers, rest[:size]


def read_warc(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of the archives, columns as in ``RECORDS``; one task per archive; warcinfo
    records are passed over.

    Length and digest of a response come from its content and have to agree with its
    headers; those of a revisit are its headers'. ``payload`` is null for revisits
    (``resolve_payloads`` brings it in) or without ``payloads``.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows, size = [], 0
                with open_input(path) as stream:
                    members = MemberReader(stream)
                    while True:
                        at = members.at
                        if (record := members.next()) is None:
                            break
                        headers, content = parse_record(record)
                        if headers["WARC-Type"] == "warcinfo":
                            continue
                        rows.append((*_fields(headers, content, payloads), path, at))
                        size += len(record)
                        if len(rows) >= ROWS_OUT or size >= READ_BYTES * 8:
                            yield table(rows)
                            rows, size = [], 0
                if rows:
                    yield table(rows)

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds.types)], schema=kinds)

    arrow = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    kinds = pa.schema([(n, arrow[t]) for n, t in (c.split() for c in RECORDS.split(", "))])
    archives = max(1, manifest.count())
    return manifest.select("path").repartition(archives, "path").mapInArrow(released(read), RECORDS)


def _fields(headers: dict[str, str], content: bytes, payloads: bool) -> tuple:
    from urllib.parse import unquote

    kind, stored = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha256:")
    length, digest = int(headers["X-Payload-Length"]), stored
    if kind == "response":
        content = content.partition(b"\r\n\r\n")[2]  # what follows the HTTP headers
        length, digest = len(content), hashlib.sha256(content).hexdigest()
        if digest != stored:
            raise ValueError(f"payload of {headers['WARC-Record-ID']} does not match its digest")
    page, original = headers.get("X-Page-ID"), headers.get("X-Refers-To-Page-ID")
    return (
        None if page is None else int(page),
        unquote(headers["X-Url"]) if "X-Url" in headers else None,
        kind,
        None if original is None else int(original),
        length,
        digest,
        content if payloads and kind == "response" else None,
    )


def resolve_payloads(records: DataFrame) -> DataFrame:
    """Gives each revisit the payload of the response it refers to, joined by digest and id."""
    originals = records.filter(F.col("record_type") == "response").select(
        F.col("page_id").alias("refers_to"), "payload_digest", F.col("payload").alias("_original")
    ).dropDuplicates(["refers_to", "payload_digest"])
    joined = records.join(originals, ["refers_to", "payload_digest"], "left")
    return joined.withColumn("payload", F.coalesce("payload", "_original")).drop("_original").select(*records.columns)
