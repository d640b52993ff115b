"""Token ids as length-delimited binary records with checksums and an offset index.

A data file is a sequence of records::

    uint64 length | uint32 masked crc of those 8 bytes | payload | uint32 masked crc of the payload

all little-endian. The payload is ``uint8 bytes per id, uint8 has doc_id, int64 doc_id`` and
then the ids. The checksum is CRC-32, rotated and shifted, so that a checksum stored inside
a payload does not look like one. The index file beside it holds one ``uint64 offset,
uint64 length`` pair per record, for reads in any order.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from streamlake.llm.files import WholeFile, open_input, open_random
from streamlake.llm.ids import encoder
from streamlake.llm.tasks import released

FILE_BYTES = 64 << 20  # a data file is closed at this size
ROWS_OUT = 4096

# The mask of stored checksums.
_ROTATE, _SHIFT = 15, 0xA282EAD8

# The layouts.
_LENGTH, _CRC, _HEAD, _ENTRY = "<Q", "<I", "<BBq", "<QQ"
MANIFEST = "part int, seq int, path string, n_docs long, n_ids long, n_bytes long"


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> _ROTATE) | (crc << (32 - _ROTATE))) + _SHIFT) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack(_LENGTH, len(payload))
    crcs = [struct.pack(_CRC, masked_crc(part)) for part in (length, payload)]
    return b"".join((length, crcs[0], payload, crcs[1]))


def _check(data: bytes, stored: bytes, what: str) -> None:
    if len(stored) != 4 or struct.unpack(_CRC, stored)[0] != masked_crc(data):
        raise ValueError(f"{what} of a record does not match its checksum")


def read_frame(stream) -> bytes | None:
    """The next payload, None at the end of the file; a damaged record raises."""
    head = stream.read(12)
    if not head:
        return None
    _check(head[:8], head[8:], "length")
    length = struct.unpack(_LENGTH, head[:8])[0]
    body = stream.read(length + 4)
    _check(body[:length], body[length:], "payload")
    return body[:length]


def pack_ids(doc_id: int | None, ids: np.ndarray) -> bytes:
    return struct.pack(_HEAD, ids.dtype.itemsize, doc_id is not None, doc_id or 0) + ids.tobytes()


def unpack_ids(payload: bytes) -> tuple[int | None, np.ndarray]:
    width, known, doc_id = struct.unpack_from(_HEAD, payload)
    return doc_id if known else None, np.frombuffer(payload, f"<u{width}", offset=struct.calcsize(_HEAD))


def read_index(uri: str) -> np.ndarray:
    """(records, 2) offsets and lengths of a data file's payload frames."""
    with open_input(f"{uri}.idx") as f:
        return np.frombuffer(f.read(), "<u8").reshape(-1, 2)


def read_record(uri: str, entry: np.ndarray) -> tuple[int | None, np.ndarray]:
    """One record by its index entry; what a shuffled reader does."""
    with open_random(uri) as f:
        f.seek(int(entry[0]))
        return unpack_ids(read_frame(f))


def write_records(docs: DataFrame, root: str, tokenizer: str, end_id: int) -> DataFrame:
    """Write ``(doc_id, text)`` as record files below ``root`` and return their manifest.

    Documents lie in ascending ``doc_id`` over all files (null first, equal ids by text).
    Range partitioning spreads them, so no task holds more than its range, and files end
    at ``FILE_BYTES``. A null text is an empty one; other columns are ignored; an empty
    table gives an empty manifest.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, seq = encoder(tokenizer), TaskContext.get().partitionId(), 0
        out = None

        def finish() -> pa.RecordBatch:
            out.close()
            index = WholeFile(f"{path}.idx")
            index.write(b"".join(entries))
            index.close()
            row = {"part": part, "seq": seq, "path": path, "n_docs": len(entries), "n_ids": n_ids, "n_bytes": out.size}
            return pa.RecordBatch.from_pylist([row], schema=manifest)

        for batch in batches:
            ids_of = encode.encode((t.as_py() for t in batch.column("text")), end_id)
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), ids_of):
                if out is None:
                    path = f"{root}/data/part-{part:06d}-{seq:05d}.rec"
                    out, entries, n_ids = WholeFile(path), [], 0
                record = frame(pack_ids(doc_id, ids))
                entries.append(struct.pack(_ENTRY, out.size, len(record)))
                out.write(record)
                n_ids += len(ids)
                if out.size >= FILE_BYTES:
                    yield finish()
                    out, seq = None, seq + 1
        if out is not None:
            yield finish()

    manifest = pa.schema(
        [("part", pa.int32()), ("seq", pa.int32()), ("path", pa.string())]
        + [(c, pa.int64()) for c in ("n_docs", "n_ids", "n_bytes")]
    )
    spark = docs.sparkSession
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange("doc_id", F.xxhash64("text"))
        .sortWithinPartitions("doc_id", "text")
    )
    ordered.mapInArrow(released(write), MANIFEST).write.parquet(f"{root}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{root}/manifest")


def read_records(manifest: DataFrame) -> DataFrame:
    """The documents of the record files: doc_id, start, n_tokens, ids_crc32, path, record.

    ``start`` counts the ids of all documents before it in file order. Every checksum is
    verified. Work is one task per file; the running total over files reads one row each.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.to_pylist():
                rows, start, record = [], file["base"], 0
                with open_input(file["path"]) as stream:
                    while (payload := read_frame(stream)) is not None:
                        doc_id, ids = unpack_ids(payload)
                        crc = zlib.crc32(ids.astype("<u4").tobytes())
                        rows.append((doc_id, start, len(ids), crc, file["path"], record))
                        start, record = start + len(ids), record + 1
                        if len(rows) >= ROWS_OUT:
                            yield table(rows)
                            rows = []
                if rows:
                    yield table(rows)

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds.types)], schema=kinds)

    names = ("doc_id", "start", "n_tokens", "ids_crc32", "path", "record")
    kinds = pa.schema([(n, pa.string() if n == "path" else pa.int64()) for n in names])
    before = W.orderBy("part", "seq").rowsBetween(W.unboundedPreceding, -1)
    based = manifest.select("path", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))
    files = max(1, manifest.count())
    return based.repartition(files, "path").mapInArrow(
        released(read), ", ".join(f"{n} {'string' if n == 'path' else 'long'}" for n in names)
    )
