"""Best-fit packing of documents into sequences by the sum-of-squares rule.

A document goes where the sum, over all residual gaps, of the squared number of open
sequences with that gap becomes smallest: into an open sequence or a new one. So the gaps
stay spread over many sizes and one that fits is at hand. Only a document longer than a
sequence is cut, into whole sequences and a rest.

The rule needs nothing but counts per gap, so tasks pack as they read. What is still well
open at the end of a task is packed again with that of other tasks, its ids shuffled once.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlake.llm.files import staged
from streamlake.llm.ids import encoder
from streamlake.llm.tasks import released

SEQUENCE_TOKENS = 4096
LOOKAHEAD_TOKENS = 1 << 20  # documents are packed in runs of so many tokens, the longest first
MAX_OPEN = 2048  # open sequences of a task; beyond it the fullest one is closed
SETTLED_GAP = 1 / 16  # of a sequence: with a smaller gap it is not packed again
REPACK_TOKENS = 1 << 21  # tokens of a second-pass task
BATCH_BYTES = 8 << 20

PIECES = (
    "doc_id long, piece int, start long, length long, ids binary, doc_tokens long, "
    "sequence_id long, offset long, settled boolean"
)
_NEVER = -(1 << 30)


class Piece(NamedTuple):
    doc_id: int | None
    piece: int
    start: int
    length: int
    ids: bytes  # little-endian, of the encoder's width, of this piece only
    doc_tokens: int


class GapCounts:
    """The rule on lengths alone: which gap to put a length into.

    Moving a sequence from gap g to g - n changes the sum of squares by twice
    ``N[g - n] - N[g] + 1``; a gap of 0 and the whole sequence are not counted. The smallest
    gap wins between equals.
    """

    def __init__(self, size: int):
        self.size = size
        self._after = np.zeros(size + 1, np.int64)  # twice the count, by the gap that is left
        self._before = np.full(size + 1, _NEVER, np.int64)  # the same where a sequence is open
        self._after[0], self._before[size] = -1, 1

    def choose(self, length: int) -> int:
        """The gap to fill, ``size`` for a new sequence."""
        return length + int(np.argmin(self._after[: self.size - length + 1] - self._before[length:]))

    def add(self, gap: int, count: int) -> None:
        if 0 < gap < self.size:
            self._after[gap] += 2 * count
            self._before[gap] = self._after[gap] or _NEVER

    def total(self) -> int:
        """The sum of squares."""
        return int((self._after[1 : self.size] ** 2).sum()) // 4


class SequencePacker:
    """Packs runs of pieces. Holds the ids of ``MAX_OPEN`` open sequences at most."""

    def __init__(self, size: int = SEQUENCE_TOKENS, max_open: int = MAX_OPEN):
        self._counts = GapCounts(size)
        self._size, self._max_open = size, max_open
        self._open: dict[int, list[list[Piece]]] = {}  # by gap
        self.n_open = 0

    def place(self, items: list[Piece]) -> Iterator[list[Piece]]:
        """Puts pieces that stay together into a sequence; gives sequences that are closed by it."""
        length = sum(p.length for p in items)
        gap = self._counts.choose(length)
        sequence = self._take(gap) if gap < self._size else []
        sequence.extend(items)
        if gap == length:
            yield sequence
            return
        self._open.setdefault(gap - length, []).append(sequence)
        self._counts.add(gap - length, 1)
        self.n_open += 1
        if self.n_open > self._max_open:
            yield self._take(min(self._open))

    def _take(self, gap: int) -> list[Piece]:
        found = self._open[gap].pop()
        if not self._open[gap]:
            del self._open[gap]
        self._counts.add(gap, -1)
        self.n_open -= 1
        return found

    def rest(self) -> list[tuple[int, list[Piece]]]:
        """(gap, sequence) of what is open, the fullest first; nothing is open after it."""
        gaps = sorted(gap for gap, found in self._open.items() for _ in found)
        return [(gap, self._take(gap)) for gap in gaps]

    def merge_open(self) -> Iterator[list[Piece]]:
        """Packs the open sequences as wholes, by the same rule, while that saves some."""
        before = self.n_open + 1
        while self.n_open < before:
            before = self.n_open
            for _, sequence in self.rest():
                yield from self.place(sequence)


def longest_first(pieces: Iterable[Piece], packer: SequencePacker, tokens: int = LOOKAHEAD_TOKENS) -> Iterator[list[Piece]]:
    """Packs pieces in runs of ``tokens``, the longest of a run first; gives closed sequences."""
    run: list[Piece] = []
    held = 0
    for piece in pieces:
        run.append(piece)
        held += piece.length
        if held >= tokens:
            yield from _pack_run(run, packer)
            run, held = [], 0
    yield from _pack_run(run, packer)


def _pack_run(run: list[Piece], packer: SequencePacker) -> Iterator[list[Piece]]:
    run.sort(key=lambda p: -p.length)  # stable: equal lengths stay in the order of arrival
    for piece in run:
        yield from packer.place([piece])


class _Rows:
    """Output batches of packed sequences."""

    def __init__(self, first_id: int, dtype: np.dtype):
        self._next, self._dtype = first_id, dtype
        self._rows: list[tuple] = []
        self._bytes = 0

    def add(self, sequence: list[Piece], settled: bool) -> Iterator[pa.RecordBatch]:
        offset = 0
        for p in sequence:
            ids = np.frombuffer(p.ids, self._dtype).astype("<u4").tobytes()
            self._rows.append((p.doc_id, p.piece, p.start, p.length, ids, p.doc_tokens, self._next, offset, settled))
            offset += p.length
        self._next += 1
        self._bytes += 4 * offset
        if self._bytes >= BATCH_BYTES:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self._rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*self._rows), _KINDS.types)], schema=_KINDS)
        self._rows, self._bytes = [], 0


_ARROW = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_()}
_KINDS = pa.schema([(c.split()[0], _ARROW[c.split()[1]]) for c in PIECES.split(", ")])


def cut(doc_id: int | None, ids: np.ndarray, size: int) -> Iterator[Piece]:
    """Pieces of ``size`` ids, the last one shorter; each has bytes of its own."""
    for n, start in enumerate(range(0, len(ids), size)):
        part = ids[start : start + size]
        yield Piece(doc_id, n, start, len(part), part.tobytes(), len(ids))


def pack_best_fit(docs: DataFrame, tokenizer: str, end_id: int, size: int = SEQUENCE_TOKENS) -> DataFrame:
    """``(doc_id, text)`` to the pieces of packed sequences, one row per piece.

    Each document is its ids and ``end_id``; only one longer than ``size`` is cut. ``ids`` are
    the piece's ids as little-endian unsigned 32-bit integers, ``sequence_id`` names the
    sequence and ``offset`` the place in it. Null text is an empty document, whose end id
    alone is packed; a null ``doc_id`` stays null. Repeated rows are documents of their own,
    other columns are ignored, an empty table gives no rows.

    The first pass has no shuffle. It holds a run of ``LOOKAHEAD_TOKENS`` and ``MAX_OPEN``
    sequences; the second pass sees only sequences with a gap over ``SETTLED_GAP``, dealt out
    evenly, ``REPACK_TOKENS`` a task, so its tasks keep their size as the input grows.
    """

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer = encoder(tokenizer), SequencePacker(size)
        rows = _Rows(TaskContext.get().partitionId() << 40, encode.dtype)

        def pieces() -> Iterator[Piece]:
            for batch in batches:
                ids_of = encode.encode((t.as_py() for t in batch.column("text")), end_id)
                for doc_id, ids in zip(batch.column("doc_id").to_pylist(), ids_of):
                    yield from cut(doc_id, ids, size)

        for sequence in longest_first(pieces(), packer):
            yield from rows.add(sequence, True)
        for gap, sequence in packer.rest():
            yield from rows.add(sequence, gap <= size * SETTLED_GAP)
        yield from rows.flush()

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = SequencePacker(size)
        rows = _Rows((1 << 62) + (TaskContext.get().partitionId() << 40), np.dtype("<u4"))
        columns = [c for c in Piece._fields]
        pieces = (Piece(*r) for b in batches for r in zip(*(b.column(c).to_pylist() for c in columns)))
        for sequence in longest_first(pieces, packer, 4 * REPACK_TOKENS):
            yield from rows.add(sequence, True)
        for sequence in packer.merge_open():
            yield from rows.add(sequence, True)
        for _, sequence in packer.rest():
            yield from rows.add(sequence, True)
        yield from rows.flush()

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    packed = staged(texts.mapInArrow(released(first), PIECES), "packed")
    unsettled = packed.filter(~F.col("settled"))
    tokens = unsettled.agg(F.sum("length")).first()[0] or 0
    dealt = unsettled.repartition(max(1, -(-tokens // REPACK_TOKENS)), "sequence_id")
    return packed.filter("settled").unionByName(dealt.mapInArrow(released(again), PIECES)).drop("settled")
