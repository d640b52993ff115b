"""Hierarchical packing of token ids into windows of several lengths.

A document is cut into whole longest windows, and its rest is routed to the smallest tier
that holds it. Each tier is packed from the longest down: a window starts with its tier's
longest rest, its gap is filled with the largest rests of shorter tiers that fit, and what
is still open with a cut from another rest, whose end returns to its own tier. So every
window but the last ones of a partition is full. Windows of one tier form step groups of
equal token count.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlake.llm.ids import encoder
from streamlake.llm.tasks import released

TIERS = (256, 512, 1024, 2048)
STEP_TOKENS = 32_768  # tokens of a step group
POOL_TOKENS = 1 << 20  # rests kept before a partition's tiers are packed
BATCH_BYTES = 8 << 20

PIECES = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, "
    "sequence_id long, offset long, tier int, step_group long"
)


class Piece(NamedTuple):
    length: int
    order: int  # of arrival; equal lengths go by it
    start: int
    doc_id: int | None
    ids: np.ndarray  # of this piece
    doc_tokens: int

    def cut(self, at: int) -> tuple[Piece, Piece]:
        head = self._replace(length=at, ids=self.ids[:at])
        return head, self._replace(length=self.length - at, start=self.start + at, ids=self.ids[at:])


class TierPacker:
    """Packs the documents of one partition. Between two documents it holds ``POOL_TOKENS`` of
    rests and one longest window at most; a rest has ids of its own, so it keeps no document alive."""

    def __init__(self, tiers: tuple[int, ...] = TIERS, pool_tokens: int = POOL_TOKENS):
        self.tiers = tuple(sorted(tiers))
        self._longest = self.tiers[-1]
        self._limit = pool_tokens
        self._pools: dict[int, list[tuple]] = {t: [] for t in self.tiers}
        self._held = self._order = 0

    def _route(self, piece: Piece) -> None:
        tier = next(t for t in self.tiers if t >= piece.length)
        if piece.ids.base is not None:
            piece = piece._replace(ids=piece.ids.copy())
        insort(self._pools[tier], (piece.length, -piece.order, piece))
        self._held += piece.length

    def _take(self, tier: int, at: int = -1) -> Piece:
        piece = self._pools[tier].pop(at)[-1]
        self._held -= piece.length
        return piece

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[tuple[int, list[Piece]]]:
        """Windows that are complete now, as (tier, pieces)."""
        self._order += 1
        rest = Piece(len(ids), self._order, 0, doc_id, ids, len(ids))
        while rest.length >= self._longest:
            window, rest = rest.cut(self._longest)
            yield self._longest, [window]
        if rest.length:
            self._route(rest)
        if self._held >= self._limit:
            yield from self._drain(final=False)

    def finish(self) -> Iterator[tuple[int, list[Piece]]]:
        yield from self._drain(final=True)

    def _fitting(self, gap: int) -> Piece | None:
        """The largest rest that fits, from the longest tier that has one."""
        for tier in reversed(self.tiers):
            at = bisect_right(self._pools[tier], (gap, 1)) - 1  # the second entry is never positive
            if at >= 0:
                return self._take(tier, at)
        return None

    def _drain(self, final: bool) -> Iterator[tuple[int, list[Piece]]]:
        for tier in reversed(self.tiers):
            while self._pools[tier]:
                window, gap = [], tier
                while gap and (piece := self._fitting(gap)):
                    window.append(piece)
                    gap -= piece.length
                if gap and (donor := next((t for t in self.tiers if self._pools[t]), None)):
                    head, rest = self._take(donor).cut(gap)
                    window.append(head)
                    self._route(rest)
                    gap = 0
                if not gap:
                    yield tier, window
                elif final:
                    yield from self._tail(window)
                else:  # nothing else is left: wait for more
                    for piece in window:
                        self._route(piece)
                    return

    def _tail(self, window: list[Piece]) -> Iterator[tuple[int, list[Piece]]]:
        """The last tokens of a partition: whole windows of the tiers they fill, and one that is padded."""
        for tier in reversed(self.tiers):
            while sum(p.length for p in window) >= tier:
                full, gap = [], tier
                while gap:
                    piece = window.pop(0)
                    if piece.length > gap:
                        piece, rest = piece.cut(gap)
                        window.insert(0, rest)
                    full.append(piece)
                    gap -= piece.length
                yield tier, full
        if window:
            yield self.tiers[0], window


def pack(docs: DataFrame, tokenizer: str, end_id: int, tiers: tuple[int, ...] = TIERS) -> DataFrame:
    """``(doc_id, text)`` to the pieces of packed sequences, one row per piece.

    ``ids`` are the piece's ids as little-endian unsigned 32-bit integers; ``sequence_id``
    names the window, ``offset`` the piece's place in it, ``tier`` its size. Documents of a
    partition are packed together, without a shuffle, so a partition leaves at most one
    window that is not full. Null text is an empty document: its end id alone is packed.
    Repeated rows are documents of their own; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer = encoder(tokenizer), TierPacker(tiers)
        place = TaskContext.get().partitionId() << 40
        rows: list[tuple] = []
        made = {t: 0 for t in packer.tiers}
        sequences = size = 0

        def emit(windows) -> Iterator[pa.RecordBatch]:
            nonlocal rows, sequences, size
            for tier, window in windows:
                level = packer.tiers.index(tier)
                group = place + (level << 36) + made[tier] * tier // STEP_TOKENS
                made[tier] += 1
                offset = 0
                for p in window:
                    ids = p.ids.astype("<u4").tobytes()
                    rows.append((p.doc_id, p.start, p.length, ids, p.doc_tokens, place + sequences, offset, tier, group))
                    offset += p.length
                size += offset * 4
                sequences += 1
                if size >= BATCH_BYTES:
                    yield table(rows)
                    rows, size = [], 0

        for batch in batches:
            ids_of = encode.encode((t.as_py() for t in batch.column("text")), end_id)
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), ids_of):
                yield from emit(packer.add(doc_id, ids))
        yield from emit(packer.finish())
        if rows:
            yield table(rows)

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds.types)], schema=kinds)

    special = {"ids": pa.binary(), "tier": pa.int32()}
    kinds = pa.schema([(c.split()[0], special.get(c.split()[0], pa.int64())) for c in PIECES.split(", ")])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(released(run), PIECES)
