"""Words and word hashes of many texts at once, on their UTF-8 bytes with numpy.

Arrow hands over the texts of a batch as one buffer. 256-entry tables lower-case A-Z and
mark separators, so words are found without a Python string or loop per word; bytes of
multi-byte characters always belong to words.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

GROUP_BYTES = 1 << 20  # texts handled together; a longer text is a group of its own, hashed in parts

# Multipliers of the 64-bit word hash (odd) and of its finishing mix.
_BASE = 0x9E3779B97F4A7C15
_MIX_1, _MIX_2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


class ByteTable(NamedTuple):
    """Per byte its lower case, and whether words may hold it."""

    lower: bytes
    inside: bytes


def byte_table(separators: bytes) -> ByteTable:
    return ByteTable(bytes(range(256)).lower(), bytes(b not in separators for b in range(256)))


class Words(NamedTuple):
    """Words of a group of texts: byte positions in ``data`` (lower-cased), and per text the
    index of its first word (one more entry than texts)."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8), offsets


def word_groups(column: pa.Array, table: ByteTable) -> Iterator[tuple[int, int, Words]]:
    """(first row, end row, words) for runs of rows of about ``GROUP_BYTES``."""
    data, offsets = _bytes_of(column)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + GROUP_BYTES, "right")) - 1)
        yield row, end, find_words(data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row], table)
        row = end


def find_words(data: np.ndarray, offsets: np.ndarray, table: ByteTable) -> Words:
    raw = data.tobytes()
    lower = np.frombuffer(raw.translate(table.lower), np.uint8)
    inside = np.zeros(len(lower) + 1, bool)
    inside[:-1] = np.frombuffer(raw.translate(table.inside), bool)
    opens, closes = inside[:-1].copy(), inside[:-1].copy()
    opens[1:] &= ~inside[:-2]
    closes &= ~inside[1:]
    borders = offsets[(offsets > 0) & (offsets < len(lower))]  # a word never runs into the next text
    opens[borders] = inside[borders]
    closes[borders - 1] = inside[borders - 1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return Words(lower, starts, ends, np.searchsorted(starts, offsets))


_POWERS: list[np.ndarray] = []


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, n of them or more. Those for
    ``GROUP_BYTES`` are kept; more are made for one call."""
    if not _POWERS:
        _POWERS.extend(_power_pair(GROUP_BYTES + 1))
    return _POWERS if n <= GROUP_BYTES + 1 else _power_pair(n)


def _power_pair(n: int) -> list[np.ndarray]:
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        powers = np.full(n, base, np.uint64)
        powers[0] = 1
        out.append(np.multiply.accumulate(powers))
    return out


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values in place."""
    for factor in (_MIX_1, _MIX_2):
        h ^= h >> np.uint64(33)
        h *= factor
    h ^= h >> np.uint64(33)
    return h


def hash_words(words: Words) -> np.ndarray:
    """64-bit hash of each word: a polynomial in its bytes, taken from a running sum over
    some ``GROUP_BYTES`` of words at a time."""
    out = np.empty(len(words.starts), np.uint64)
    at = 0
    while at < len(out):
        begin = words.starts[at]
        to = max(at + 1, int(np.searchsorted(words.ends, begin + GROUP_BYTES, "right")))
        data = words.data[begin : words.ends[to - 1]]
        starts, ends = words.starts[at:to] - begin, words.ends[at:to] - begin
        up, down = _powers(len(data) + 1)
        running = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=running[1:])
        h = (running[ends] - running[starts]) * down[starts]
        out[at:to] = mix(h + (ends - starts).astype(np.uint64) * _MIX_2)
        at = to
    return out


def shingles(hashes: np.ndarray, first: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """Per text the sorted distinct hashes of its ``width``-word shingles; a shorter text is
    one shingle, a text without words has none."""
    whole = np.zeros(max(0, len(hashes) - width + 1), np.uint64)
    for k in range(width):
        whole = whole * _MIX_1 + hashes[k : k + len(whole)]
    mix(whole)
    for begin, end in zip(first[:-1].tolist(), first[1:].tolist()):
        if end - begin >= width:
            yield np.unique(whole[begin : end - width + 1])
        elif end > begin:
            short = np.full(1, end - begin, np.uint64)
            for k in range(begin, end):
                short = short * _MIX_2 + hashes[k : k + 1]
            yield mix(short)
        else:
            yield np.zeros(0, np.uint64)
