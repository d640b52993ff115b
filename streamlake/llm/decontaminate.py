"""Benchmark decontamination with an FM-index per training shard.

Each Arrow batch of documents is a shard. Its words, as numbers of the benchmark's
vocabulary, are indexed by suffix array, Burrows-Wheeler transform and wavelet matrix; all
benchmark windows are searched backward through it at once, and occurrences are located by
walking to the nearest sampled suffix. Words outside the vocabulary of the windows end a
run, and runs shorter than a window cannot hold one, so neither is indexed.

The benchmark goes to the tasks as files of blocks of bounded size, which they go through one
after another in a single pass over the documents.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from streamlake.llm.files import WholeFile, open_input
from streamlake.llm.tasks import released
from streamlake.llm.words import ByteTable, byte_table, find_words, hash_words, word_groups
from streamlake.session import scratch_dir

WINDOW = 10
BLOCK_BYTES = 8 << 20  # benchmark text of one block
GATHERED_BYTES = 64 << 20  # documents that a task holds while it goes through several blocks
SAMPLE = 32  # every so many suffix positions are stored
# ASCII characters outside 0-9 and a-z separate words (A-Z is lower-cased).
SEPARATORS = bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])


class Family:
    """The distinct windows of one length: their words, as vocabulary numbers from 1, and items."""

    def __init__(self, windows: np.ndarray, items: list[list[str]], vocabulary: int):
        self.windows, self.items, self.length = windows, items, windows.shape[1]
        self.used = np.zeros(vocabulary + 1, bool)
        self.used[windows] = True


class Phrases:
    """The windows of a block of benchmark items."""

    def __init__(self, items: list[tuple[object, str | None]]):
        words = find_words(*_join([text for _, text in items]), byte_table(SEPARATORS))
        hashes = hash_words(words)
        self.vocabulary = np.unique(hashes)
        numbers = np.searchsorted(self.vocabulary, hashes) + 1
        found: dict[int, dict[bytes, tuple[np.ndarray, set]]] = {}
        for (item, _), begin, end in zip(items, words.first[:-1], words.first[1:]):
            length = min(WINDOW, end - begin)
            for at in range(begin, end - length + 1) if length else ():
                window = numbers[at : at + length]
                entry = found.setdefault(int(length), {}).setdefault(window.tobytes(), (window, set()))
                if item is not None:
                    entry[1].add(str(item))
        self.families = [
            Family(np.array([w for w, _ in group.values()]), [sorted(i) for _, i in group.values()], len(self.vocabulary))
            for _, group in sorted(found.items())
        ]

    def number(self, hashes: np.ndarray) -> np.ndarray:
        """Vocabulary numbers, 0 for other words."""
        if not len(self.vocabulary):
            return np.zeros(len(hashes), np.int32)
        at = np.searchsorted(self.vocabulary, hashes)
        at[at == len(self.vocabulary)] = 0
        return np.where(self.vocabulary[at] == hashes, at + 1, 0).astype(np.int32)


def _join(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    parts = [(t or "").encode() for t in texts]
    return np.frombuffer(b"".join(parts), np.uint8), np.cumsum([0, *map(len, parts)])


class Ranks:
    """Bits with the count of ones before any position."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self._words = np.packbits(padded, bitorder="little").view(np.uint64)
        self._before = np.zeros(len(self._words), np.int64)
        np.cumsum(np.bitwise_count(self._words[:-1]), out=self._before[1:])

    def ones(self, at: np.ndarray) -> np.ndarray:
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        return self._before[word] + np.bitwise_count(self._words[word] & ((np.uint64(1) << bit) - np.uint64(1)))

    def get(self, at: np.ndarray) -> np.ndarray:
        return ((self._words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).astype(np.int64)


class WaveletMatrix:
    """Symbol ranks of a sequence, one bit level after the other."""

    def __init__(self, symbols: np.ndarray, largest: int):
        self._levels = []
        for shift in reversed(range(max(1, int(largest).bit_length()))):
            bits = (symbols >> shift) & 1
            ones = bits.astype(bool)
            self._levels.append((shift, Ranks(bits), len(symbols) - int(bits.sum())))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of ``symbol`` before position ``at``, elementwise."""
        low = np.zeros_like(at)
        for shift, ranks, zeros in self._levels:
            one = ((symbol >> shift) & 1).astype(bool)
            low_ones, at_ones = ranks.ones(low), ranks.ones(at)
            low = np.where(one, zeros + low_ones, low - low_ones)
            at = np.where(one, zeros + at_ones, at - at_ones)
        return at - low

    def symbol_and_rank(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at a position and its occurrences before it."""
        symbol, low = np.zeros_like(at), np.zeros_like(at)
        for _, ranks, zeros in self._levels:
            bit = ranks.get(at)
            one = bit.astype(bool)
            low_ones, at_ones = ranks.ones(low), ranks.ones(at)
            low = np.where(one, zeros + low_ones, low - low_ones)
            at = np.where(one, zeros + at_ones, at - at_ones)
            symbol = symbol << 1 | bit
        return symbol, at - low


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffix array of a text whose zeros end its runs; equal suffixes do not occur, as every
    zero is smaller than those after it. Prefix doubling over the ties that are left."""
    n = len(text)
    ends = text == 0
    first = np.where(ends, np.cumsum(ends) - 1, text.astype(np.int64) + n)
    order = np.argsort(first, kind="stable")
    rank = np.empty(n, np.int64)
    place = np.arange(n)
    new = np.ones(n, bool)
    new[1:] = first[order[1:]] != first[order[:-1]]
    rank[order] = np.maximum.accumulate(np.where(new, place, 0))
    tied = ~new
    tied[:-1] |= ~new[1:]
    open_, slots = order[tied], place[tied]
    step = 1
    while len(open_):
        group, follow = rank[open_], rank[open_ + step]
        inner = np.lexsort((follow, group))
        open_, group, follow = open_[inner], group[inner], follow[inner]
        new = np.ones(len(open_), bool)
        new[1:] = (group[1:] != group[:-1]) | (follow[1:] != follow[:-1])
        rank[open_] = np.maximum.accumulate(np.where(new, slots, 0))
        order[slots] = open_
        tied = ~new
        tied[:-1] |= ~new[1:]
        open_, slots = open_[tied], slots[tied]
        step *= 2
    return order


class FMIndex:
    """Count and locate windows in a text of zero-terminated runs."""

    def __init__(self, text: np.ndarray):
        order = suffix_order(text)
        last = text[order - 1]
        largest = int(text.max())
        self._before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=largest + 1))]).astype(np.int64)
        self._largest = largest
        self._tree = WaveletMatrix(last, largest)
        kept = (order % SAMPLE == 0) | (last == 0)  # a walk never leaves its run
        self._sampled, self._positions = Ranks(kept), order[kept]

    def search(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of the windows, by backward search from their last word."""
        low = np.zeros(len(windows), np.int64)
        high = np.full(len(windows), self._before[-1], np.int64)
        high[(windows > self._largest).any(axis=1)] = 0
        for k in reversed(range(windows.shape[1])):
            alive = np.flatnonzero(low < high)
            symbol = windows[alive, k].astype(np.int64)
            low[alive] = self._before[symbol] + self._tree.rank(symbol, low[alive])
            high[alive] = self._before[symbol] + self._tree.rank(symbol, high[alive])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows, each by a walk back to a sampled suffix."""
        out, walking, steps = np.empty_like(rows), np.arange(len(rows)), 0
        while len(walking):
            here = self._sampled.get(rows).astype(bool)
            out[walking[here]] = self._positions[self._sampled.ones(rows[here])] + steps
            walking, rows = walking[~here], rows[~here]
            symbol, rank = self._tree.symbol_and_rank(rows)
            rows, steps = self._before[symbol] + rank, steps + 1
        return out


def _runs(numbers: np.ndarray, family: Family) -> tuple[np.ndarray, np.ndarray]:
    """(indexed text, place of each of its words) of the runs that can hold a window; a zero
    number separates documents."""
    inside = np.zeros(len(numbers) + 2, bool)
    inside[1:-1] = family.used[numbers] & (numbers > 0)
    begins = np.flatnonzero(inside[1:-1] & ~inside[:-2])
    ends = np.flatnonzero(inside[1:-1] & ~inside[2:]) + 1
    long_ = ends - begins >= family.length
    begins, lengths = begins[long_], (ends - begins)[long_] + 1  # one more for the terminator
    total = int(lengths.sum())
    offsets = np.cumsum(lengths) - lengths
    places = np.arange(total) + np.repeat(begins - offsets, lengths)
    text = numbers[np.minimum(places, len(numbers) - 1)].copy()
    text[offsets + lengths - 1] = 0
    return text, places


def find_hits(numbers: np.ndarray, phrases: Phrases) -> Iterator[tuple[np.ndarray, int, np.ndarray, Family]]:
    """(first words, window length, window numbers, family) of all occurrences in a shard."""
    for family in phrases.families:
        text, places = _runs(numbers, family)
        if len(text):
            index = FMIndex(text)
            low, high = index.search(family.windows)
            count = high - low
            which = np.repeat(np.arange(len(count)), count)
            rows = np.arange(int(count.sum())) + np.repeat(low - (np.cumsum(count) - count), count)
            yield places[index.locate(rows)], family.length, which, family


HITS = "n_words long, spans array<struct<start:long,end:long>>, items array<string>"


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def _scan(batch: pa.RecordBatch, phrases: Phrases, table: ByteTable) -> pa.RecordBatch:
    parts, counts, zero = [], [], np.zeros(1, np.int32)
    for _, _, words in word_groups(batch.column("text"), table):
        counts.append(np.diff(words.first))
        # A zero after each document keeps runs apart; it takes one place.
        parts.append(np.insert(phrases.number(hash_words(words)), words.first[1:], 0))
    n_words = np.concatenate(counts) if counts else np.zeros(0, np.int64)
    numbers = np.concatenate([*parts, zero])
    begins = np.concatenate([[0], np.cumsum(n_words + 1)])
    hit = np.zeros(len(numbers) + 1, np.int32)
    items: dict[int, set] = {}
    for first, length, which, family in find_hits(numbers, phrases):
        np.add.at(hit, first, 1)
        np.add.at(hit, first + length, -1)
        rows = np.searchsorted(begins, first, "right") - 1
        for row, window in np.unique(np.stack([rows, which], axis=1), axis=0).tolist():
            items.setdefault(row, set()).update(family.items[window])
    inside = np.concatenate([[False], np.cumsum(hit) > 0])
    edges = np.diff(inside.astype(np.int8))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    spans: dict[int, list] = {}
    rows = np.searchsorted(begins, starts, "right") - 1
    for row, start, end in zip(rows.tolist(), (starts - begins[rows]).tolist(), (ends - begins[rows]).tolist()):
        spans.setdefault(row, []).append((start, end))
    if "spans" in batch.schema.names:  # what earlier blocks found
        for row, (old, named) in enumerate(zip(batch.column("spans").to_pylist(), batch.column("items").to_pylist())):
            if old:
                spans[row] = _merge([*spans.get(row, []), *[(s["start"], s["end"]) for s in old]])
                items[row] = items.get(row, set()) | set(named)
    own = [c for c in batch.schema.names if c not in ("n_words", "spans", "items")]
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    found = [[{"start": s, "end": e} for s, e in spans.get(r, ())] for r in range(batch.num_rows)]
    named = [sorted(items.get(r, ())) for r in range(batch.num_rows)]
    return pa.RecordBatch.from_arrays(
        [*batch.select(own).columns, pa.array(n_words, pa.int64()), pa.array(found, span), pa.array(named, pa.list_(pa.string()))],
        names=[*own, "n_words", "spans", "items"],
    )


def benchmark_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple]]:
    """The items, in blocks of about ``block_bytes`` of text or one item; never all at once."""
    size = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 + size // block_bytes
    for k in range(blocks):
        block = benchmark.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        yield [(r["item_id"], r["text"]) for r in block.select("item_id", "text").collect()]


def _write_phrases(benchmark: DataFrame, block_bytes: int) -> list[str]:
    """One file of phrases per block, in the shared folder."""
    root, paths = scratch_dir(benchmark.sparkSession, "phrases"), []
    for items in benchmark_blocks(benchmark, block_bytes):
        paths.append(f"{root}/{len(paths):06d}")
        out = WholeFile(paths[-1])
        out.write(pickle.dumps(Phrases(items)))
        out.close()
    return paths


def _read_phrases(path: str) -> Phrases:
    with open_input(path) as f:
        return pickle.loads(f.read())


def _gathered(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Batches of about ``most`` bytes or one batch."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.nbytes for b in held) >= most:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)


def find_contamination(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Adds n_words, spans (merged ranges of hit words, end exclusive) and items (ids of the
    items with an occurring window, sorted as strings) to ``docs``.

    Needs a column ``text``; columns of the added names are replaced and all others kept.
    Null text has no words. Items without words have no windows; items without an id mark
    words and are not named. Repeated rows are scanned like others. With an empty
    benchmark nothing is hit. The documents are read in one pass; with several blocks of
    phrases a task goes through them for every ``GATHERED_BYTES`` of documents, and holds
    one at a time.
    """
    docs = docs.drop("n_words", "spans", "items")
    paths = _write_phrases(benchmark, block_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = byte_table(SEPARATORS)
        single = _read_phrases(paths[0]) if len(paths) == 1 else None
        for batch in batches if single else _gathered(batches, GATHERED_BYTES):
            for path in paths:
                batch = _scan(batch, single or _read_phrases(path), table)
            yield batch

    schema = StructType([*docs.schema.fields, *docs.sparkSession.createDataFrame([], HITS).schema.fields])
    return docs.mapInArrow(released(run), schema)


def remove_spans(found: DataFrame) -> DataFrame:
    """``text`` without the characters from the first to the last word of every span, and
    without the columns that ``find_contamination`` added."""
    own = [c for c in found.columns if c not in ("n_words", "spans", "items")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = byte_table(SEPARATORS)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for row, spans in enumerate(batch.column("spans")):
                if len(spans):
                    data, offsets = _join([texts[row]])
                    words = find_words(data, offsets, table)
                    kept, at = [], 0
                    for span in spans.as_py():
                        kept.append(data[at : words.starts[span["start"]]])
                        at = words.ends[span["end"] - 1]
                    texts[row] = b"".join(map(bytes, [*kept, data[at:]])).decode()
            columns = [pa.array(texts, pa.string()) if c == "text" else batch.column(c) for c in own]
            yield pa.RecordBatch.from_arrays(columns, names=own)

    return found.mapInArrow(released(run), found.select(*own).schema)
