"""Whitening of embeddings from a blockwise QR factorisation of the centred rows.

Entries become whole numbers, so means and distances are exact. Tasks reduce the centred
distinct vectors to one triangular factor each, block by block; factors are merged by
further QR steps in groups of ``FAN_IN``, so the rows never meet in one place and no
covariance is formed. ``bidiagonal`` solves the last factor, of the size of the dimensions.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from streamlake.llm.bidiagonal import right_directions
from streamlake.llm.files import staged
from streamlake.llm.tasks import released

SCALE, ORIGIN = 64, 1_000_000
LARGEST = 1 << 52  # entries beyond it, as whole numbers, are set to it
COMPONENTS = 16
BLOCK_VALUES = 1 << 20  # entries that are factored at once
FAN_IN = 16  # factors merged by a task
_EXACT = float(1 << 62)


class Whitening(NamedTuple):
    """What rows are whitened with: the fit list's size and sums, and per component its direction
    (a column), variance and share of the total variance."""

    n: int
    sums: tuple[int, ...]
    directions: np.ndarray
    variances: np.ndarray
    explained: np.ndarray

    @property
    def origin(self) -> tuple[np.ndarray, np.ndarray]:
        """(whole part, rest times n) of the mean, exact."""
        parts = [divmod(s, self.n) for s in self.sums]
        return np.array([p[0] for p in parts], np.int64), np.array([p[1] for p in parts], np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        whole, rest = self.origin
        return (x - whole) - rest / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums of ``(n x - S)^2``, exact; None where a long cannot hold it."""
        whole, rest = self.origin
        about = (self.centred(x) * self.n) ** 2
        small = about.sum(axis=1) < _EXACT
        apart = np.where(small[:, None], x - whole, 0) * self.n - np.where(small[:, None], rest, 0)
        sums = (apart * apart).sum(axis=1)
        return [int(s) if ok else None for s, ok in zip(sums, small)]

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.directions / np.sqrt(self.variances))


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of a binary column of 64-bit integers; a view of Arrow's buffer."""
    column = column.cast(pa.large_binary())
    if not len(column):
        return np.zeros((0, dims), np.int64)
    begin = np.frombuffer(column.buffers()[1], np.int64)[column.offset]
    return np.frombuffer(column.buffers()[2], np.int64, len(column) * dims, begin).reshape(-1, dims)


def whole_vectors(rows: DataFrame, vector: str = "embedding") -> tuple[DataFrame, int]:
    """(the rows with a usable vector, with ``x`` as 64-bit integers in place of it; dimensions).

    ``x`` is ``floor(64 c) + 1000000`` of each entry, in bytes; beyond 2**52 it is set to that.
    A vector that is null, has a null or non-finite entry or another length than most vectors
    (the longer one between equals) is dropped. A column ``x`` of the input is replaced.
    """
    own = [c for c in rows.columns if c not in (vector, "x")]
    sizes = rows.groupBy(F.size(vector).alias("size")).agg(F.count(F.lit(1)).alias("n")).filter("size > 0")
    top = sizes.agg(F.max(F.struct("n", "size")).alias("top")).first()["top"]
    dims = top["size"] if top else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(vector)
            flat = lists.flatten().cast(pa.float64())
            values = flat.to_numpy(zero_copy_only=False).reshape(-1, dims)
            finite = np.isfinite(values).all(axis=1)
            x = np.floor(SCALE * np.where(finite[:, None], values, 0.0)).clip(-LARGEST, LARGEST).astype(np.int64) + ORIGIN
            data = pa.array([r.tobytes() for r in x], pa.binary())
            out = pa.RecordBatch.from_arrays([*batch.select(own).columns, data], names=[*own, "x"])
            yield out.filter(pa.array(finite))

    usable = F.coalesce((F.size(vector) == dims) & ~F.exists(vector, lambda v: v.isNull()), F.lit(False))
    kept = rows.filter(usable if dims else F.lit(False)).select(*own, F.col(vector).cast("array<double>").alias(vector))
    return staged(kept.mapInArrow(released(run), rows.select(*own).schema.add("x", "binary")), "whole-vectors"), dims


def _sums(fit: DataFrame, dims: int) -> tuple[int, tuple[int, ...]]:
    """(rows, exact sum per dimension). Each task sends one row per dimension; high and low
    halves are added apart, so nothing overflows."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, low, n = np.zeros(dims, np.int64), np.zeros(dims, np.int64), 0
        for batch in batches:
            x = matrix(batch.column("x"), dims)
            high += (x >> 26).sum(axis=0)
            low += (x & ((1 << 26) - 1)).sum(axis=0)
            n += len(x)
        arrays = [np.arange(dims), high, low, np.full(dims, n)]
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()) for a in arrays], names=["dim", "high", "low", "n"])

    parts = fit.select("x").mapInArrow(released(add), "dim long, high long, low long, n long")
    exact = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")]
    found = parts.groupBy("dim").agg(*exact, F.sum("n").alias("n")).orderBy("dim").collect()  # a row per dimension
    return (found[0]["n"] if found else 0), tuple((int(r["high"]) << 26) + int(r["low"]) for r in found)


def _factor(blocks: Iterator[np.ndarray], dims: int) -> np.ndarray:
    """The triangular factor of all rows together: each block is factored below the factor so far."""
    r = np.zeros((0, dims))
    for block in blocks:
        r = np.linalg.qr(np.vstack([r, block]), mode="r")
    return r


def triangular_factor(fit: DataFrame, model: Whitening, dims: int) -> np.ndarray:
    """R of the centred fit list. The driver receives one matrix of the size of the dimensions."""
    rows_at_once = max(dims, BLOCK_VALUES // dims)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in batches:
            x = matrix(batch.column("x"), dims)
            for k in range(0, len(x), rows_at_once):
                yield model.centred(x[k : k + rows_at_once])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = _factor(blocks(batches), dims)
        if len(r):
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_pylist([{"part": part, "factor": r.tobytes()}], schema=kinds)

    def merge(group: pa.Table) -> pa.Table:
        rows = group.sort_by("part").to_pylist()
        r = _factor((np.frombuffer(row["factor"]).reshape(-1, dims) for row in rows), dims)
        return pa.Table.from_pylist([{"part": rows[0]["part"] // FAN_IN, "factor": r.tobytes()}], schema=kinds)

    kinds = pa.schema([("part", pa.int64()), ("factor", pa.binary())])
    schema = "part long, factor binary"
    factors = staged(fit.select("x").mapInArrow(released(first), schema), "factors")
    while factors.count() > 1:
        grouped = factors.groupBy(F.floor(F.col("part") / FAN_IN)).applyInArrow(merge, schema)
        factors = staged(grouped, "factors")
    row = factors.first()
    r = np.frombuffer(row["factor"]).reshape(-1, dims) if row else np.zeros((0, dims))
    return np.vstack([r, np.zeros((dims - len(r), dims))])


def fit(distinct: DataFrame, dims: int, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the fit list, whose rows have each ``x`` once; None without rows.

    Components go by falling variance; one without any variance but rounding is left out,
    so constant dimensions and single vectors give fewer.
    """
    n, sums = _sums(distinct, dims)
    if not n:
        return None
    bare = Whitening(n, sums, np.zeros((dims, 0)), np.zeros(0), np.zeros(0))
    r = triangular_factor(distinct, bare, dims)
    values, directions = right_directions(r, components)
    variances = values**2 / n
    return bare._replace(directions=directions, variances=variances, explained=variances * n / max(float((r**2).sum()), 1e-300))


def identity_error(distinct: DataFrame, model: Whitening, dims: int) -> float:
    """The largest entry of the whitened fit list's covariance minus the identity, by magnitude.

    Measured on all rows of the fit list; tasks send sums per pair of components.
    """
    k = len(model.variances)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for batch in batches:
            w = model.whiten(matrix(batch.column("x"), dims))
            total += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array(range(k * k), pa.int64()), pa.array(total.ravel())], names=["at", "v"])

    sums = distinct.mapInArrow(released(add), "at long, v double").groupBy("at").agg(F.sum("v").alias("v"))
    wanted = F.when(F.col("at") % (k + 1) == 0, 1.0).otherwise(0.0)
    return sums.agg(F.max(F.abs(F.col("v") / model.n - wanted))).first()[0]


def transform(vectors: DataFrame, model: Whitening, dims: int) -> DataFrame:
    """``vectors`` with ``deviation`` (exact; null beyond a long) and ``whitened``, one entry per
    component, in place of ``x``. Columns of these names are replaced."""
    own = [c for c in vectors.columns if c not in ("x", "deviation", "whitened")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("x"), dims)
            deviations = pa.array(model.deviations(x), pa.int64())
            whitened = pa.array(list(model.whiten(x)), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.select(own).columns, deviations, whitened], names=[*own, "deviation", "whitened"])

    schema = vectors.select(*own).schema.add("deviation", "long").add("whitened", ArrayType(DoubleType()))
    return vectors.select(*own, "x").mapInArrow(released(run), schema)


def whiten(rows: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``rows`` with a usable vector, one row per component: adds component (from 1), n, deviation,
    whitened, explained and identity_error, and takes ``vector`` away.

    Equal vectors count once in the fit and are all whitened. An empty table, or vectors
    without any variance, give no rows. Other columns stay; those of the names above, ``x``,
    are replaced.
    """
    added = ("component", "n", "deviation", "whitened", "explained", "identity_error")
    own = [c for c in rows.columns if c.lower() not in (*added, "x") and c != vector]
    usable, dims = whole_vectors(rows.select(*own, vector), vector)
    distinct = staged(usable.select("x").distinct(), "distinct-vectors")
    model = fit(distinct, dims, components) if dims else None
    if model is None or not len(model.variances):
        kinds = ("int", "long", "long", "double", "double", "double")
        empty = [F.lit(None).cast(t).alias(c) for c, t in zip(added, kinds)]
        return usable.select(*own, *empty).filter(F.lit(False))
    error = identity_error(distinct, model, dims)
    explained = F.array(*[F.lit(float(e)) for e in model.explained])
    one = F.posexplode(F.arrays_zip("whitened", explained.alias("explained"))).alias("_at", "_pair")
    return transform(usable, model, dims).select(*own, "deviation", one).select(
        *own,
        (F.col("_at") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        F.col("_pair.whitened").alias("whitened"),
        F.col("_pair.explained").alias("explained"),
        F.lit(error).alias("identity_error"),
    )
