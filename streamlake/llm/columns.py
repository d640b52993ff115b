"""Columns of the caller that an operator passes on without knowing them."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def aside(df: DataFrame, known: Sequence[str], added: Sequence[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """(``df`` whose columns outside ``known`` have names of their own; the way back).

    So no name of the caller meets one that the operator uses inside. The way back gives the
    caller's columns in order and then ``added``; a column of the caller with one of these
    names, in any case, is left out.
    """
    taken = {c.lower() for c in added}
    names = {c: c if c in known else f"_own_{n}" for n, c in enumerate(df.columns) if c.lower() not in taken}
    quoted = {c: f"`{c.replace('`', '``')}`" for c in names}
    inner = df.select(*[F.col(quoted[c]).alias(n) for c, n in names.items()])
    return inner, lambda out: out.select(*[F.col(n).alias(c) for c, n in names.items()], *added)
