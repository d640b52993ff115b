"""Which days changed: small notes that one stage of the lake leaves for the next.

A note is written after its change is visible. The next stage publishes what follows from
it and then deletes the notes it has read, so a stage that fails does the same days again,
and nothing is done twice or never. The number of notes is that of the runs in between.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import SparkSession

from streamlake import storage


class Pending(NamedTuple):
    """The notes of a stage: their names, and the days; None where all may have changed."""

    names: tuple[str, ...]
    days: tuple[str, ...] | None


def note(spark: SparkSession, folder: str, days: Iterable[object] | None) -> None:
    """Leave a note that days (ISO dates, or None for rows without one) have changed."""
    listed = None if days is None else sorted({str(d) for d in days})
    if listed != []:
        storage.write_text(spark, f"{folder}/{uuid.uuid4().hex}.json", json.dumps({"days": listed}))


def pending(spark: SparkSession, folder: str) -> Pending:
    names = tuple(n for n in storage.child_names(spark, folder) if n.endswith(".json"))
    found = [json.loads(storage.read_text(spark, f"{folder}/{n}"))["days"] for n in names]
    return Pending(names, None if None in found else tuple(sorted({d for days in found for d in days})))


def done(spark: SparkSession, folder: str, notes: Pending) -> None:
    for name in notes.names:
        storage.delete_dir(spark, f"{folder}/{name}")
