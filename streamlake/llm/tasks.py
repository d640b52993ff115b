"""What Python tasks share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa

Batches = Iterator[pa.RecordBatch]


def released(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``run`` for ``mapInArrow``; the memory that Arrow keeps for later goes back to the system when
    a task ends, as the worker lives on beside the tasks of other stages."""

    @wraps(run)
    def whole(batches: Batches) -> Batches:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()

    return whole
