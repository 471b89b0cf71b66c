"""What a Python worker keeps from task to task.

Spark uses a worker again for tasks of other stages.  What one operator keeps there
for its own tasks would take memory from the next one, so an operator claims the
worker, and what others kept is dropped.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa

_caches: dict[str, Callable[[], None]] = {}
_owner: list[str] = []


def cache(name: str, clear: Callable[[], None]) -> None:
    """Name a cache and how it is emptied."""
    _caches[name] = clear


def claim(name: str) -> None:
    """From now on the worker is ``name``'s: empty all other caches and give freed
    memory back to the system."""
    if _owner == [name]:
        return
    _owner[:] = [name]
    for other, clear in _caches.items():
        if other != name:
            clear()
    gc.collect()
    give_back()


def give_back() -> None:
    """Give freed memory back to the system; a worker that waits for its next task
    would hold it.  For after the large arrays of a task."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def giving_back(function: Callable) -> Callable:
    """``function`` for mapInArrow; what its task held goes back to the system after
    its last batch.  The worker may wait through stages without Python beside a JVM
    that needs the memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = None
        for batch in function(batches):
            kind = batch.schema
            yield batch
        batch = None
        if kind is not None:
            yield pa.RecordBatch.from_pylist([], kind)  # Spark lets go of the last batch
        give_back()

    return run
