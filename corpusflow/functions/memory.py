"""Memory of Python workers. Spark uses a worker for one task after the other, so what a task leaves there
is held through all that follow, beside the JVM of the same executor."""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa

_tables: list = []


def give_back() -> None:
    """Hand free pages to the system, which Arrow's pool and the C library otherwise keep for later."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def kept(make: Callable) -> Callable:
    """``make``, whose last two results a worker keeps from task to task until :func:`other_work` is called."""
    cached = functools.lru_cache(maxsize=2)(make)
    _tables.append(cached)
    return cached


def other_work() -> None:
    """Drop what was kept: tasks that begin now need none of it. If it is needed again, it is made anew."""
    if any(t.cache_info().currsize for t in _tables):
        for t in _tables:
            t.cache_clear()
        gc.unfreeze()  # tables may be frozen and refer to each other
        gc.collect()
        give_back()


def tidy(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``work``, for ``mapInArrow``, begun without the tables of other work, and its free memory given back at the end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        other_work()
        yield from work(batches)
        give_back()

    return run
