"""What a Python worker keeps from task to task.

Spark hands the same few worker processes to all stages of an application. What a module keeps there for one operator, such as
the ids of words met, would stay beside the memory of all later ones, which can't know of it.
"""

from __future__ import annotations

import gc
from collections.abc import Callable
from functools import lru_cache

import pyarrow as pa

_kept: list = []


def kept(make: Callable) -> Callable:
    """``make``, whose last two results stay at hand until :func:`released`."""
    cached = lru_cache(maxsize=2)(make)
    _kept.append(cached)
    return cached


def released() -> None:
    """Give up what other operators keep in this process: for a task that begins and keeps words of its own."""
    if any(cached.cache_info().currsize for cached in _kept):
        for cached in _kept:
            cached.cache_clear()
        gc.collect()  # an encoder and its memories refer to each other
    pa.default_memory_pool().release_unused()
