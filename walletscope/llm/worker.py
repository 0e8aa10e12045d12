"""What a Python worker keeps between tasks, and how much of a batch it takes in hand at a time."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Hashable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_KEPT: dict[Hashable, Any] = {}


def kept(key: Hashable, make: Callable[[], Any]) -> Any:
    """The object of this key, made once per worker; another key's object goes first, so one stays at most."""
    if key not in _KEPT:
        if _KEPT:
            _KEPT.clear()
            give_back()
        _KEPT[key] = make()
    return _KEPT[key]


def give_back() -> None:
    """Return freed memory to the system: the worker lives on, and others need it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def slices(sizes: np.ndarray, most: int) -> Iterator[slice]:
    """Runs of rows of about ``most`` in sum, one row at least."""
    ends = np.cumsum(sizes)
    first = 0
    while first < len(ends):
        done = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, done + most, "right")))
        yield slice(first, last)
        first = last


def text_slices(texts: pa.Array, most: int) -> Iterator[tuple[slice, list[str]]]:
    """Runs of a batch's texts of about ``most`` bytes as strings, NULL as the empty one."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    for part in slices(sizes, most):
        yield part, [t or "" for t in texts[part].to_pylist()]
    pa.default_memory_pool().release_unused()
