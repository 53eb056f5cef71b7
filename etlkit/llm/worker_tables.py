"""Tables that a Python worker keeps from task to task, those of one operator at a time.

Spark gives a worker to task after task, of other operators as well. A table that is asked for
replaces the one of another owner, so a worker never holds the words, pieces and scores of all
operators that it has served.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable
from typing import Any

import pyarrow as pa

# Only the C library of Linux has it.
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
_kept: dict[str, Any] = {}


def worker_table(owner: str, make: Callable[[], Any]) -> Any:
    """The table of ``owner``, made when another one's, or none, is held."""
    if owner not in _kept:
        forget_tables()
        _kept[owner] = make()
    return _kept[owner]


def forget_tables() -> None:
    """Give the table back, for steps that need none."""
    _kept.clear()
    give_back()


def give_back() -> None:
    """Return freed memory to the system, which a worker would keep while it waits for its next task."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)
