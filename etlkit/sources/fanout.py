"""One computed frame, several destinations."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import DataFrame

from etlkit.operators.reuse import persisted, staged

Writer = Callable[[DataFrame], Any]


def fan_out(df: DataFrame, writers: Mapping[str, Writer], reuse: str = "cache") -> dict[str, Any]:
    """Run several writers over one computation of ``df`` and return their results by name.

    ``reuse="cache"`` keeps the frame on the executors, spilling to their disks;
    ``"table"`` writes it once to the shared folder, for frames larger than the
    cluster's storage or too costly to recompute when an executor is lost;
    ``"none"`` recomputes, which is best for a plain scan.
    """
    if reuse not in ("cache", "table", "none"):
        raise ValueError(f"unknown reuse {reuse!r}")
    if reuse == "cache":
        with persisted(df) as kept:
            return {name: write(kept) for name, write in writers.items()}
    source = staged(df, "fanout") if reuse == "table" else df
    return {name: write(source) for name, write in writers.items()}
