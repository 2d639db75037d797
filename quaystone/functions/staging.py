"""Keep an operator's input between its passes — only when it is small.

Measuring operators make a few passes over their input (one aggregate scan,
a distinct pass, the quantile selection). When Catalyst's size estimate of
the *projected* input is under ``SMALL_INPUT_BYTES`` the projection is kept
(memory, spilling to disk) for those passes and released afterwards; a large
input is simply scanned again each pass, with pruning and pushdown intact.
The bound is checked, the same way a broadcast side is.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame

SMALL_INPUT_BYTES = 256 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of the optimized plan (None if unavailable)."""
    plan = getattr(df, "_jdf", None)  # a remote session has no plan to ask: treated as large
    return None if plan is None else int(str(plan.queryExecution().optimizedPlan().stats().sizeInBytes()))


@contextmanager
def staged(df: DataFrame, columns: list[str] | None = None, limit: int = SMALL_INPUT_BYTES):
    """``with staged(df, cols) as d:`` — ``d`` is the projection, kept only if small."""
    sel = df.select(*columns) if columns is not None else df
    level = sel.storageLevel
    if level.useMemory or level.useDisk:  # already kept by a caller
        yield sel
        return
    size = estimated_bytes(sel)
    keep = size is not None and size <= limit
    if keep:
        sel = sel.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield sel
    finally:
        if keep:
            sel.unpersist()
