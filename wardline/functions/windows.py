"""Time-window predicates (timestamps or minute offsets) and flag helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def in_window(t: Column, start: Column, end: Column | None, length: str) -> Column:
    """Half-open window ``start <= t < least(end, start + length)``.

    ``least`` skips a NULL ``end``, so a missing end falls back to the fixed
    length; ``length`` is an interval literal such as ``'24 HOURS'``.
    """
    stop = start + F.expr(f"INTERVAL {length}")
    if end is not None:
        stop = F.least(end, stop)
    return (t >= start) & (t < stop)


def in_offset_window(t: Column, lo: int, hi: int) -> Column:
    """Closed integer window ``lo <= t <= hi`` (minute offsets from admission)."""
    return t.between(lo, hi)


def in_interval_flag(t: Column, start: Column, end: Column) -> Column:
    """1 when ``start <= t <= end``; 0 otherwise, including any NULL bound (smallint)."""
    return F.when(t.between(start, end), 1).otherwise(0).cast("smallint")


def flag(cond: Column, dtype: str = "int") -> Column:
    """``CASE WHEN cond THEN 1 ELSE 0 END`` (NULL condition -> 0)."""
    return F.when(cond, 1).otherwise(0).cast(dtype)


def any_flag(*flags: Column, dtype: str = "smallint") -> Column:
    """1 when any component flag is 1, treating NULL as 0."""
    cond = None
    for f in flags:
        one = F.coalesce(f, F.lit(0)) == 1
        cond = one if cond is None else (cond | one)
    return F.when(cond, 1).otherwise(0).cast(dtype)


def any_of(*cols: Column) -> Column:
    """``greatest`` that also accepts a single column."""
    return cols[0] if len(cols) == 1 else F.greatest(*cols)
