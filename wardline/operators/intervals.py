"""Joins of event histories with per-key time windows.

A window meets only the days it spans: beyond the broadcast bound, events and
windows are keyed by (key, day), so a stay with a long history is spread over
as many join keys as it has days and only the days of its window find a
partner.  Events outside the span of all windows are dropped at the scan
(their bounds are literals, so files and row groups are skipped by their
statistics), and Spark's runtime filter on the (key, day) hash drops the rest
before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.functions.windows import in_window
from wardline.operators.joins import key_table, materialize, split_hot_join

c = F.col


def _bucket(day: Column, width: int) -> Column:
    """The first day, counted from 1970, of the bucket that holds ``day``."""
    n = F.date_diff(day, F.lit("1970-01-01").cast("date"))
    return n if width == 1 else n - F.pmod(n, F.lit(width))


def window_buckets(windows: DataFrame, *, key: str, start: str, end: str | None, length: str, width: int = 1) -> DataFrame:
    """``windows`` once per bucket of ``width`` days that it spans, with ``_day`` and ``_slot``; empty windows have none."""
    stop = c(start) + F.expr(f"INTERVAL {length}")
    stop = F.least(c(end), stop) if end else stop
    first, last = (_bucket(F.to_date(t), width) for t in (c(start), stop - F.expr("INTERVAL 1 MICROSECOND")))
    return (windows.where(stop > c(start)).withColumn("_day", F.explode(F.sequence(first, last, F.lit(width))))
            .withColumn("_slot", F.xxhash64(key, "_day")))


def window_join(events: DataFrame, base: DataFrame, *, key: str, time: str, start: str, end: str | None, length: str,
                max_rows: int | None = None, width: int = 1) -> DataFrame:
    """Events in the half-open window ``[start, least(end, start + length))`` of their key, with its bounds.

    ``width`` is the days of a bucket, for windows of many days.  Up to the
    broadcast bound the key table is broadcast and no event moves.
    """
    bounds = [start, *([end] if end else [])]
    inside = in_window(c(time), c(start), c(end) if end else None, length)
    keys, small = key_table(base, key, *bounds, max_rows=max_rows)
    if small:
        return events.join(keys, key).where(inside)
    days = materialize(window_buckets(base.select(key, *bounds), key=key, start=start, end=end, length=length, width=width))
    span = base.agg(F.min(start), F.max(c(start) + F.expr(f"INTERVAL {length}"))).first()
    kept = events.where((c(time) >= F.lit(span[0]).cast("timestamp_ntz")) & (c(time) < F.lit(span[1]).cast("timestamp_ntz"))
                        if span[0] is not None else F.lit(False))
    placed = kept.withColumn("_day", _bucket(F.to_date(c(time)), width)).withColumn("_slot", F.xxhash64(key, "_day"))
    return split_hot_join(placed, days, [key, "_day", "_slot"]).where(inside).drop("_day", "_slot")
