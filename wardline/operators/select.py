"""Who is in: first stay per entity, first stay by counter, onset roll-up."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_entity(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row per ``keys`` under ``order`` (ties broken by later order keys).

    Written as ``row_number() == 1``: Catalyst turns it into a partial
    WindowGroupLimit before the shuffle, so each task forwards at most one
    row per key and a patient with very many stays cannot overload the
    window task.  Rank over *all* rows: filter afterwards, not before.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("_rank", F.row_number().over(w))
              .where(F.col("_rank") == 1)
              .drop("_rank"))


def first_by_counter(df: DataFrame, counter: str, first: int = 1) -> DataFrame:
    """Rows whose visit counter equals ``first`` (a filter, pushed to the scan)."""
    return df.where(F.col(counter) == first)


def onset_rollup(df: DataFrame, key: str, mins: Mapping[str, str],
                 maxs: Mapping[str, str] = {}) -> DataFrame:
    """Per ``key``: ``min`` of each ``mins`` column and ``max`` of each ``maxs`` column.

    Mappings go from source column to output name.  Algebraic aggregates, so
    the map side pre-aggregates and a hot key shuffles one row per task.
    """
    aggs = [F.min(src).alias(dst) for src, dst in mins.items()]
    aggs += [F.max(src).alias(dst) for src, dst in maxs.items()]
    return df.groupBy(key).agg(*aggs)
