"""Join and materialisation helpers shared by the operators.

Event tables (charting, drugs, diagnoses) are the large, possibly skewed
inputs; a stay may own a third of all rows.  They are joined to *key tables*
(one row per stay or admission, a few narrow columns projected from a
stage).  ``keyed_join`` broadcasts a key table only after counting it and
measuring its bytes, so the event side is never shuffled for the join and a
hot stay costs nothing extra.

Beyond the bound, hot keys are found by an exact count and joined on their own
(:func:`split_hot_join`): their key rows are few and are broadcast, so event
rows of a hot key, identical or not, stay in the partitions they are in; all
others take a shuffle join.  Rows with a null key match nothing and are not
shuffled.  Every path returns the same rows as a plain join.

Row counts and payload sizes are remembered per DataFrame object
(:mod:`wardline.sizes`).
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.sizes import (exact_rows, has_at_most, has_var_width,  # noqa: F401
                            note_rows, payload_bytes, setting)

# Largest key table broadcast to every task: a long id and at most two
# timestamps a row.
BROADCAST_MAX_ROWS = 2_000_000
# Byte budget of a broadcast side as a hash relation (see sizes.payload_bytes).
BROADCAST_MAX_BYTES = 128 * 1024 * 1024




def key_table(stage: DataFrame, *cols, max_rows: int | None = None,
              bound_from: DataFrame | None = None) -> tuple[DataFrame, bool]:
    """Projection of ``stage`` for joins, broadcast-hinted when proven bounded.

    Proven means: at most ``max_rows`` rows (counted on ``bound_from``, a
    DataFrame known to have at least as many rows, else on the stage) and at
    most ``BROADCAST_MAX_BYTES`` of payload.  With ``bound_from`` the payload
    is bounded by that source's bytes plus the projection's extra fixed-width
    columns (the source is stable, so it is measured once).
    """
    keys = stage.select(*cols) if cols else stage
    spark = stage.sparkSession
    if max_rows is None:
        max_rows = setting(spark, "broadcastMaxRows", BROADCAST_MAX_ROWS)
    bounded = bound_from if bound_from is not None else stage
    small = bool(max_rows) and has_at_most(bounded, max_rows)
    if small:
        rows = exact_rows(bounded)                   # exact once the bound holds
        if bound_from is not None:
            extra = [c for c in keys.columns if c not in bound_from.columns]
            size = payload_bytes(bound_from, rows) + 8 * len(extra) * rows
        elif all(isinstance(c, str) and c in stage.columns for c in cols):
            # A projection of named columns carries at most the stage's bytes;
            # measuring the (stable) stage keeps the measurement memoised.
            narrow = payload_bytes(keys, rows) if not has_var_width(keys) else None
            size = narrow if narrow is not None else payload_bytes(stage, rows)
        else:
            size = payload_bytes(keys, rows)
        small = size <= setting(spark, "broadcastMaxBytes", BROADCAST_MAX_BYTES)
    return (F.broadcast(keys) if small else keys), small


def keyed_join(events: DataFrame, stage: DataFrame, cols, on: str | list[str],
               how: str = "inner", max_rows: int | None = None,
               bound_from: DataFrame | None = None, hot_rows: int | None = None) -> DataFrame:
    """Join a large (event) side to columns ``cols`` of ``stage`` on key names ``on``.

    The stage side is broadcast when it has at most ``max_rows`` rows and
    ``BROADCAST_MAX_BYTES`` of payload; otherwise :func:`split_hot_join` joins
    by shuffle with hot keys apart.  The rows are the same either way.
    ``how`` must keep the stage on the build side (inner, left, left_semi or
    left_anti).
    """
    if how not in ("inner", "left", "left_outer", "left_semi", "left_anti"):
        raise ValueError(f"keyed_join cannot build the key side of a {how} join")
    keys, small = key_table(stage, *(cols or ()), max_rows=max_rows, bound_from=bound_from)
    if small:
        return events.join(keys, on, how)
    return split_hot_join(events, keys, on, how, hot_rows=hot_rows)


# A key with more event rows than this is joined apart (about one task's worth
# of rows).  At most HOT_KEYS_MAX keys are: beyond, the hottest ones.
HOT_KEY_ROWS = 5_000_000
HOT_KEYS_MAX = 1_000_000


def filterable(keys: DataFrame, column: str) -> DataFrame:
    """``keys`` behind a range condition that all its rows meet.

    Spark puts a Bloom filter of a join's small side on the scan of the other
    only when the small side is filtered; key tables are read from a stored
    stage that shows no filter any more.  The least key as a literal is a filter
    Spark takes for one.  Whether the filter is made is then up to
    ``spark.sql.optimizer.runtime.bloomFilter.*`` (see README).
    """
    least = keys.agg(F.min(column)).first()[0]
    return keys if least is None else keys.where(F.col(column) >= F.lit(least))


def _hot_keys(events: DataFrame, keys: DataFrame, on: list[str], hot_rows: int):
    """The hot keys and their rows of ``keys``, both of broadcast size; None when no key is hot.

    When they are too many or too large, the limit is doubled until the hottest fit.
    """
    counts = events.select(*on).groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    hot = materialize(counts.where(F.col("_n") > hot_rows))
    budget = setting(events.sparkSession, "broadcastMaxBytes", BROADCAST_MAX_BYTES)
    while exact_rows(hot):
        names = hot.select(*on)
        if exact_rows(hot) <= HOT_KEYS_MAX and payload_bytes(hot, exact_rows(hot)) <= budget:
            side = materialize(keys.join(F.broadcast(names), on, "left_semi"))
            if payload_bytes(side, exact_rows(side)) <= budget:
                return names, side
        hot_rows *= 2
        hot = materialize(hot.where(F.col("_n") > hot_rows))
    return None


def split_hot_join(events: DataFrame, keys: DataFrame, on: str | list[str], how: str = "inner",
                   *, hot_rows: int | None = None) -> DataFrame:
    """Shuffle join that leaves event rows of hot and null keys where they are.

    1. Event rows are counted per key (only the key columns are read, with
       partial aggregation); keys above ``hot_rows`` are hot.
    2. Rows of hot keys meet the broadcast key rows of just these keys.
    3. Rows of other keys take an ordinary join.
    4. Rows with a null key match nothing: left and anti joins keep them.
    """
    on = [on] if isinstance(on, str) else list(on)
    how = "left" if how == "left_outer" else how
    hot_rows = hot_rows or setting(events.sparkSession, "hotKeyRows", HOT_KEY_ROWS)
    unknown = F.lit(False)
    for k in on:
        unknown = unknown | F.col(k).isNull()
    known = events.where(~unknown)
    hot = _hot_keys(known, keys, on, hot_rows)
    # The last key of several is the most selective one.
    keys = filterable(keys, on[-1]) if how in ("inner", "left_semi") else keys
    if hot is None:
        out = known.join(keys, on, how)
    else:
        names, side = F.broadcast(hot[0]), F.broadcast(hot[1])
        out = (known.join(names, on, "left_anti").join(keys, on, how)
               .unionByName(known.join(names, on, "left_semi").join(side, on, how)))
    if how in ("left", "left_anti"):
        nothing = [] if how == "left_anti" else [
            F.lit(None).cast(f.dataType).alias(f.name) for f in keys.schema.fields if f.name not in on]
        out = out.unionByName(events.where(unknown).select("*", *nothing))
    return out


def restrict(events: DataFrame, stage: DataFrame, on: str,
             max_rows: int | None = None) -> DataFrame:
    """Keep only events whose key occurs in ``stage``, whatever its size."""
    return keyed_join(events, stage, [on], on, "left_semi", max_rows=max_rows)


def narrowed(events: DataFrame, stage: DataFrame, on: str) -> DataFrame:
    """Events for a roll-up by ``on`` that is then joined to ``stage``: only those of its keys where that is free.

    Up to the broadcast bound no event moves, and the roll-up gets fewer.  Beyond it,
    a join before the roll-up shuffles raw events and counts their keys, to drop groups
    that the join after it drops anyway: partial sums move instead.
    """
    keys, small = key_table(stage, on)
    return events.join(keys, on, "left_semi") if small else events


def checkpoint_dir(spark) -> str | None:
    """The session's reliable checkpoint folder, if one is configured."""
    try:
        found = spark.sparkContext.getCheckpointDir()
    except Exception:                      # sessions without a SparkContext handle
        found = None
    return found or spark.conf.get("spark.checkpoint.dir", None)


def materialize(df: DataFrame) -> DataFrame:
    """Materialise a stage that several later stages read (the base cohort).

    With a checkpoint folder (``spark.checkpoint.dir``: shared storage on a
    cluster) the stage is computed once, written there as Parquet and read
    back (a checkpoint would compute it twice); its rows are counted from the files.
    Lineage is cut, a lost executor costs no recomputation, and nothing stays
    cached.  Without a folder the stage is only counted, and computed again by
    each reader.
    """
    spark = df.sparkSession
    folder = checkpoint_dir(spark)
    out = df
    if folder:
        path = f"{folder.rstrip('/')}/wardline-stages/{uuid.uuid4().hex}"
        df.write.parquet(path)
        _STAGED.append(path)
        out = spark.read.schema(df.schema).parquet(path)
    return note_rows(out, out.count())


# Folders of stages written by this process, oldest first.
_STAGED: list[str] = []


@contextmanager
def dropped_stages(spark):
    """Remove the stages that are written inside the block when it ends, however it ends.

    For jobs that have delivered their tables by then; a DataFrame built in the
    block reads its stages whenever it runs.
    """
    before = len(_STAGED)
    try:
        yield
    finally:
        for path in _STAGED[before:]:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
        del _STAGED[before:]
