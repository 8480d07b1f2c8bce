"""What is known about the size of a DataFrame, remembered per object.

Broadcast decisions need a row count and, for variable-width columns, the
measured payload.  Both are taken by ordinary aggregates (a task returns one
row) and remembered per DataFrame object, so a stage is counted once however
many operators join to it.  Limits can be set per session through
``spark.wardline.<key>`` confs.
"""

from __future__ import annotations

import weakref

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def setting(spark, key: str, default: int) -> int:
    """A size limit from the session conf ``spark.wardline.<key>``, else ``default``.

    Keys: ``broadcastMaxRows``, ``broadcastMaxBytes``, ``hotKeyRows``.
    """
    try:
        value = spark.conf.get(f"spark.wardline.{key}", None)
    except Exception:
        value = None
    return int(value) if value not in (None, "") else default


_ROWS: "weakref.WeakKeyDictionary[DataFrame, int]" = weakref.WeakKeyDictionary()

# A hash relation holds per row: 8 bytes a field, the bytes of strings, a
# header and a slot; the relation doubles its table as it grows.
ROW_OVERHEAD = 32
TABLE_FACTOR = 2


def note_rows(df: DataFrame, rows: int) -> DataFrame:
    """Record the exact row count of ``df`` (known from a count or by construction)."""
    _ROWS[df] = rows
    return df


def exact_rows(df: DataFrame) -> int:
    """The row count of ``df``, counted once per DataFrame object."""
    if df not in _ROWS:
        _ROWS[df] = df.count()
    return _ROWS[df]


def has_at_most(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows."""
    return exact_rows(df) <= max_rows


_BYTES: "weakref.WeakKeyDictionary[DataFrame, int]" = weakref.WeakKeyDictionary()


def has_var_width(df: DataFrame) -> bool:
    return any(isinstance(f.dataType, (T.StringType, T.BinaryType)) for f in df.schema.fields)


def payload_bytes(df: DataFrame, rows: int) -> int:
    """Bytes of ``df`` as a broadcast hash relation (``rows`` = its row count).

    Every field costs 8 bytes and every row ``ROW_OVERHEAD``; string and binary
    columns add their bytes, summed by one aggregate; the whole counts
    ``TABLE_FACTOR`` times.  Remembered per DataFrame object.
    """
    var = [f.name for f in df.schema.fields
           if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    fixed = (8 * len(df.schema.fields) + ROW_OVERHEAD) * rows
    if var and df not in _BYTES:
        total = df.select(sum(F.coalesce(F.octet_length(F.col(v)).cast("long"), F.lit(0))
                              for v in var).alias("b")).agg(F.sum("b")).first()[0]
        _BYTES[df] = int(total or 0)
    return TABLE_FACTOR * (fixed + (_BYTES[df] if var else 0))
