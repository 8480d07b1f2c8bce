"""Helpers shared by the training-data operators: stored stages and hot-key joins."""

from __future__ import annotations

import os
import re
import shutil
import tempfile
import uuid
import weakref
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A key is hot when it holds more than one HOT_SHARE-th of all rows, so there
# are at most HOT_SHARE hot keys at any input size: a proven broadcast bound.
HOT_SHARE = 1000

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Word separators of every operator: space, tab, LF, VT, FF, CR.  Python's
# ``bytes.split()`` splits on the same six.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; a local one only on ``local`` masters."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") \
        or spark.conf.get("spark.checkpoint.dir", None) \
        or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        found = tempfile.mkdtemp(prefix="wardline-llm-")
        spark.sparkContext.setCheckpointDir(found)
    return found


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application.

    Called before an operator makes its first Python function.
    """
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        _shipped.add(sc.applicationId)
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        folder = tempfile.mkdtemp(prefix="wardline-py-")
        sc.addPyFile(shutil.make_archive(os.path.join(folder, "wardline"), "zip", root, "wardline"))


def fresh(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return os.path.join(shared_dir(spark), "wardline-llm", f"{name}-{uuid.uuid4().hex[:12]}")


# Settings of the session while a stage is written: its shuffle files go when it
# is, instead of when the driver happens to collect its garbage, and Python gets
# whole texts in batches of some thousand, which both sides hold in memory.
STAGE_CONF = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
              "spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}


@contextmanager
def _set(spark: SparkSession, confs: dict[str, str]):
    before = {k: spark.conf.get(k, None) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


_paths: "weakref.WeakKeyDictionary[DataFrame, str]" = weakref.WeakKeyDictionary()


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts the lineage: later steps read the files, whatever executors are lost.
    """
    spark = df.sparkSession
    path = fresh(spark, name)
    with _set(spark, STAGE_CONF):
        df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _paths[out] = path
    return out


def drop(*stages: DataFrame) -> None:
    """Remove the files of stages (results of ``stage``) that nothing reads any more."""
    for df in stages:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(_paths.pop(df))
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def ascii_lower(col):
    """Lower-case A-Z only; other letters keep their case."""
    return F.translate(col, ASCII_UPPER, ASCII_UPPER.lower())


def hot_join(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """Inner join of ``rows`` to ``groups`` (unique ``key``; ``size`` = its rows in ``rows``).

    Groups with more than ``total / HOT_SHARE`` rows (at most ``HOT_SHARE`` of
    them, as sizes sum to ``total``) are broadcast, so rows of a hot key stay
    where they are; all others take an ordinary join.  Rows with a null key
    match nothing, as in any equality join.
    """
    hot = groups.where(F.col(size) > F.lit(max(total // HOT_SHARE, 1)))
    cold = groups.where(F.col(size) <= F.lit(max(total // HOT_SHARE, 1)))
    return (rows.join(F.broadcast(hot), key)
            .unionByName(rows.join(F.broadcast(hot.select(key)), key, "left_anti")
                         .join(cold, key)))


def by_group(df: DataFrame, keys: list[str], fn, schema: str) -> DataFrame:
    """``fn(pandas frame of one group) -> pandas frame`` for every group of ``keys``.

    Like ``applyInPandas``, for many small groups: one Python call per Arrow
    batch of rows instead of one per group.  A task holds one group at a time.
    """
    import pandas as pd

    def run(batches):
        held = None
        for pdf in batches:
            if held is not None:
                pdf = pd.concat([held, pdf], ignore_index=True)
            if not len(pdf):
                continue
            new = (pdf[keys] != pdf[keys].shift()).any(axis=1).to_numpy()
            new[0] = True
            starts = [*new.nonzero()[0].tolist(), len(pdf)]
            for a, b in zip(starts[:-2], starts[1:-1]):
                yield fn(pdf.iloc[a:b])
            held = pdf.iloc[starts[-2]:]
        if held is not None and len(held):
            yield fn(held)

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(run, schema)
