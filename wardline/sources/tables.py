"""Reading the driver's parquet tables and writing stage tables."""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table as a lazy parquet scan (pushdown and pruning apply)."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


# The file in a table's folder that names its current version.
POINTER = "_CURRENT"


def _fs(spark: SparkSession, path: str):
    """A Hadoop path and its file system, so a path means what it means to the readers."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def _versions(spark: SparkSession, path: str) -> dict[str, int]:
    """The version folders of a table, and their numbers."""
    folder, fs = _fs(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    return {n: int(n[1:9]) for n in names if re.fullmatch(r"v[0-9]{8}-[0-9a-f]{8}", n)}


def _whole(spark: SparkSession, folder: str) -> bool:
    done, fs = _fs(spark, f"{folder}/_SUCCESS")
    return fs.exists(done)


def _point(spark: SparkSession, path: str, version: str) -> None:
    """Write the pointer beside the old one and rename it over that in one step."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    fresh, fs = _fs(spark, f"{path}/{POINTER}-{version}")
    out = fs.create(fresh, True)
    try:
        out.write(bytearray(version.encode()))
    finally:
        out.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    fresh = fs.makeQualified(fresh)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fresh.toUri(), conf)
    context.rename(fresh, fs.makeQualified(_fs(spark, f"{path}/{POINTER}")[0]), options)


def current_path(spark: SparkSession, path: str) -> str:
    """The folder that holds the table's current rows: its current version, or the folder itself."""
    pointer, fs = _fs(spark, f"{path}/{POINTER}")
    if not fs.exists(pointer):
        return path
    stream = fs.open(pointer)
    try:
        return f"{path}/{spark._jvm.org.apache.commons.io.IOUtils.toString(stream, 'UTF-8')}"
    finally:
        stream.close()


def read_stored(spark: SparkSession, path: str) -> DataFrame:
    """A table written by :func:`write_table`.

    The version is chosen here: a reader keeps it while newer ones are written.
    """
    return spark.read.parquet(current_path(spark, path))


def write_table(df: DataFrame, path: str, partition_by: str | None = None,
                cluster_by: str | list[str] | None = None, keep: int = 2) -> str:
    """Drop-and-replace sink for a stage or final table (parquet); returns the folder written.

    Rows go to a new numbered version below ``path``; when all are there, a
    pointer is renamed over the old one.  Readers see the old table or the
    new one, whole, at any time, and a build that fails leaves the old one as it is.  The
    ``keep`` newest whole versions stay for readers that began before; what is
    older, left by failed builds included, goes with a later success.

    ``cluster_by`` (the stay key) lays rows out by ranges of it, sorted, so that
    look-ups by key skip files and row groups by their statistics; a second
    column splits the rows of a hot stay over several ranges.

    ``partition_by`` is meant for low-cardinality outcome columns, so that
    downstream filters on them prune files the way an index would.
    """
    spark = df.sparkSession
    if cluster_by:
        columns = [cluster_by] if isinstance(cluster_by, str) else cluster_by
        df = df.repartitionByRange(*columns).sortWithinPartitions(*columns)
    number = max(_versions(spark, path).values(), default=0) + 1
    version = f"v{number:08d}-{uuid.uuid4().hex[:8]}"
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(f"{path}/{version}")
    _point(spark, path, version)
    found = _versions(spark, path)
    whole = sorted(n for name, n in found.items() if _whole(spark, f"{path}/{name}"))
    for name, n in found.items():
        if n < whole[-keep:][0]:
            old, fs = _fs(spark, f"{path}/{name}")
            fs.delete(old, True)
    return f"{path}/{version}"


class TableSources(dict):
    """Lazy ``name -> DataFrame`` map over stored clinical tables.

    ``read(name)`` gives the raw table; each one is checked against (or,
    with ``conform``, cast to) its declared schema on first use.
    """

    def __init__(self, read, conform: bool = False):
        super().__init__()
        self._read, self._conform = read, conform

    def __missing__(self, name: str) -> DataFrame:
        from wardline.sources import schemas
        declared = schemas.SOURCES[name]
        df = self._read(name)
        if self._conform:
            df = schemas.conform(df, declared, name)
        df = schemas.check_schema(df, declared, name)
        self[name] = df
        return df


def _stored(spark: SparkSession, root: str, name: str, suffix: str) -> str:
    """``{root}/{name}`` or, where only that exists, ``{root}/{name}{suffix}``.

    Asked through Hadoop's file system, so a path means what it means to the
    readers: without a scheme, the default file system.
    """
    plain, fs = _fs(spark, f"{root.rstrip('/')}/{name}")
    return current_path(spark, str(plain.toString())) if fs.exists(plain) else f"{root.rstrip('/')}/{name}{suffix}"


def parquet_sources(spark: SparkSession, root: str, conform: bool = False) -> TableSources:
    """Clinical tables as parquet datasets ``{root}/{name}`` (a folder) or ``{root}/{name}.parquet``."""
    return TableSources(lambda name: spark.read.parquet(_stored(spark, root, name, ".parquet")), conform)


def catalog_sources(spark: SparkSession, database: str, conform: bool = False) -> TableSources:
    """Clinical tables registered in the session catalog as ``{database}.{name}``."""
    return TableSources(lambda name: spark.table(f"{database}.{name}"), conform)


def csv_sources(spark: SparkSession, root: str, suffix: str = ".csv.gz") -> TableSources:
    """Clinical tables as CSV files with a header row: ``{root}/{name}{suffix}`` or a folder.

    Values are read as text and cast to the declared types (``conform``), so
    no schema is inferred.  Fields may be quoted and then hold commas, line
    breaks and doubled quotes.  A CSV file is read by one task: at scale, write
    the tables to parquet once and use :func:`parquet_sources`.
    """
    def read(name: str) -> DataFrame:
        return (spark.read.option("header", True).option("multiLine", True)
                .option("quote", '"').option("escape", '"').csv(_stored(spark, root, name, suffix)))
    return TableSources(read, conform=True)
