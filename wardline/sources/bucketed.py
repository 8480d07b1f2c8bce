"""Stage tables bucketed and sorted by the stay key, in the session's catalog.

The study keys every stage table by its stay and joins nine of them; here all
stages of a model have the same buckets of the same key, so those joins, and
aggregates by the key, need no exchange.

A stage with many rows of a key (features, drug events) keeps the rows of hot keys
in a second table that is not bucketed: as buckets they would be one task.
:meth:`BucketedStages.per_key` computes by key over both and
:meth:`BucketedStages.join` joins both.

A table is replaced in one step: rows are written to a numbered version and
the view that readers name is replaced when they are there.  The version before stays
for readers that began with it.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.operators.joins import HOT_KEY_ROWS, key_table, materialize
from wardline.sizes import exact_rows, setting

BUCKETS = 200


class BucketedStages:
    """Stage tables of a catalog database, all bucketed alike."""

    def __init__(self, spark: SparkSession, database: str, buckets: int = BUCKETS, hot_rows: int | None = None, keep: int = 2):
        self.spark, self.database, self.buckets, self.keep = spark, database, buckets, keep
        self.hot_rows = hot_rows or setting(spark, "hotKeyRows", HOT_KEY_ROWS)
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")

    def _versions(self, name: str) -> dict[str, int]:
        known = [r.tableName for r in self.spark.sql(f"SHOW TABLES IN `{self.database}`").collect()]
        return {t: int(m[1]) for t in known if (m := re.fullmatch(rf"{re.escape(name.lower())}_v([0-9]{{8}})_[0-9a-f]{{8}}", t))}

    def _replace(self, name: str, df: DataFrame, key: str | None) -> None:
        """A new version of a table (bucketed by ``key``), then the view over it, then old versions go."""
        number = max(self._versions(name).values(), default=0) + 1
        table = f"`{self.database}`.`{name.lower()}_v{number:08d}_{uuid.uuid4().hex[:8]}`"
        writer = df.write.format("parquet").mode("errorifexists")
        if key:
            # The shuffle hashes as buckets do: one file a bucket.
            writer = df.repartition(self.buckets, key).write.format("parquet").mode("errorifexists").bucketBy(self.buckets, key).sortBy(key)
        writer.saveAsTable(table)
        self.spark.sql(f"CREATE OR REPLACE VIEW `{self.database}`.`{name}` AS SELECT * FROM {table}")
        for old, n in self._versions(name).items():
            if n <= number - self.keep:
                self.spark.sql(f"DROP TABLE IF EXISTS `{self.database}`.`{old}`")

    def write(self, name: str, df: DataFrame, key: str, many: bool = False) -> None:
        """Replace stage ``name``.  ``many``: a key can have any number of rows."""
        if not many:
            return self._replace(name, df, key)
        df = materialize(df)
        counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
        hot = materialize(counts.where(F.col("_n") > self.hot_rows).select(key))
        if exact_rows(hot):
            names, _ = key_table(hot, key)
            self._replace(f"{name}_hot", df.join(names, key, "left_semi"), None)
            self._replace(name, df.join(names, key, "left_anti"), key)
        else:
            self._replace(f"{name}_hot", df.limit(0), None)
            self._replace(name, df, key)
        return None

    def cold(self, name: str) -> DataFrame:
        """The bucketed rows of a stage."""
        return self.spark.table(f"`{self.database}`.`{name}`")

    def hot(self, name: str) -> DataFrame | None:
        """The rows of hot keys, kept apart; None for a stage of one row a key."""
        found = f"`{self.database}`.`{name}_hot`"
        return self.spark.table(found) if self.spark.catalog.tableExists(found) else None

    def read(self, name: str) -> DataFrame:
        """All rows of a stage."""
        hot = self.hot(name)
        return self.cold(name) if hot is None else self.cold(name).unionByName(hot)

    def join(self, name: str, other: str, key: str) -> DataFrame:
        """Inner join of stage ``name`` to ``other``, a stage of one row a key: no exchange, hot keys by broadcast."""
        side, hot = self.cold(other), self.hot(name)
        out = self.cold(name).join(side, key)
        if hot is None:
            return out
        # Distinct hot keys: fewer than the table has rows by a factor of ``hot_rows``.
        keys = materialize(hot.select(key).distinct())
        few, _ = key_table(materialize(side.join(keys, key, "left_semi")))
        return out.unionByName(hot.join(few, key))

    def per_key(self, name: str, fn: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """``fn`` over a stage, for an ``fn`` that treats each key by itself.

        Bucketed rows need no exchange for it; hot keys take ``fn``'s own, after its partial aggregation.
        """
        hot = self.hot(name)
        return fn(self.cold(name)) if hot is None else fn(self.cold(name)).unionByName(fn(hot))
