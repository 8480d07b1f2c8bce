"""Differential test: every registered query against its DuckDB oracle at sf0.01.

Same comparison as the driver: row count, column names, order-insensitive
value hash.  Also the smoke contract of ``entry``.
"""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.compare import compare, duck
from tests.conftest import SF001
from wardline.plans import oracle, registry

QUERIES = registry.QUERIES          # the study's own; others have their own tests
ORACLE = oracle.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert len(QUERIES) == 32
    assert QUERIES.items() <= entry.queries().items()
    assert ORACLE.items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_matches_oracle(spark, con, key):
    res = compare(QUERIES[key](spark, SF001), con, ORACLE[key])
    assert res["ok"], res


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and len(df.columns) == 32
    assert df.schema == entry.entry(spark).schema


@pytest.mark.parametrize("key", ["cohort_timestamped", "cohort_offset", "first_day_min_score",
                                 "first_visit_base"])
def test_results_do_not_depend_on_ansi_or_time_zone(spark, con, key):
    from wardline.sources import adapter
    spark.conf.set("spark.sql.ansi.enabled", "false")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")   # has DST jumps
    adapter._CACHE.pop(spark, None)                  # analyse fresh plans under these confs
    try:
        res = compare(QUERIES[key](spark, SF001), con, ORACLE[key])
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        adapter._CACHE.pop(spark, None)
    assert res["ok"], res
