"""The Spark adapter equals the FIXTURES adapter SQL run by DuckDB, table by table."""

from __future__ import annotations

import pytest

from tests.compare import compare, duck
from tests.conftest import SF001
from wardline.plans.oracle import ADAPTER
from wardline.sources.adapter import BUILDERS, sources
from wardline.sources.schemas import SOURCES


def test_adapter_covers_every_source():
    assert set(BUILDERS) == set(ADAPTER) == set(SOURCES)


@pytest.mark.parametrize("name", sorted(SOURCES))
def test_adapter_table_matches_sql(spark, name):
    df = sources(spark, SF001)[name]
    assert df.schema == SOURCES[name] or [f.dataType for f in df.schema] == \
        [f.dataType for f in SOURCES[name]]
    res = compare(df, duck(SF001), f"SELECT * FROM ({ADAPTER[name]})")
    assert res["ok"], res
