"""Window joins keyed by (key, day), and Spark's runtime filter on the event scan."""

from __future__ import annotations

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF0001
from tests.test_plans import plan
from wardline.functions.windows import in_window
from wardline.operators import intervals, joins, outcome
from wardline.plans import offset, timestamped
from wardline.sources.adapter import sources

c = F.col
ORIGIN = dt.datetime(2020, 1, 1)


def at(hours, micro=0):
    return ORIGIN + dt.timedelta(hours=hours, microseconds=micro)


@pytest.fixture
def unbounded(spark, monkeypatch):
    """No side is small, and a runtime filter is made whatever the sizes."""
    monkeypatch.setattr(joins, "BROADCAST_MAX_ROWS", 0)
    confs = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
             "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
             "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1g"}
    for k, v in confs.items():
        spark.conf.set(k, v)
    yield
    for k in confs:
        spark.conf.unset(k)
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def shuffled(df) -> list[int]:
    """Rows written by each exchange of an executed plan."""
    df.collect()
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "Exchange":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("width", [1, 3])
@pytest.mark.parametrize("length", ["24 HOURS", "100 HOURS", "30 MINUTES"])
def test_same_rows_as_a_plain_join(spark, unbounded, width, length):
    events = spark.createDataFrame([(k, at(h, m), h) for k in (1, 2, 3, None) for h in range(0, 200, 3) for m in (0, 1)]
                                   + [(1, None, 0), (1, dt.datetime(1969, 12, 31, 23), 1), (4, at(0), 2)], "k long, t timestamp_ntz, v int")
    base = spark.createDataFrame([(1, at(23), None), (1, at(23), None), (2, at(3), at(5)), (2, at(48), at(48)), (3, at(47, 1), at(500)),
                                  (None, at(0), None), (4, dt.datetime(1969, 12, 31, 1), None), (5, None, at(3)), (6, at(9), at(2))],
                                 "k long, a timestamp_ntz, b timestamp_ntz")
    want = events.join(base, "k").where(in_window(c("t"), c("a"), c("b"), length))
    got = intervals.window_join(events, base, key="k", time="t", start="a", end="b", length=length, width=width)
    assert got.columns == want.columns and rows(got) == rows(want)
    small = intervals.window_join(events, base, key="k", time="t", start="a", end="b", length=length, max_rows=100)
    assert rows(small) == rows(want)
    assert intervals.window_join(events, base.limit(0), key="k", time="t", start="a", end="b", length=length).count() == 0


def test_a_long_history_joins_its_first_day_only(spark, unbounded):
    """One stay holds a third of all events over eight years: its other days never reach the shuffle."""
    root = tempfile.mkdtemp(prefix="wardline-history-")
    hour = lambda col: F.lit(ORIGIN).cast("timestamp_ntz") + F.make_dt_interval(hours=col.cast("int"))
    long = spark.range(0, 72_000).select(F.lit(0).cast("long").alias("stay_id"), hour(c("id")).alias("charttime"), F.lit(9).alias("gcs"))
    others = spark.range(0, 144_000).select((1 + c("id") % 600).alias("stay_id"), hour(c("id") % 72_000).alias("charttime"), F.lit(9).alias("gcs"))
    long.unionByName(others).write.parquet(os.path.join(root, "gcs"))
    events = spark.read.parquet(os.path.join(root, "gcs"))
    base = joins.materialize(spark.range(0, 300).select(c("id").alias("stay_id"), hour(c("id") * 240).alias("icu_intime"),
                                                        F.lit(None).cast("timestamp_ntz").alias("icu_outtime")))
    joined = intervals.window_join(events, base, key="stay_id", time="charttime", start="icu_intime", end="icu_outtime", length="24 HOURS")
    shown = plan(joined)
    assert "might_contain" in shown and "PushedFilters" in shown and "GreaterThanOrEqual(charttime" in shown
    moved = shuffled(joined)
    hits = joined.count()
    assert joined.where("stay_id = 0").count() == 24
    # Hits, their neighbours on the same days, windows by day, and the filter's few false positives.
    assert hits < 3000 and sum(moved) < 3 * hits + 2000, (moved, hits)
    least = outcome.window_min_rollup(base, events)
    assert least.count() == joined.select("stay_id").distinct().count()


def test_runtime_filter_is_on_the_event_scan(spark, unbounded, tmp_path):
    events = spark.range(0, 5000).select((c("id") % 500).alias("stay_id"), c("id").alias("v"))
    events.write.parquet(str(tmp_path / "events"))
    events = spark.read.parquet(str(tmp_path / "events"))
    base = joins.materialize(spark.range(100, 110).withColumnRenamed("id", "stay_id"))
    kept = joins.restrict(events, base, "stay_id")
    assert "might_contain" in plan(kept)
    assert kept.count() == 100
    assert max(shuffled(kept)) < 500
    empty = joins.restrict(events, joins.materialize(base.limit(0)), "stay_id")
    assert empty.count() == 0


def test_cohorts_are_the_same_beyond_the_bound(spark, unbounded):
    src = sources(spark, SF0001)
    a, b = timestamped.cohort(src), offset.cohort(src)
    shown = plan(a)
    joins.BROADCAST_MAX_ROWS = 2_000_000                # monkeypatch restores it
    want_a, want_b = timestamped.cohort(src), offset.cohort(src)
    assert rows(a) == rows(want_a) and rows(b) == rows(want_b)
    assert "_slot" in shown and "might_contain" in plan(b)
