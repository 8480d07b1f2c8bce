"""Replaced in one step, bucketed by stay, counted while written."""

from __future__ import annotations

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF0001
from tests.test_plans import plan
from wardline.operators import joins, outcome
from wardline.operators.summary import cohort_summary
from wardline.plans import jobs, offset, timestamped
from wardline.sizes import exact_rows
from wardline.sources import tables
from wardline.sources.adapter import sources
from wardline.sources.bucketed import BucketedStages

c = F.col


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def boom(df):
    """``df`` with a row that fails when it is computed."""
    return df.select(F.when(c("k") < 0, F.raise_error(F.lit("no"))).otherwise(c("k")).cast("long").alias("k"))


def test_a_failed_build_leaves_the_old_table(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="wardline-swap-"), "table")
    first = tables.write_table(spark.range(5).withColumnRenamed("id", "k"), path)
    assert tables.current_path(spark, path) == first and tables.read_stored(spark, path).count() == 5
    with pytest.raises(Exception):
        tables.write_table(boom(spark.range(-3, 9).withColumnRenamed("id", "k")), path)
    assert tables.current_path(spark, path) == first and tables.read_stored(spark, path).count() == 5
    early = tables.read_stored(spark, path)
    second = tables.write_table(spark.range(7).withColumnRenamed("id", "k"), path, cluster_by="k")
    assert second != first and tables.read_stored(spark, path).count() == 7
    assert early.count() == 5                              # a reader that began before
    third = tables.write_table(spark.range(9).withColumnRenamed("id", "k"), path)
    kept = set(tables._versions(spark, path))
    assert os.path.basename(third) in kept and os.path.basename(second) in kept and os.path.basename(first) not in kept
    assert not [n for n in os.listdir(path) if n.startswith(tables.POINTER + "-")]


def test_a_job_leaves_no_intermediate_stages(spark):
    folder = os.path.join(joins.checkpoint_dir(spark).removeprefix("file:"), "wardline-stages")
    outer = joins.materialize(spark.range(3))
    with pytest.raises(ValueError):
        with joins.dropped_stages(spark):
            inner = joins.materialize(spark.range(4))
            assert inner.count() == 4
            held = set(os.listdir(folder))
            raise ValueError
    assert outer.count() == 3 and len(held - set(os.listdir(folder))) == 1
    before = set(os.listdir(folder))
    written = jobs.build(spark, SF0001, tempfile.mkdtemp(prefix="wardline-drop-"))
    assert set(os.listdir(folder)) == before
    assert spark.read.parquet(written["offset_final_cohort"]).count() > 0


def test_a_plain_folder_is_read_as_it_is(spark):
    root = tempfile.mkdtemp(prefix="wardline-plain-")
    spark.range(3).write.parquet(os.path.join(root, "t"))
    assert tables.read_stored(spark, os.path.join(root, "t")).count() == 3


def test_sources_read_a_replaced_table(spark):
    root = tempfile.mkdtemp(prefix="wardline-src-")
    src = sources(spark, SF0001)
    for _ in range(2):
        tables.write_table(src["hospital"], os.path.join(root, "hospital"))
    assert rows(tables.parquet_sources(spark, root)["hospital"]) == rows(src["hospital"])


@pytest.fixture(scope="module")
def built(spark):
    out = tempfile.mkdtemp(prefix="wardline-bucketed-")
    confs = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    written = jobs.build(spark, SF0001, out, database="stage_test")
    for k, v in confs.items():
        spark.conf.set(k, v)
    yield written
    for k in confs:
        spark.conf.unset(k)
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.sql("DROP DATABASE stage_test CASCADE")


def test_final_cohorts_from_bucketed_stages_need_no_exchange(spark, built):
    store = BucketedStages(spark, "stage_test")
    ts, off = jobs.written_stages(store.read)
    src = sources(spark, SF0001)
    for df, plain, name in ((timestamped.cohort(None, base=store.read("timestamped_base"), written=ts), timestamped.cohort(src), "timestamped"),
                            (offset.cohort(None, base=store.read("offset_base"), written=off), offset.cohort(src), "offset")):
        shown = plan(df)
        assert "Exchange" not in shown and "Broadcast" not in shown and shown.count("SortMergeJoin") >= 4, shown
        assert rows(df) == rows(plain.select(df.columns))
        assert rows(spark.read.parquet(built[f"{name}_final_cohort"]).select(df.columns)) == rows(df)


def test_counts_are_taken_while_the_cohorts_are_written(spark, built):
    got = {r.cohort: r for r in spark.read.parquet(built["cohort_summary"]).collect()}
    for name in ("timestamped", "offset"):
        want = cohort_summary(spark.read.parquet(built[f"{name}_final_cohort"]), name).first()
        assert got[name].asDict() == want.asDict()
    steps = {(r.cohort, r.step): r.n for r in spark.read.parquet(built["cohort_attrition"]).collect()}
    base = exact_rows(timestamped.base_cohort(sources(spark, SF0001)))
    assert steps["timestamped", "base"] == base >= steps["timestamped", "eligible"] == got["timestamped"].n_rows
    assert steps["offset", "outcome"] == got["offset"].n_outcome


def test_a_hot_stay_is_split(spark):
    """Rows of a hot key are kept out of the buckets; joins and per-key work see all of them."""
    events = spark.range(0, 9000, 1, 6).select(F.when(c("id") % 3 == 0, 7).otherwise(c("id") % 500).cast("long").alias("k"), (c("id") % 11).alias("v"))
    base = spark.range(0, 400).select(c("id").alias("k"), (c("id") * 2).alias("w"))
    store = BucketedStages(spark, "hot_test", buckets=4, hot_rows=1000)
    confs = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    try:
        store.write("events", events, "k", many=True)
        store.write("base", base, "k")
        for k, v in confs.items():
            spark.conf.set(k, v)
        assert {r.k for r in store.hot("events").collect()} == {7} and store.cold("events").where("k = 7").count() == 0
        joined = store.join("events", "base", "k")
        assert rows(joined) == rows(events.join(base, "k"))
        per_task = [r[0] for r in joined.where("k = 7").groupBy(F.spark_partition_id()).count().select("count").collect()]
        assert len(per_task) > 1 and max(per_task) < 1500
        assert "Exchange hashpartitioning" not in plan(store.cold("events").join(store.cold("base"), "k").groupBy("k").agg(F.max("v")))
        agg = lambda df: df.groupBy("k").agg(F.max("v").alias("m"), F.count(F.lit(1)).alias("n"))
        assert rows(store.per_key("events", agg)) == rows(agg(events)) and rows(store.read("events")) == rows(events)
        store.write("events", events.where("k <> 7"), "k", many=True)          # replaced: no hot key any more
        assert rows(store.read("events")) == rows(events.where("k <> 7"))
        with pytest.raises(Exception):
            store.write("events", boom(events.select((c("k") - 8).alias("k"))), "k")
        assert rows(store.read("events")) == rows(events.where("k <> 7"))
        store.write("base", base.limit(0), "k")
        store.write("base", base, "k")
        assert len(store._versions("base")) == 2
    finally:
        for k in confs:
            spark.conf.unset(k)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.sql("DROP DATABASE hot_test CASCADE")


def test_rules_of_features_need_no_exchange(spark, built):
    """Feature rows bucketed by stay: the rule's two aggregates stay in their buckets."""
    store = BucketedStages(spark, "stage_test")
    agg = store.cold("timestamped_delirium_features").groupBy("stay_id", "charttime").agg(F.max("feat1").alias("f")).groupBy("stay_id").agg(F.max("f"))
    assert "Exchange" not in plan(agg)
    status = outcome.rule_status(store.read("timestamped_base"), store.read("timestamped_delirium_features"))
    assert rows(status) == rows(store.read("timestamped_delirium_status"))
