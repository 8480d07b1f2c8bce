"""Plan tests: the physical plans are the ones we want at scale."""

from __future__ import annotations

import os
import tempfile

import pytest

from tests.conftest import SF0001, ts
from wardline.operators import outcome
from wardline.operators.joins import has_at_most, keyed_join, note_rows
from wardline.sources.adapter import sources
import __spark_entry__ as entry


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", ["cohort_timestamped", "cohort_offset", "term_match_join",
                                 "eligibility_multi_source"])
def test_no_cartesian_no_python(spark, key):
    p = plan(entry.queries()[key](spark, SF0001))
    for bad in ("CartesianProduct", "BatchEvalPython", "ArrowEvalPython", "PythonUDF"):
        assert bad not in p, f"{bad} in {key}"


def test_first_stay_uses_partial_window_limit(spark):
    p = plan(entry.queries()["first_stay_per_patient"](spark, SF0001))
    assert "WindowGroupLimit" in p


def test_theta_match_needs_no_join(spark):
    for key in ("term_match_join", "undated_exposure", "cohort_offset"):
        assert "lambda" not in plan(entry.queries()[key](spark, SF0001))
    p = plan(entry.queries()["term_match_join"](spark, SF0001))
    for join in ("NestedLoopJoin", "HashJoin", "SortMergeJoin", "CartesianProduct"):
        assert join not in p


def test_offset_cohort_reads_charting_once(spark):
    p = plan(entry.queries()["cohort_offset"](spark, SF0001))
    assert p.count("lineitem.parquet") == 4        # diagnosis, history, charting, drugs


def test_filters_and_pruning_reach_the_scan(spark, make):
    path = os.path.join(tempfile.mkdtemp(prefix="wardline-plan-"), "chartevents")
    (make("chartevents", [(1, ts(1), 228337, 1.0, "x")])
     .selectExpr("*", "'unused' AS warning_text").write.parquet(path))
    ce = spark.read.parquet(path)
    base = spark.createDataFrame([(1, ts(1), None)],
                                 "stay_id long, icu_intime timestamp_ntz, icu_outtime timestamp_ntz")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        p = plan(outcome.feature_rows(base, ce))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    scan = [line for line in p.splitlines() if "FileScan parquet" in line][0]
    pushed = scan.split("PushedFilters:")[1].split("ReadSchema")[0]
    assert "IsNotNull(valuenum)" in pushed and "In(itemid" in pushed
    assert "warning_text" not in scan.split("ReadSchema")[1]


def test_key_table_broadcast_only_when_bounded(spark, make):
    events = make("gcs", [(1, ts(1), 14), (2, ts(1), 9)])
    keys = spark.createDataFrame([(1, ts(1), None)],
                                 "stay_id long, icu_intime timestamp_ntz, icu_outtime timestamp_ntz")
    small = plan(keyed_join(events, keys, ["stay_id"], "stay_id"))
    assert "BroadcastHashJoin" in small
    big = keyed_join(events, keys, ["stay_id"], "stay_id", max_rows=0)
    big_plan = big._jdf.queryExecution().sparkPlan().toString()   # before AQE re-planning
    assert "BroadcastHashJoin" not in big_plan and "SortMergeJoin" in big_plan
    assert big.count() == 1
    with pytest.raises(ValueError):
        keyed_join(events, keys, ["stay_id"], "stay_id", how="right")


def test_row_bounds_are_counted_once(spark):
    df = note_rows(spark.range(5), 5)
    assert has_at_most(df, 5) and not has_at_most(df, 4)
    fresh = spark.range(10)
    assert not has_at_most(fresh, 3)
    assert has_at_most(fresh, 10)          # a lower bound does not decide a larger limit


def test_adapter_sources_are_shared_per_session(spark):
    a, b = sources(spark, SF0001), sources(spark, SF0001)
    assert a is b and a["icustays"] is b["icustays"]


FALLBACK_KEYS = ["cohort_timestamped", "cohort_offset", "first_day_min_score", "drug_events",
                 "cam_feature_rows", "describe_codes", "first_visit_base", "anchored_age"]


@pytest.mark.parametrize("key", FALLBACK_KEYS)
def test_unbounded_path_with_hot_keys_matches_oracle(spark, monkeypatch, key):
    """No broadcast at all and every key with > 2 rows salted: same results."""
    from tests.compare import compare, duck
    from tests.conftest import SF001
    from wardline.operators import joins
    monkeypatch.setattr(joins, "BROADCAST_MAX_ROWS", 0)
    monkeypatch.setattr(joins, "HOT_KEY_ROWS", 2)
    df = entry.queries()[key](spark, SF001)
    res = compare(df, duck(SF001), entry.oracle_sql()[key])
    assert res["ok"], res


def _copies(spark, n):
    """``n`` equal rows of key 1 and one row of key 2."""
    from pyspark.sql import functions as F
    return spark.range(0, n + 1, 1, 6).select(F.when(F.col("id") < n, 1).otherwise(2).cast("long").alias("k"),
                                              F.lit(7).alias("v"))


@pytest.mark.parametrize("limits", [{}, {"max_rows": 0}, {"max_rows": 0, "hot_rows": 3}])
def test_joins_keep_every_copy_at_every_size(spark, limits):
    keys = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k long, tag string")
    assert keyed_join(_copies(spark, 20), keys, None, "k", **limits).count() == 21


@pytest.mark.parametrize("max_rows", [None, 0])
def test_restrict_always_restricts(spark, max_rows):
    from wardline.operators.joins import restrict
    keys = spark.createDataFrame([(1,), (3,)], "k long")
    assert restrict(_copies(spark, 20), keys, "k", max_rows=max_rows).count() == 20


def test_more_hot_keys_than_fit_are_still_split(spark, monkeypatch):
    from pyspark.sql import functions as F
    from wardline.operators import joins
    events = spark.range(0, 600).select(F.when(F.col("id") < 400, 0).otherwise(F.col("id") % 5).cast("long").alias("k"))
    keys = spark.range(0, 5).select(F.col("id").alias("k"), F.lit("x").alias("tag"))
    monkeypatch.setattr(joins, "HOT_KEYS_MAX", 1)
    hot, side = joins._hot_keys(events, keys, ["k"], 10)
    assert [r.k for r in hot.collect()] == [0] and side.count() == 1
    assert joins.split_hot_join(events, keys, "k", hot_rows=10).count() == 600


def test_null_keys_and_copies_stay_spread(spark):
    """A third of null keys and 30,000 equal rows are held by many partitions."""
    from pyspark.sql import functions as F
    from wardline.operators.joins import split_hot_join
    keys = spark.range(0, 100).select(F.col("id").alias("k"), F.lit("x").alias("tag"))
    nulls = spark.range(0, 3000, 1, 6).select(F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id")).cast("long").alias("k"))
    held = lambda df, cond: [r["count"] for r in df.where(cond).groupBy(F.spark_partition_id()).count().collect()]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = held(split_hot_join(nulls, keys, "k", "left", hot_rows=100), "k is null")
        assert sum(out) == 1000 and len(out) == 6
        out = held(split_hot_join(_copies(spark, 30_000), keys, "k", hot_rows=1000), "k = 1")
        assert sum(out) == 30_000 and len(out) == 6
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_payload_counts_bytes_and_overhead(spark):
    from wardline.sizes import payload_bytes
    df = spark.createDataFrame([("é" * 100,)], "t string")
    assert payload_bytes(df, 1) >= 2 * 200


def test_job_writes_stages_and_partitioned_finals(spark):
    from wardline.plans import jobs
    out = tempfile.mkdtemp(prefix="wardline-job-")
    written = jobs.build(spark, SF0001, out, with_stages=True)
    assert len(written) == 14 + 2 + 2
    final = spark.read.parquet(written["timestamped_final_cohort"])
    assert final.count() == entry.entry(spark).count() > 0
    assert any(d.startswith("sae_within_24h=") for d in os.listdir(written["offset_final_cohort"]))
    s = {r.cohort: r for r in spark.read.parquet(written["cohort_summary"]).collect()}
    assert s["timestamped"].n_rows == final.count()


def test_stored_tables_give_the_same_cohorts(spark):
    """Adapter tables written to parquet and read back as stored sources."""
    from pyspark.sql import functions as F
    from wardline.plans import offset as off, timestamped as tsp
    from wardline.sources.schemas import SOURCES
    from wardline.sources.tables import parquet_sources
    root = tempfile.mkdtemp(prefix="wardline-src-")
    src = sources(spark, SF0001)
    for name in SOURCES:
        df = src[name]
        if name == "icustays":                  # stored with other physical types
            df = df.withColumn("intime", F.col("intime").cast("timestamp")) \
                   .withColumn("stay_id", F.col("stay_id").cast("int"))
        df.write.parquet(os.path.join(root, name))
    stored = parquet_sources(spark, root, conform=True)
    assert stored["icustays"].schema == SOURCES["icustays"]
    for build in (tsp.cohort, off.cohort):
        a, b = build(src), build(stored)
        assert a.count() == b.count() > 0 and a.exceptAll(b).count() == 0
    with pytest.raises(Exception):
        parquet_sources(spark, root)["icustays"]          # unconformed types are rejected


def test_hot_key_is_spread_over_partitions(spark):
    """A key holding a third of all rows lands in many shuffle partitions."""
    from pyspark.sql import functions as F
    from wardline.operators.joins import split_hot_join
    n = 30000
    events = spark.range(0, n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).cast("long").alias("k"),
        F.col("id").alias("v"))
    keys = spark.range(0, n).select(F.col("id").alias("k"), F.lit("x").alias("tag"))
    conf = {"spark.sql.adaptive.enabled": "false",              # keep the raw partitioning
            "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        def hot_rows_per_partition(df):
            return [r["count"] for r in
                    df.where("k = 0").groupBy(F.spark_partition_id()).count().collect()]
        plain = hot_rows_per_partition(events.join(keys, "k"))
        salted_df = split_hot_join(events, keys, "k", "inner", hot_rows=500)
        salted = hot_rows_per_partition(salted_df)
        total = salted_df.count()
    finally:
        for k in conf:
            spark.conf.unset(k)
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert plain == [n // 3]                                    # unsalted: one task holds it
    assert total == n and sum(salted) == n // 3
    assert len(salted) >= 8 and max(salted) <= n // 9           # salted: spread out


def test_broadcast_needs_a_byte_bound_too(spark, monkeypatch):
    from wardline.operators import joins
    wide = spark.createDataFrame([(i, "t" * 1000) for i in range(50)], "k long, title string")
    narrow = spark.createDataFrame([(i,) for i in range(50)], "k long")
    events = spark.range(0, 100).withColumnRenamed("id", "k")
    monkeypatch.setattr(joins, "BROADCAST_MAX_BYTES", 10_000)
    _, wide_small = joins.key_table(wide, "k", "title")
    _, narrow_small = joins.key_table(narrow, "k")
    assert narrow_small and not wide_small
    assert keyed_join(events, wide, None, "k", "inner").count() == 50


def test_materialize_leaves_nothing_cached(spark, monkeypatch):
    from pyspark.sql import functions as F
    from wardline.operators import joins
    df = spark.range(0, 100).select((F.col("id") % 7).alias("k"))
    cached = lambda: set(spark._jsc.getPersistentRDDs().keySet().toArray())
    before = cached()
    with monkeypatch.context() as m:
        m.setattr(joins, "checkpoint_dir", lambda s: None)
        out = joins.materialize(df)
        assert not out.is_cached and has_at_most(out, 100) and not has_at_most(out, 99)
        entry.queries()["base_cohort_ts"](spark, SF0001).count()
        assert cached() <= before
    ck = joins.materialize(df)
    assert not ck.is_cached and "Range" not in plan(ck)                # lineage is cut
    assert ck.inputFiles() and all("wardline-stages" in f for f in ck.inputFiles())


def test_catalog_sources_read_registered_tables(spark):
    from wardline.plans import offset as off
    from wardline.sources.tables import catalog_sources
    src = sources(spark, SF0001)
    for name in ("patient", "hospital", "diagnosis", "pasthistory", "nursecharting",
                 "admissiondrug"):
        src[name].createOrReplaceGlobalTempView(name)
    stored = catalog_sources(spark, "global_temp")
    a, b = off.cohort(src), off.cohort(stored)
    assert a.count() == b.count() > 0 and a.exceptAll(b).count() == 0


def test_csv_sources_round_trip(spark):
    from wardline.plans import offset as off, timestamped as tsp
    from wardline.sources.schemas import SOURCES
    from wardline.sources.tables import csv_sources
    root = tempfile.mkdtemp(prefix="wardline-csv-")
    src = sources(spark, SF0001)
    for name in SOURCES:
        src[name].write.option("header", True).csv(os.path.join(root, name))
    stored = csv_sources(spark, root)
    assert stored["nursecharting"].schema == SOURCES["nursecharting"]
    for build in (tsp.cohort, off.cohort):
        a, b = build(src), build(stored)
        assert a.count() == b.count() > 0 and a.exceptAll(b).count() == 0


def test_limits_can_be_set_per_session(spark):
    events = spark.range(0, 10).withColumnRenamed("id", "k")
    keys = spark.range(0, 10).withColumnRenamed("id", "k")
    assert "BroadcastHashJoin" in plan(keyed_join(events, keys, None, "k"))
    spark.conf.set("spark.wardline.broadcastMaxRows", "5")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")     # isolate our decision
    try:
        j = keyed_join(events, spark.range(0, 10).withColumnRenamed("id", "k"), None, "k")
        assert "BroadcastHashJoin" not in j._jdf.queryExecution().sparkPlan().toString()
        assert j.count() == 10
    finally:
        spark.conf.unset("spark.wardline.broadcastMaxRows")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


PLAN_SHAPES = {   # key -> (bounded: max exchanges, keys), (unbounded: max exchanges, keys)
    # Unbounded, the two window joins are keyed by (stay, day): their roll-ups by stay take an
    # exchange of partial aggregates each, and so do the windows by day.  The base is a stored
    # stage, which has no partitioning: three joins exchange its narrow key tables.
    "cohort_timestamped": ((6, {"stay_id"}),
                           (25, {"hadm_id", "stay_id", "icd_code", "l_orderkey", "o_orderkey"})),
    # Unbounded, every child is restricted to the base by a join of its own.
    "cohort_offset": ((5, {"patientunitstayid"}), (9, {"patientunitstayid"})),
}


@pytest.mark.parametrize("key", sorted(PLAN_SHAPES))
def test_plan_shape_does_not_regress(spark, monkeypatch, key):
    """Exchange count and shuffle keys of the final cohorts, bounded and unbounded."""
    from wardline.operators import joins
    from wardline.plans.explain import summary
    (b_max, b_keys), (u_max, u_keys) = PLAN_SHAPES[key]
    s = summary(plan(entry.queries()[key](spark, SF0001)))
    assert s["exchanges"] <= b_max and set(s["shuffle_keys"]) <= b_keys, s
    monkeypatch.setattr(joins, "BROADCAST_MAX_ROWS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        s = summary(plan(entry.queries()[key](spark, SF0001)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert s["exchanges"] <= u_max and set(s["shuffle_keys"]) <= u_keys, s
    assert s["broadcast_hash_joins"] == 0


def test_rollups_beyond_the_bound_count_no_event_keys(spark, monkeypatch):
    """Children that are rolled up by stay meet a large base once, as roll-ups; rows as with a bounded one."""
    from wardline.operators import joins
    from wardline.plans import offset as off, timestamped as tsp
    src = sources(spark, SF0001)
    b, ob = tsp.base_cohort(src), off.base_cohort(src)

    def built():
        return [off.cohort(src, base=ob), off.sepsis_stage(src, ob), off.eligibility_stage(src, ob), off.exposure_stage(src, ob),
                tsp.eligibility_stage(src, b), tsp.eligibility_hit_stays(src, b).distinct()]

    want = built()
    monkeypatch.setattr(joins, "BROADCAST_MAX_ROWS", 0)
    counted, real = [], joins._hot_keys
    monkeypatch.setattr(joins, "_hot_keys", lambda events, keys, on, n: (counted.append(on), real(events, keys, on, n))[1])
    got = built()
    assert [on for on in counted if on[0] != "icd_code"] == []          # the code dictionary is still a key table
    for x, y in zip(got, want):
        assert x.count() == y.count() > 0 and x.exceptAll(y).count() == 0
