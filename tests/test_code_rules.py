"""Code rules as a table: string ranges, prefixes, versions and titles."""

from __future__ import annotations

import random

import pytest

from tests.test_plans import plan
from wardline.operators import code_rules, eligibility as elig, joins
from wardline.plans import timestamped as ts
from wardline.sources.adapter import sources


def satisfied(codes, rules):
    return {(code, version, rule) for code, version in codes for rule, v, low, high, n in rules
            if code is not None and low is not None and high is not None and (v is None or v == version)
            and low.encode() <= code[:n].encode() <= high.encode()}


def found(spark, codes, rules):
    rows = code_rules.matched_codes(spark.createDataFrame(codes, "code string, version int"),
                                    spark.createDataFrame(rules, code_rules.RULE_SCHEMA)).collect()
    assert len(rows) == len(set(rows))
    return {tuple(r) for r in rows}


@pytest.mark.parametrize("rows", [joins.BROADCAST_MAX_ROWS, 0])
def test_odd_ranges(spark, monkeypatch, rows):
    monkeypatch.setattr(joins, "BROADCAST_MAX_ROWS", rows)
    codes = [(code, v) for v in (9, 10, None) for code in
             ("", "I", "I6", "I63", "I65", "I659", "I69", "I699", "I7", "430", "4300", "438", "4389", "439", "4", "32", "320", "é", "éa", "z", None)]
    rules = [("same", 10, "I63", "I63", 3), ("range", 10, "I65", "I69", 3), ("wide", 9, "320", "438", 3), ("whole", None, "I", "I659", None),
             ("short", 10, "I6", "I69", 3), ("nested", None, "I6", "I65", 5), ("all", 9, "", "\U0010ffff", 4), ("none", 9, "5", "4", 1),
             ("null", 9, None, "5", 1), ("longer", 10, "I650", "I66", 2), ("accent", None, "e", "é", 1), ("empty", 10, "", "", 3)]
    assert found(spark, codes, rules) == satisfied(codes, rules)


def test_fifty_thousand_rules(spark):
    r = random.Random(11)
    code = lambda: r.choice("ABGIS0123456789") + "".join(r.choice("0123456789") for _ in range(r.randint(1, 4)))
    codes = list({(code(), r.choice((9, 10))) for _ in range(400)})
    rules = []
    for i in range(50_000):
        low, version = code(), r.choice((9, 10, 10, None) if i % 50 == 0 else (9, 10))
        if r.random() < 0.5:
            rules.append((f"r{i}", version, low, low, len(low)))
        else:
            high = low[:-1] + chr(min(ord("9"), ord(low[-1]) + r.randint(0, 9))) if r.random() < 0.8 else max(low, code())
            rules.append((f"r{i}", version, low, high, r.choice((len(low), 3, None))))
    want = set()
    for version in (9, 10):                                # by version: 400 x 50,000 tests are slow in Python otherwise
        own = [x for x in rules if x[1] in (None, version)]
        for c, v in codes:
            if v == version:
                want |= {(c, v, n) for n, _, low, high, size in own if low <= c[:size] <= high}
    assert found(spark, codes, rules) == want


def test_study_rules_as_a_table_equal_the_expressions(spark):
    src = sources(spark, "/root/testdata/sf0.001")
    dx, words = src["diagnoses_icd"], src["d_icd_diagnoses"]
    hits = code_rules.rule_hits(dx, code_rules.rules_frame(spark, ts.RULES), dictionary=words,
                                titles=code_rules.titles_frame(spark, ts.RULES))
    flags = elig.code_flags(elig.describe_codes(dx, words), ts.RULES)
    want = {(r["hadm_id"], rule.name) for r in flags.collect() for rule in ts.RULES if r[rule.name]}
    assert {tuple(r) for r in hits.collect()} == want and want
    shown = plan(hits)
    assert "CartesianProduct" not in shown and "NestedLoop" not in shown and "Python" not in shown


def test_a_hot_code_stays_in_its_partitions(spark, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_MAX_ROWS", 0)
    monkeypatch.setattr(joins, "HOT_KEY_ROWS", 100)
    from pyspark.sql import functions as F
    dx = spark.range(0, 9000, 1, 8).select(F.col("id").alias("hadm_id"), F.when(F.col("id") % 3 > 0, "I63.9").otherwise(
        F.concat(F.lit("I"), (F.col("id") % 99).cast("string"))).alias("icd_code"), F.lit(10).alias("icd_version"))
    rules = spark.createDataFrame([("r", 10, "I60", "I69", 3)], code_rules.RULE_SCHEMA)
    hits = code_rules.rule_hits(dx, rules)
    assert hits.count() == dx.where("substring(replace(icd_code, '.', ''), 1, 3) between 'I60' and 'I69'").count()
