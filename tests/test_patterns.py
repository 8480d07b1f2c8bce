"""Pattern tables: LIKE semantics, rare grams, hot grams, classification and flags."""

from __future__ import annotations

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.test_plans import plan
from wardline.functions import dictionaries as dic
from wardline.operators import eligibility as elig
from wardline.operators import exposure as expo
from wardline.operators import joins, patterns

c = F.col


def liked(texts, terms):
    """Every matching pair, by DuckDB's own LIKE join."""
    con = duckdb.connect()
    con.execute("CREATE TABLE t (t VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?)", [(t,) for t in texts])
    con.execute("CREATE TABLE p AS SELECT unnest(?) AS p", [list(terms)])
    return set(con.execute(r"SELECT DISTINCT t, p FROM t, p WHERE t LIKE '%' || p || '%' ESCAPE '\'").fetchall())


def matched(spark, texts, terms):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k long, t string")
    table = spark.createDataFrame([(p,) for p in terms], "match_term string")
    rows = patterns.match_rows(df.withColumn("t2", c("t")), c("t"), table, carry=("t2",), keep=())
    pairs = patterns.match_texts(df.where("t is not null").select(c("t").alias("_text")).distinct(),
                                 table.where("match_term is not null").select(c("match_term").alias("_pattern")).distinct())
    found = [(r[0], r[1]) for r in pairs.collect()]
    assert len(found) == len(set(found))
    assert {r[0] for r in rows.collect()} == {t for t, _ in found}
    return set(found)


ODD_TEXTS = ["", "a", "ab", "abc", "100% pure", "a_b", "ab\ncd", "x\\y", "Ünïcode 漢字 \U0001f600", "aspirin 81 mg", "tail%", "é", None]
ODD_TERMS = ["", "%", "_", "__", "a", "b%", "a%c", "0\\%", "a\\_b", "_b", "b_c", "\\\\", "x\\\\y", "漢_", "字%\U0001f600", "\\a", "tail\\",
             "aspirin%mg", "mg%aspirin", "nope", "é", "___________________", None, "n%l\\%", ""]


@pytest.mark.parametrize("rows", [joins.BROADCAST_MAX_ROWS, 0])
def test_like_semantics(spark, monkeypatch, rows):
    monkeypatch.setattr(joins, "BROADCAST_MAX_ROWS", rows)
    monkeypatch.setattr(joins, "HOT_KEY_ROWS", 3)
    want = liked([t for t in ODD_TEXTS if t is not None], {p for p in ODD_TERMS if p is not None and not p.endswith("\\") and p != "\\a"})
    # DuckDB refuses a closing backslash, and one before an ordinary character.
    want |= {("tail%", "tail\\")} | {(t, "\\\\") for t in ["x\\y"]} | {(t, "\\a") for t in ODD_TEXTS if t and "a" in t}
    assert matched(spark, ODD_TEXTS, ODD_TERMS) == want


def test_a_hundred_thousand_patterns(spark):
    r = random.Random(3)
    syllables = [a + b for a in "bcdfglmnprstvz" for b in "aeiou"]
    word = lambda: "".join(r.choice(syllables) for _ in range(r.randint(2, 4)))
    words = [word() for _ in range(3000)]
    texts = {" ".join(r.choice(words) for _ in range(r.randint(1, 6))) for _ in range(150)}
    terms = set()
    while len(terms) < 100_000:
        w = r.choice(words) if r.random() < 0.1 else word() + r.choice(syllables)
        kind = r.random()
        at = r.randrange(len(w))
        terms.add(w if kind < 0.7 else w[:at] + "_" + w[at + 1:] if kind < 0.85 else w[:at] + "%" + r.choice(words) if kind < 0.95 else w[:3] + "%" + w[-2:])
    assert matched(spark, texts, terms) == liked(texts, terms)


def test_patterns_are_keyed_by_their_rarest_gram(spark):
    texts = spark.createDataFrame([(f"tablet number {i}",) for i in range(50)] + [("tablet zq1",)], "_text string")
    table = spark.createDataFrame([("tablet%zq1",), ("tablet",), ("tablet 9x9",)], "_pattern string")
    keyed = {r[0]: r[1] for r in patterns.rarest_grams(texts, table).collect()}
    assert set(keyed) == {"tablet%zq1", "tablet"}          # no text holds "9x9"
    assert keyed["tablet%zq1"] == "zq1"


def test_a_gram_of_all_texts_is_no_hot_task(spark, monkeypatch):
    """Texts of a gram that all of them hold stay in their partitions."""
    monkeypatch.setattr(joins, "BROADCAST_MAX_ROWS", 0)
    monkeypatch.setattr(joins, "HOT_KEY_ROWS", 100)
    texts = spark.range(0, 4000, 1, 8).select(F.concat(F.lit("mg "), c("id").cast("string")).alias("_text"))
    table = spark.createDataFrame([("mg",), ("mg _99",)], "_pattern string")
    pairs = patterns.match_texts(texts, table)
    assert pairs.where("_pattern = 'mg'").count() == 4000
    per_task = [r[0] for r in pairs.where("_pattern = 'mg'").groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert max(per_task) < 2000
    assert "Python" not in plan(pairs) and "CartesianProduct" not in plan(pairs) and "NestedLoop" not in plan(pairs)


def test_classification_by_table_equals_the_expressions(spark):
    from wardline.sources.adapter import sources
    rx = sources(spark, "/root/testdata/sf0.001")["prescriptions"].select("hadm_id", "drug")
    rx = rx.unionByName(spark.createDataFrame([(1, "Crestor or ZOCOR"), (2, None), (3, "")], "hadm_id long, drug string"))
    terms = [(i, g, k, t) for i, (g, k, ts) in enumerate(dic.STATIN_TERMS_PRIORITY) for t in ts]
    table = spark.createDataFrame(terms, "priority int, generic_name string, statin_type string, match_term string")
    a = expo.classify_drugs(rx)
    b = patterns.classify_rows(rx, "drug", table)
    assert a.columns == b.columns
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_flags_by_table_equal_the_expressions(spark):
    from wardline.sources.adapter import sources
    dx = sources(spark, "/root/testdata/sf0.001")["diagnosis"]
    key = "patientunitstayid"
    rows = ([("sepsis", True, t) for t in dic.SEPSIS_DIAGNOSIS_TERMS] + [("sepsis", False, t) for t in dic.SEPSIS_EXCLUDE_PHRASES]
            + [("neuro", True, t.replace(".*", "%")) for t in dic.NEURO_ADMISSION_TERMS])
    table = spark.createDataFrame(rows, "flag string, include boolean, pattern string")
    found = {tuple(r) for r in patterns.flag_rows(dx, key, elig.low_text("diagnosisstring"), table).collect()}
    from wardline.functions.match import matches_any
    want = elig.rollup_flags(dx, key, {"sepsis": elig.sepsis_phrase(elig.low_text("diagnosisstring")),
                                       "neuro": matches_any(elig.low_text("diagnosisstring"), dic.NEURO_ADMISSION_TERMS)})
    assert found == {(r[key], n) for r in want.collect() for n in ("sepsis", "neuro") if r[n]}
    assert found


def test_empty_sides(spark):
    none = spark.createDataFrame([], "k long, t string")
    some = spark.createDataFrame([(1, "abc")], "k long, t string")
    table = spark.createDataFrame([("b",)], "match_term string")
    empty = spark.createDataFrame([], "match_term string")
    for df, terms in ((none, table), (some, empty), (none, empty)):
        assert patterns.match_rows(df, c("t"), terms, carry=("k",)).count() == 0
