from __future__ import annotations

import random
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest

from tests.llm.conftest import SF0001
from wardline.llm import queries, whiten


def matrices():
    r = np.random.default_rng(0)
    d = 48
    q, _ = np.linalg.qr(r.normal(size=(d, d)))
    yield "apart", q, r.uniform(1, 100, d)
    yield "multiple", q, np.repeat([5.0, 3.0, 1.0, 0.0], d // 4)
    yield "clustered", q, np.r_[np.ones(d // 2) + 1e-9 * np.arange(d // 2), np.linspace(2, 3, d - d // 2)]
    yield "graded", q, 10.0 ** np.linspace(-12, 3, d)
    yield "equal", q, np.ones(d)
    yield "one large", q, np.r_[1e6, 1 + 1e-14 * np.arange(d - 1)]
    yield "no variance", q, np.zeros(d)
    yield "diagonal", np.eye(d), np.arange(d, 0, -1.0)


@pytest.mark.parametrize("name,q,spectrum", list(matrices()), ids=lambda v: v if isinstance(v, str) else "")
def test_eigenvectors_to_double_precision(name, q, spectrum):
    v = (q * spectrum) @ q.T
    v = (v + v.T) / 2
    values, vectors = whiten.eigenvectors(v)
    scale = max(spectrum.max(), 1e-300)
    assert (np.diff(values) <= 1e-14 * scale).all()
    assert np.abs(values - np.sort(np.linalg.eigvalsh(v))[::-1]).max() <= 4e-15 * scale
    assert np.abs(vectors.T @ vectors - np.eye(len(v))).max() < 1e-12
    assert np.abs(v @ vectors - vectors * values).max() <= 1e-15 * scale


def test_refinement_beats_its_start():
    r = np.random.default_rng(1)
    v = np.cov(r.normal(size=(64, 500)))
    _, start = np.linalg.eigh(v.astype(np.float32))
    rough = np.abs(start.T.astype(float) @ start - np.eye(64)).max()
    values, vectors = whiten.eigenvectors(v)
    assert rough > 1e-8 and np.abs(vectors.T @ vectors - np.eye(64)).max() < 2e-15
    residual = np.abs(v.astype(np.longdouble) @ vectors - vectors * values).max()
    assert residual < 1e-14


def exact(vectors):
    """Integers, sums, deviations and covariance in whole numbers."""
    x = [[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    s = [sum(r[i] for r in x) for i in range(d)]
    deviation = [sum((n * r[i] - s[i]) ** 2 for i in range(d)) for r in x]
    v = [[Fraction(sum((n * r[i] - s[i]) * (n * r[j] - s[j]) for r in x), n ** 3) for j in range(d)] for i in range(d)]
    return x, n, s, deviation, v


def held(df):
    out = defaultdict(dict)
    for r in df.collect():
        out[r.vec_id][r.component] = r
    return out


def check(df, ids, vectors, components):
    x, n, s, deviation, v = exact(vectors)
    got = held(df)
    assert sorted(got) == sorted(ids)
    m = np.array([[float(c) for c in row] for row in v])
    values, axes = np.linalg.eigh(m)
    values, axes = values[::-1], axes[:, ::-1]
    rows = np.array([[float(Fraction(a) - Fraction(b, n)) for a, b in zip(r, s)] for r in x])
    want = rows @ axes[:, :components] / np.sqrt(values[:components])
    have = np.array([[got[i][k + 1].whitened for k in range(components)] for i in ids])
    turned = np.sign((have * want).sum(axis=0))
    assert np.abs(have - want * turned).max() < 1e-8
    trace = float(sum(v[i][i] for i in range(len(v))))
    for i, dev in zip(ids, deviation):
        assert set(got[i]) == set(range(1, components + 1))
        assert {r.n for r in got[i].values()} == {n} and {int(r.deviation) for r in got[i].values()} == {dev}
    for k in range(components):
        assert abs(got[ids[0]][k + 1].explained - values[k] / trace) < 1e-12
    assert {r.identity_error for rows_ in got.values() for r in rows_.values()}.pop() < 1e-10
    assert np.abs(np.cov(have.T, bias=True) - np.eye(components)).max() < 1e-10


def test_against_whole_numbers(spark):
    r = random.Random(2)
    vectors = [[r.gauss(0, 1 + i % 5) for i in range(12)] for _ in range(150)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>").repartition(5)
    check(whiten.whitened(df, components=7), list(range(150)), vectors, 7)


def test_the_query_on_its_table(spark):
    rows = sorted(spark.read.parquet(f"{SF0001}/embeddings.parquet").collect(), key=lambda r: r.vec_id)
    out = queries.op13_whitening(spark, SF0001)
    assert dict(out.dtypes)["deviation"] == "bigint" and out.columns[:7] == [
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(out, [r.vec_id for r in rows], [r.embedding for r in rows], 32)


def test_odd_vectors(spark):
    r = random.Random(3)
    good = [[r.gauss(0, 1) for _ in range(4)] for _ in range(9)]
    rows = [(i, v) for i, v in enumerate(good)] + [(0, good[0]), (0, good[0])]           # repeated rows count
    odd = [(20, None), (21, [1.0, None, 0.0, 0.0]), (22, [float("nan")] * 4), (23, [float("inf"), 0.0, 0.0, 0.0]), (24, [1.0, 2.0]), (25, []),
           (26, [1e300, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame([(*x, "clash", "clash") for x in rows + odd], "vec_id long, embedding array<double>, n string, x string")
    out = whiten.whitened(df).collect()
    assert {q.vec_id for q in out} == set(range(9)) and {q.component for q in out} == {1, 2, 3, 4} and {q.n for q in out} == {11}
    assert len(out) == 11 * 4
    null = spark.createDataFrame([(None, [0.0, 1.0]), (None, [1.0, 0.0]), (1, [5.0, 3.0])], "vec_id long, embedding array<float>")
    assert sorted(str(q.vec_id) for q in whiten.whitened(null).collect()) == ["1", "1", "None", "None", "None", "None"]


def test_tables_without_variance(spark):
    schema = "vec_id long, embedding array<double>"
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(5)], [(1, [])]):
        assert whiten.whitened(spark.createDataFrame(rows, schema)).count() == 0
    line = spark.createDataFrame([(i, [float(i), float(i), 7.0]) for i in range(6)], schema)
    assert {r.component for r in whiten.whitened(line).collect()} == {1}        # one direction varies


def test_wide_entries_stay_exact(spark):
    vectors = [[3e7 * (i % 7 - 3) + i, 1e5 * i, float(i * i)] for i in range(40)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    check(whiten.whitened(df), list(range(40)), vectors, 3)
