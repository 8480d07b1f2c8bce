from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardline.llm import langid, mix


def filled(sizes, share=1.5, cap=2.0, weights=(3, 1, 2)):
    """Brute force: reshare what is over among those that are not at the cap."""
    names = sorted((k for k in sizes if k is not None), key=lambda k: [ord(c) for c in k]) + [None] * (None in sizes)
    weight = {k: weights[i % len(weights)] for i, k in enumerate(names)}
    total, full = share * sum(sizes.values()), set()
    while True:
        rest = total - sum(cap * sizes[k] for k in full)
        open_ = [k for k in names if k not in full]
        want = {k: rest * weight[k] / sum(weight[o] for o in open_) for k in open_}
        over = [k for k in open_ if want[k] > cap * sizes[k]]
        if not over:
            return {k: cap * sizes[k] if k in full else want[k] for k in names}
        full |= set(over)


def check(out, rows, near):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert Counter((r["doc_id"], r["size"]) for r in out) == Counter((i, size(t)) for i, t, *_ in rows)
    sums = Counter()
    for _, t, _, s in rows:
        sums[s] += size(t)
    want = filled(dict(sums))
    source = {(i, size(t)): s for i, t, _, s in rows}
    got, largest = Counter(), defaultdict(int)
    for r in out:
        s = source[r["doc_id"], r["size"]]
        assert r["source_size"] == sums[s] and r["target"] == pytest.approx(want[s])
        assert 0 <= r["taken"] <= 2 * r["size"]
        got[s] += r["taken"]
        largest[s] = max(largest[s], r["size"])
    for s in want:
        assert abs(got[s] - want[s]) <= near(largest[s], want[s])


def test_targets_and_taken(documents, document_rows, odd, odd_rows):
    check(mix.taken(documents).collect(), document_rows, lambda most, want: max(5.0, 0.02 * want, most / 2))
    check(mix.taken(odd).collect(), odd_rows, lambda most, want: most)


def test_reruns_agree_however_dealt(documents):
    one = sorted(map(tuple, mix.taken(documents).collect()))
    assert one == sorted(map(tuple, mix.taken(documents.repartition(7)).collect()))


def test_blocks_meet_in_rounds(documents, document_rows, monkeypatch):
    monkeypatch.setattr(mix, "BLOCK", 4)
    check(mix.taken(documents).collect(), document_rows, lambda most, want: max(5.0, 0.02 * want, most))


def test_a_third_of_all_rows_is_one_row(spark, monkeypatch):
    monkeypatch.setattr(mix, "BLOCK", 64)
    rows = [(7, "a b c", "s")] * 1500 + [(i, "w " * (i % 9 + 1), "s" if i % 3 else "t") for i in range(100, 3100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    order = F.xxhash64("doc_id").alias("_order")
    stored = docs.repartition(6).select("doc_id", order, F.monotonically_increasing_id().alias("_place")).cache()
    sizes = mix.apart(stored).groupBy(F.pmod("_order", F.lit(70)).alias("block")).count().toPandas()["count"]
    assert sizes.sum() == 4500 and sizes.max() < 4 * 64
    other = docs.repartition(3).select("doc_id", order, F.monotonically_increasing_id().alias("_place")).cache()
    numbers = [sorted(x["_order"] for x in mix.apart(s).collect()) for s in (stored, other)]
    assert numbers[0] == numbers[1] and len(set(numbers[0])) == 4500
    stored.unpersist()
    other.unpersist()
    out = mix.taken(docs).groupBy("source_size", "target").agg(F.sum("taken").alias("taken"), F.count("*").alias("n")).collect()
    assert sum(r["n"] for r in out) == 4500 and all(abs(r["taken"] - r["target"]) <= 0.02 * r["target"] for r in out)


def test_nothing(nothing):
    assert mix.taken(nothing).count() == 0


def test_mixed_rows_repeat_rows_whole(odd):
    rows = mix.mixed_rows(odd)
    assert rows.columns == odd.columns
    times = Counter(r["doc_id"] for r in rows.collect())
    want = Counter()
    for r in mix.mix(odd.select("doc_id", "text", "source")).collect():
        want[r["doc_id"]] += r["_times"]
    assert times == +want


def test_flight_keeps_words_and_documents():
    rng = np.random.default_rng(1)
    size, p = rng.integers(1, 5000, 300).astype(float), np.full(300, 0.37)
    out = mix.fly(size, p, iter(rng.random(400).tolist()), False)
    assert ((out > 0) & (out < 1)).sum() <= 2
    assert out.sum() == pytest.approx(p.sum()) and (out * size).sum() == pytest.approx((p * size).sum(), rel=1e-6)
    assert mix.fly(np.ones(9), np.full(9, 1 / 3), iter(rng.random(99).tolist()), True).sum() == 3


def test_ranked_is_global(spark):
    df = spark.createDataFrame([(x,) for x in ("b", None, "é", "a", "Z", "😀")], "source string").repartition(4)
    from pyspark.sql import functions as F
    got = {r["source"]: r["rank"] for r in mix.ranked(df, F.col("source").asc_nulls_last()).collect()}
    assert got == {"Z": 0, "a": 1, "b": 2, "é": 3, "😀": 4, None: 5}


def test_language_held_out(documents):
    fit, held = documents.where("doc_id % 2 = 0"), documents.where("doc_id % 2 = 1")
    out = langid.identify(held, langid.fit(fit)).collect()            # the text alone
    assert np.mean([r["_language"] == r["lang"] for r in out]) >= 0.97


def test_evidence_decides_short_texts(spark, documents):
    model = langid.fit(documents)
    rows = [("http://a.example.de/1", '<html lang="de-AT"><p>ab</p>', "ab")] * 3 + [("http://b.example.fr/2", "<html><p>ab", "ab")]
    rows += [("http://b.example.fr/2", "<HTML LANG=fr>", r["text"]) for r in documents.where("lang = 'fr'").limit(15).collect()]
    rows += [("http://a.example.de/2", "<html lang='de'>", r["text"]) for r in documents.where("lang = 'de'").limit(15).collect()]
    pages = spark.createDataFrame(rows, "url string, html string, text string")
    from pyspark.sql import functions as F
    out = langid.identify(pages, model, declared=langid.declared_in(F.col("html")), host=langid.host_of(F.col("url"))).collect()
    short = [(r["url"], r["_language"]) for r in out if r["text"] == "ab"]
    assert set(short) == {("http://a.example.de/1", "de"), ("http://b.example.fr/2", "fr")}


def test_language_odd_rows(spark, documents, odd, odd_rows, nothing):
    out = langid.identify(odd, langid.fit(documents), declared="lang", host="source")
    assert out.columns == [*odd.columns, "_language", "_posterior", "_accepted"]
    got = out.collect()
    assert len(got) == len(odd_rows)
    assert all(not r["_accepted"] and r["_language"] == "und" for r in got if not (r["text"] or "").strip())
    assert all(0 <= r["_posterior"] <= 1.000001 for r in got)
    assert langid.languages(nothing).count() == 0
    none = langid.identify(odd, langid.fit(nothing)).collect()          # no model: und
    assert {r["_language"] for r in none} == {"und"}


def test_junk_is_und(spark, documents):
    import random
    r = random.Random(2)
    junk = "".join(chr(r.randrange(0x4E00, 0x9FFF)) for _ in range(400))
    df = spark.createDataFrame([(1, junk, "en", "src1")], "doc_id long, text string, lang string, source string")
    assert not langid.identify(df, langid.fit(documents)).first()["_accepted"]
