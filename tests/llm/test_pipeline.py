from __future__ import annotations

from collections import Counter

import corpus_pipeline
from tests.llm.conftest import SF0001
from tests.llm.test_exact_shard import lowered
from tests.llm.test_mix_language import filled
from tests.llm.test_near_suffix import components


def test_stages_against_brute_force(spark, documents, document_rows):
    docs, seen, held = documents, {}, []
    for name, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, SF0001)
        if name != "packed":
            assert docs.columns == documents.columns
        docs = docs.cache()
        held.append(docs)
        seen[name] = docs.collect()
    for df in held:
        df.unpersist()
    ids = {name: sorted(r["doc_id"] for r in rows) for name, rows in seen.items() if name != "packed"}
    rows = {r[0]: r for r in document_rows}
    assert set(ids["language"]) == {i for i, r in rows.items() if (r[1] or "").strip()}
    best = {}
    for i in ids["language"]:
        best[lowered(rows[i][1])] = max(i, best.get(lowered(rows[i][1]), -1))
    assert ids["exact_dedup"] == sorted(best.values())
    kept = {c for _, _, c in components([rows[i] for i in ids["exact_dedup"]], 5)}
    assert ids["near_dedup"] == sorted(kept)
    times = Counter(ids["mixture"])
    assert set(times) <= kept and max(times.values()) <= 2
    words, taken = Counter(), Counter()
    for i in kept:
        n = len(rows[i][1].split())
        words[rows[i][3]] += n
        taken[rows[i][3]] += n * times[i]
    for source, target in filled(dict(words)).items():
        largest = max(len(rows[i][1].split()) for i in kept if rows[i][3] == source)
        assert abs(taken[source] - target) <= largest
    tokens = Counter()
    for r in seen["packed"]:
        tokens[r["doc_id"]] += r["length"]
    total = {r["doc_id"]: r["doc_tokens"] for r in seen["packed"]}
    assert tokens == Counter({i: n * total[i] for i, n in times.items()})


def test_run_and_registration(spark):
    import __spark_entry__ as entry
    assert entry.queries()["pipeline"] is corpus_pipeline.run
    assert sorted(int(k[2:].split("_")[0]) for k in entry.queries() if k.startswith("op")) == list(range(1, 14))
    assert corpus_pipeline.run(spark, SF0001).count() > 0


def test_odd_rows_pass_every_stage(spark, odd, documents):
    more = documents
    from pyspark.sql import functions as F
    for c in odd.columns:
        if c not in more.columns:
            more = more.withColumn(c, F.lit("clash"))
    docs = odd.unionByName(more.select(*odd.columns))
    for name, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, SF0001)
        if name != "packed":
            assert docs.columns == odd.columns
    assert docs.count() > 0
