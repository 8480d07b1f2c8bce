from __future__ import annotations

import hashlib
import os
import zlib
from collections import Counter, defaultdict

from wardline.llm import exact, shard
from wardline.llm.common import ASCII_UPPER


def lowered(text):
    return (text or "").translate(str.maketrans(ASCII_UPPER, ASCII_UPPER.lower()))


def expected(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[lowered(text)].append(doc_id)
    out = []
    for doc_id, text, *_ in rows:
        ids = groups[lowered(text)]
        top = max((i for i in ids if i is not None), default=None)
        out.append((doc_id, top, len(ids), doc_id == top, hashlib.sha256(lowered(text).encode()).hexdigest()))
    return Counter(out)


def test_exact_dedup_against_brute_force(documents, document_rows, odd, odd_rows):
    for df, rows in ((documents, document_rows), (odd, odd_rows)):
        assert Counter(map(tuple, exact.dedup(df).collect())) == expected(rows)


def test_exact_dedup_of_nothing(nothing):
    assert exact.dedup(nothing).count() == 0
    assert exact.kept_rows(nothing).count() == 0


def test_index_remembers_earlier_batches(spark):
    schema = "doc_id long, text string"
    index = exact.DigestIndex(spark)
    exact.dedup(spark.createDataFrame([(1, "A"), (2, "b")], schema), index).collect()
    second = exact.dedup(spark.createDataFrame([(5, "a"), (6, "c"), (7, "C")], schema), index)
    assert {(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in second.collect()} == {
        (5, 1, 1, False), (6, 7, 2, False), (7, 7, 2, True)}
    again = exact.DigestIndex(spark, index.path)                # the files alone hold the index
    assert {r["keep_id"] for r in again.read().collect()} == {1, 2, 7}
    third = exact.dedup(spark.createDataFrame([(9, "B")], schema), again).collect()
    assert [(r["keep_id"], r["kept"]) for r in third] == [(2, False)]


def test_an_append_adds_one_file_a_bucket_whatever_the_partitions(spark, monkeypatch):
    frame = type(spark.range(0))
    for name in ("repartition", "repartitionByRange"):          # a session that deals every key to more partitions
        monkeypatch.setattr(frame, name, lambda self, n, *cols, f=getattr(frame, name): f(self, max(n, 37), *cols))
    rows = [(i, f"text {i % 300}") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    index = exact.DigestIndex(spark, buckets=8)
    assert Counter(map(tuple, exact.dedup(df, index).collect())) == expected(rows)
    assert index.read().count() == 300
    files = [f for f in os.listdir(index.path.removeprefix("file:")) if f.startswith("part-")]
    assert len(files) == len({f.split("_")[-1] for f in files}) == 8, files


def test_anti_join_does_not_move_the_index(spark):
    index = exact.DigestIndex(spark)
    plan = index.read().select("digest").hint("merge").join(
        spark.createDataFrame([("x",)], "digest string"), "digest")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") <= 1, plan


def test_kept_rows_keep_their_columns_and_one_row_a_text(odd, odd_rows):
    kept = exact.kept_rows(odd)
    assert kept.columns == odd.columns
    texts = Counter(lowered(r["text"]) for r in kept.collect())
    assert set(texts) == {lowered(r[1]) for r in odd_rows} and max(texts.values()) == 1


def test_shards_hold_every_row_once_and_evenly(documents, document_rows, odd, odd_rows):
    for df, rows in ((documents, document_rows), (odd, odd_rows)):
        out = shard.shard(df).collect()
        assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in out) == Counter(
            (i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
        places = defaultdict(list)
        for r in out:
            assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < shard.SHARDS
            places[r["shard"]].append(r["slot"])
        assert all(sorted(p) == list(range(len(p))) for p in places.values())
        load, largest = Counter(), max(r["size"] for r in out)
        for r in out:
            load[r["shard"]] += r["size"]
        assert max(load.values()) <= sum(load.values()) / shard.SHARDS + largest


def test_a_third_of_all_rows_is_one_row(spark):
    """Copies of a row spread over the slots: the shards stay even."""
    rows = [(7, "x" * 1000)] * 2000 + [(100 + i, "y" * (i % 900)) for i in range(4000)] + [(None, "z" * 300)] * 500
    out = shard.shard(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect()
    assert Counter(r["doc_id"] for r in out) == Counter(r[0] for r in rows)
    load, copies, slots = Counter(), Counter(), Counter()
    for r in out:
        load[r["shard"]] += r["size"]
        slots[r["virtual_slot"]] += 1
        copies[r["shard"]] += r["doc_id"] == 7
    assert max(load.values()) - min(load.values()) <= 0.01 * sum(load.values()) / shard.SHARDS + 1016
    assert len(copies) == shard.SHARDS and max(slots.values()) < 20


def test_shard_of_nothing(nothing):
    assert shard.shard(nothing).count() == 0


def test_rebalance_edits_the_map(spark, documents):
    store = shard.SlotMap(spark)
    first = {(r["doc_id"], r["shard"]) for r in shard.shard(documents, 8, 64, store).collect()}
    second = {(r["doc_id"], r["shard"]) for r in shard.shard(documents, 9, 64, store, 2).collect()}
    moved = [s for _, s in second - first]
    assert 0 < len(moved) < len(second) / 2                      # nothing hashes anew
    assert store.read(1).count() == store.read(2).count() == 64
    load = Counter()
    for r in store.read(2).collect():
        load[r["shard"]] += r["bytes"]
    assert set(load) == set(range(9))


def test_placement_is_longest_first(spark):
    loads = spark.createDataFrame([(i, b, 1) for i, b in enumerate((7, 5, 4, 4, 3, 1))], "virtual_slot int, bytes long, n long")
    got = {r["virtual_slot"]: r["shard"] for r in shard.rebalance(loads, 2).collect()}
    assert got == {0: 0, 1: 1, 2: 1, 3: 0, 4: 1, 5: 0}
    assert "Python" not in shard.rebalance(loads, 2)._jdf.queryExecution().executedPlan().toString()
