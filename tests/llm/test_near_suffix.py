from __future__ import annotations

import hashlib
import random
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest

from wardline.llm import neardup, suffix


def sets_of(rows, k):
    out = []
    for _, t, *_ in rows:
        w = (t or "").encode().lower().split()
        out.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    return out


def components(rows, k=4):
    """Brute force: ``(doc_id, set size, smallest id reachable)`` of every row."""
    sets, parent = sets_of(rows, k), list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 5 * min(len(sets[i]), len(sets[j])) >= 4 * max(len(sets[i]), len(sets[j])):
                both = len(sets[i] & sets[j])
                if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                    parent[find(i)] = find(j)
    least = defaultdict(list)
    for i, (doc_id, *_) in enumerate(rows):
        if doc_id is not None:
            least[find(i)].append(doc_id)
    return Counter((rows[i][0], len(sets[i]), min(least[find(i)]) if least[find(i)] else None) for i in range(len(rows)))


def got(df):
    out = df.collect()
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in out)
    return Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out)


def test_components_against_brute_force(documents, document_rows, odd, odd_rows):
    assert got(neardup.link(documents)) == components(document_rows)
    assert got(neardup.link(odd)) == components(odd_rows)


@pytest.fixture(scope="module")
def family():
    """Copies of one text with up to eight words changed, and chains of small steps: links and near misses by the hundred."""
    r = random.Random(11)
    base = [f"b{r.randrange(10**6)}" for _ in range(150)]
    rows = []
    for i in range(250):
        words = list(base)
        for at in r.sample(range(150), r.randrange(9)):
            words[at] = f"x{r.randrange(10**9)}"
        rows.append((1000 - i, " ".join(words)))
    step = [f"s{i}" for i in range(100)]
    for i in range(30):
        step = step[2:] + [f"t{2 * i}", f"t{2 * i + 1}"]
        rows.append((2000 + i, " ".join(step)))
    return rows


@pytest.mark.parametrize("block", [neardup.BLOCK, 40])
def test_hot_family_in_blocks(spark, family, block, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", block)
    df = spark.createDataFrame(family, "doc_id long, text string")
    assert got(neardup.link(df)) == components(family)


def test_kept_rows_keep_one_of_each_group(odd, odd_rows):
    kept = neardup.kept_rows(odd)
    assert kept.columns == odd.columns
    ids = Counter(r["doc_id"] for r in kept.collect())
    groups = {c for _, n, c in components(odd_rows, 5) if n}
    empty = {i for i, n, _ in components(odd_rows, 5) if not n}
    assert set(ids) == groups | empty and max(ids.values()) == 1


def test_near_dedup_of_nothing(nothing):
    assert neardup.link(nothing).count() == 0


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(4)
    a, b, c = (rng.integers(0, 1 << 63, n).astype(np.uint64) for n in (900, 300, 300))
    x, y = np.concatenate([a, b]), np.concatenate([a, c])
    assert (neardup.registers(x) == np.maximum(neardup.registers(a), neardup.registers(b))).all()
    many = [neardup.estimate(neardup.registers(_salt(x, i))[None], neardup.registers(_salt(y, i))[None],
                             np.array([1200.0]), np.array([1200.0]))[0] for i in range(40)]
    assert np.mean(many) == pytest.approx(900 / 1500, abs=0.03)
    sub = [neardup.estimate(neardup.registers(_salt(x, i))[None], neardup.registers(_salt(a, i))[None],
                            np.array([1200.0]), np.array([900.0]))[0] for i in range(40)]
    assert np.mean(sub) == pytest.approx(900 / 1200, abs=0.02)     # the sizes sharpen it
    assert (1 - 0.8 ** neardup.ROWS) ** neardup.BANDS < 1e-7


def _salt(items, i):
    return neardup._mix(items + np.uint64(i * 7919 + 1))


def brute(rows, length):
    seen = Counter()
    raws = [(i, (t or "").encode()) for i, t, *_ in rows]
    for _, b in raws:
        seen.update(b[i:i + length] for i in range(len(b) - length + 1))
    out = Counter()
    for doc_id, b in raws:
        hit = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                hit[i:i + length] = b"\1" * length
        kept = bytes(x for x, h in zip(b, hit) if not h)
        spans = sum(h and not (j and hit[j - 1]) for j, h in enumerate(hit))
        out[doc_id, len(b), sum(hit), spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


def test_repeats_against_brute_force(documents, document_rows, odd, odd_rows):
    assert Counter(map(tuple, suffix.strip_repeats(documents).collect())) == brute(document_rows, 400)
    assert Counter(map(tuple, suffix.strip_repeats(odd).collect())) == brute(odd_rows, 400)


@pytest.mark.parametrize("group", [suffix.GROUP, 1])
def test_repeats_of_short_strings(spark, group):
    r = random.Random(group)
    rows = [(i, "".join(r.choice("ab\0é") for _ in range(r.randrange(60)))) for i in range(60)]
    rows += [(100 + i, r.choice(rows)[1] + "ab" * r.randrange(9)) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = suffix.strip_repeats(df, length=12, seed=4, group=group)
    assert Counter(map(tuple, out.collect())) == brute(rows, 12)


def test_repeats_of_nothing(nothing):
    assert suffix.strip_repeats(nothing).count() == 0


def test_open_boundaries_are_the_repeated_windows():
    r = random.Random(8)
    for length in (8, 9, 20, 33):
        segments = [bytes(r.choice(b"ab\x00") for _ in range(r.randrange(length, 90))) for _ in range(12)]
        segments += [s[r.randrange(5):] for s in segments[:6]]
        hit, at = suffix.open_boundaries(segments, length), 0
        seen = Counter(s[i:i + length] for s in segments for i in range(len(s) - length + 1))
        for s in segments:
            n = max(0, len(s) - length + 1)
            assert hit[at:at + n].tolist() == [seen[s[i:i + length]] > 1 for i in range(n)]
            at += len(s) + 1


def test_expansion_takes_under_sixty_bytes_a_byte():
    r = random.Random(3)
    base = bytes(r.randrange(97, 123) for _ in range(3000))
    segments = [bytes(r.randrange(97, 123) for _ in range(100)) + base[(at := r.randrange(2000)):at + 600] for _ in range(400)]
    tracemalloc.start()
    try:
        hit = suffix.open_boundaries(segments, 400)
        assert tracemalloc.get_traced_memory()[1] < 60 * len(hit)
    finally:
        tracemalloc.stop()
    assert hit.any() and not hit.all()


def test_fetched_bytes_leave_in_pieces(monkeypatch):
    monkeypatch.setattr(suffix, "_PIECE", 1000)
    want = [{"anchor": i, "m": 1, "big": False, "lo": i, "hi": i + 100} for i in range(50)]
    pdf = pd.DataFrame({"tid": [0, 1], "text": ["x" * 600] * 2, "wanted": [want] * 2})
    out = list(suffix._fetch(400)([pdf]))
    assert sum(map(len, out)) == 100 and max(b["raw"].str.len().sum() for b in out) < 1500


def test_runs_cover_every_window_across_pieces(monkeypatch):
    monkeypatch.setattr(suffix, "_PIECE", 50)
    r = random.Random(1)
    raw = bytes(r.choice(b"abc") for _ in range(400)) + b"a" * 100
    found = list(suffix.runs(raw, 20, 4))
    assert [w for _, lo, hi in found for w in range(lo, hi + 1)] == list(range(len(raw) - 19))
