from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from wardline.llm import pack


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def check(pieces, rows, tokenizer, window=pack.WINDOW):
    want = Counter((i, tuple(tokenizer.encode(t or "", add_special_tokens=False).ids) + (0,)) for i, t, *_ in rows)
    by_id = defaultdict(list)
    for r in pieces:
        ids = np.frombuffer(bytes(r["ids"]), "<u4")
        assert len(ids) == r["length"] and zlib.crc32(ids.tobytes()) == r["ids_crc32"] and 0 < r["length"] <= window
        by_id[r["doc_id"], r["doc_tokens"]].append((r["start"], ids))
    for (doc_id, total), parts in by_id.items():
        copies = [ids for (i, ids), n in want.items() for _ in range(n) if i == doc_id and len(ids) == total]
        assert sum(len(x) for _, x in parts) == total * len(copies)
        for at, ids in parts:
            assert any(tuple(ids) == c[at:at + len(ids)] for c in copies)
    assert {(i, len(ids)) for i, ids in want} == set(by_id)
    places = defaultdict(list)
    for r in pieces:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    padded = 0
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
        padded += at < window
    assert padded <= 1
    assert sorted(places) == list(range(len(places)))


def test_round_trip(documents, document_rows, odd, odd_rows, tokenizer):
    check(pack.pack(documents).collect(), document_rows, tokenizer)
    check(pack.pack(odd).collect(), odd_rows, tokenizer)


def test_small_window_cuts_residuals(documents, document_rows, tokenizer):
    check(pack.pack(documents, window=64).collect(), document_rows, tokenizer, 64)


def test_nothing(nothing):
    assert pack.pack(nothing).count() == 0


def test_ids_equal_those_of_the_library(tokenizer):
    for text in ("", " ", "a<|endoftext|>b", "it's  1,234\n\n\t né ﬁ x", " \u0085 \x1c", "x" * 5000, "日本語 \U0001f600" * 30):
        assert pack.token_ids(text).tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 0]


def test_repeat_counts_stay_within_the_histogram():
    rng = np.random.default_rng(3)
    for window in (16, 64, 256):
        hist = {i: int(rng.integers(0, 50)) for i in range(1, window + 1)}
        used = Counter()
        for combination, n in pack.solve(hist, window):
            assert sum(combination) == window and n > 0
            for c in combination:
                used[c] += n
        assert all(used[k] <= hist[k] for k in used)
        pieces = sum(v for k, v in hist.items() if k < window)
        assert sum(used.values()) > (0.8 if window > 16 else 0.5) * pieces   # few are left to the greedy step


def test_one_length_holds_a_third():
    plan = pack.Plan({700: 10_000, 324: 3_000, 100: 9_000, 1024: 5})
    length = np.repeat([700, 324, 100, 1024], [10_000, 3_000, 9_000, 5])
    rank = np.concatenate([np.arange(n) for n in (10_000, 3_000, 9_000, 5)])
    sequence, offset = plan.place(length, rank)
    total = (sequence * 1024 + offset + length).max()
    assert total - length.sum() < 1024                            # no gaps but the last
