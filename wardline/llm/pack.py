"""Packing (operator 2): non-negative least squares over the length histogram.

Every document becomes token ids and a closing id 0.  Whole windows are cut
off; what remains of a document is shorter than a window.  The histogram of
these lengths (at most ``window - 1`` counts, whatever the corpus) is fitted by
repeat counts of shallow combinations: all pairs and triples of present lengths
that fill a window exactly.  The counts are solved by coordinate descent on the
non-negative least squares problem, rounded, and handed out; residual pieces are
laid end to end and cut at window ends, so only the last sequence is padded.

A piece finds its place from its length and its rank among pieces of its
length: rank = (pieces of that length in earlier partitions) + (those before it
in its own).  No sort, no window over rows, no shuffle of ids.

Ids equal those of ``tokenizers`` for the same file (special tokens in a text
are matched, none are added); its ``tiktoken`` form encodes faster, and texts
with very long runs without white space, where that one is slow, go through
``tokenizers`` itself.

Edge cases: a null or empty text is the one id 0; very long texts are cut into
many windows; repeated rows are packed each; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import base64
import re
import zlib
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm.common import ship, stage

WINDOW = 1024
VOCABULARY = "byte_bpe_50k"
SWEEPS = 12
# Rank bases (one row per length and partition) are broadcast up to this many.
BROADCAST_ROWS = 1_000_000
_LONG_RUN = re.compile(r"\S{2000}")

_PIECE = ("part int, doc_id long, start long, length int, ids_crc32 long, doc_tokens long, "
          "place long, ids binary")
_PLACED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"


@lru_cache(maxsize=2)
def _encoders(folder: str | None, vocabulary: str):
    import tiktoken
    from tokenizers import Tokenizer
    if folder is None:
        import public_tokenizers as files
        path, pattern = files.path, files.PATTERN
    else:
        import os
        from public_tokenizers import PATTERN as pattern
        path = lambda name: os.path.join(folder, name)
    exact = Tokenizer.from_file(path(f"{vocabulary}.json"))
    with open(path(f"{vocabulary}.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    special = {t.content: i for i, t in exact.get_added_tokens_decoder().items()}
    quick = tiktoken.Encoding(vocabulary, pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
    return exact, quick


def token_ids(text: str, folder: str | None = None, vocabulary: str = VOCABULARY) -> np.ndarray:
    """Ids of a whole text and the closing 0, little-endian 32-bit."""
    exact, quick = _encoders(folder, vocabulary)
    if _LONG_RUN.search(text):
        ids = exact.encode(text, add_special_tokens=False).ids
    else:
        ids = quick.encode(text, allowed_special="all")
    return np.array([*ids, 0], "<u4")


def _cut(window: int, folder: str | None, vocabulary: str, keep_ids: bool):
    """Pieces of each document, with their place among those of their length in the partition."""
    def run(batches):
        part = TaskContext.get().partitionId()
        seen = np.zeros(window + 1, np.int64)
        for pdf in batches:
            rows = []
            for doc_id, text in zip(pdf["doc_id"], pdf["text"]):
                ids = token_ids(text or "", folder, vocabulary)
                doc_id = None if pd.isna(doc_id) else int(doc_id)
                for start in range(0, len(ids), window):
                    raw = ids[start:start + window].tobytes()
                    n = len(raw) // 4
                    rows.append((part, doc_id, start, n, zlib.crc32(raw), len(ids), seen[n],
                                 raw if keep_ids or n < window else None))
                    seen[n] += 1
                if len(rows) >= 5000:
                    yield _frame(rows, _PIECE)
                    rows = []
            yield _frame(rows, _PIECE)
    return run


def _frame(rows, schema: str) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")]).astype({"doc_id": "Int64"})


def combinations(lengths: list[int], window: int) -> list[tuple[int, ...]]:
    """Pairs, then triples, of present lengths that fill the window exactly."""
    there = set(lengths)
    pairs = [(a, window - a) for a in lengths if a <= window - a and window - a in there]
    triples = [(a, b, window - a - b) for a in lengths for b in lengths
               if a <= b <= window - a - b and window - a - b in there]
    return pairs + triples


def solve(hist: dict[int, int], window: int = WINDOW) -> list[tuple[tuple[int, ...], int]]:
    """Combinations and their whole repeat counts, within the histogram.

    Coordinate descent on ``min |A x - h|`` with ``x >= 0``: each column in turn
    takes its best step, so early columns take what they can and the solution
    stays sparse.  Counts are rounded and held to what is left.
    """
    columns = combinations(sorted(k for k, v in hist.items() if v and k < window), window)
    rest = {k: float(v) for k, v in hist.items()}
    x = [0.0] * len(columns)
    for _ in range(SWEEPS):
        moved = 0.0
        for j, col in enumerate(columns):
            if x[j] == 0.0 and min(rest[c] for c in col) <= 0.0:
                continue                                  # rows that are used up already
            norm = sum(col.count(c) for c in col)
            step = max(sum(rest[c] for c in col) / norm, -x[j])
            if step > 0.0:
                step = min(step, min(rest[c] / col.count(c) for c in col) if x[j] == 0.0 else step)
            if step:
                x[j] += step
                moved += abs(step)
                for c in col:
                    rest[c] -= step
        if moved < 0.5:
            break
    left = dict(hist)
    out = []
    for j in sorted(range(len(columns)), key=lambda j: (-x[j], j)):
        col = columns[j]
        n = min(int(x[j] + 0.5), *(left[c] // col.count(c) for c in col))
        if n > 0:
            out.append((col, n))
            for c in col:
                left[c] -= n
    return out


class Plan:
    """Where the piece with a given length and rank goes."""

    def __init__(self, hist: dict[int, int], window: int = WINDOW):
        self.window = window
        sequence = hist.get(window, 0)                     # whole windows come first
        used = np.zeros(window + 1, np.int64)
        entries = []
        for col, n in solve(hist, window):
            offset = 0
            for length in col:
                entries.append((length, used[length], sequence, offset))
                used[length] += n
                offset += length
            sequence += n
        entries.sort()
        self.used, self.tail = used, sequence
        self.keys = np.array([(a << 44) | int(b) for a, b, _, _ in entries], np.int64)
        self.rank, self.sequence, self.offset = (
            np.array([e[i] for e in entries], np.int64) for i in (1, 2, 3))
        left = np.array([hist.get(k, 0) for k in range(window)], np.int64) - used[:window]
        self.base = np.concatenate([[0], np.cumsum(left * np.arange(window))])

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of each piece's first id."""
        sequence, offset = rank.copy(), np.zeros(len(rank), np.int64)
        fitted = rank < self.used[length]
        if fitted.any():
            at = np.searchsorted(self.keys, (length[fitted] << 44) | rank[fitted], "right") - 1
            sequence[fitted] = self.sequence[at] + rank[fitted] - self.rank[at]
            offset[fitted] = self.offset[at]
        rest = ~fitted & (length < self.window)
        line = self.base[length[rest]] + (rank[rest] - self.used[length[rest]]) * length[rest]
        sequence[rest] = self.tail + line // self.window
        offset[rest] = line % self.window
        return sequence, offset


def _place(plan: Plan, keep_ids: bool):
    def run(batches):
        for pdf in batches:
            length = pdf["length"].to_numpy(np.int64)
            sequence, offset = plan.place(length, pdf["rank"].to_numpy(np.int64))
            out = pdf[["doc_id", "start", "length", "ids_crc32", "doc_tokens"]].astype({"doc_id": "Int64", "length": "int64"})
            out["sequence_id"], out["offset"] = sequence, offset
            out["ids"] = pdf["ids"] if keep_ids else None
            over = offset + length > plan.window           # cut at the window's end
            yield out[~over]
            rows = []
            for i in np.flatnonzero(over):
                doc_id, start, total, raw = (pdf[c].iloc[i] for c in ("doc_id", "start", "doc_tokens", "ids"))
                at = int(plan.window - offset[i]) * 4
                for k, (a, b) in enumerate(((0, at), (at, len(raw)))):
                    rows.append((None if pd.isna(doc_id) else int(doc_id), int(start) + a // 4, (b - a) // 4, zlib.crc32(raw[a:b]), int(total),
                                 int(sequence[i]) + k, 0 if k else int(offset[i]), raw[a:b] if keep_ids else None))
            yield _frame(rows, _PLACED)
    return run


def pack(docs: DataFrame, window: int = WINDOW, folder: str | None = None, vocabulary: str = VOCABULARY,
         keep_ids: bool = True, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` and ``ids``.

    ``ids`` (little-endian 32-bit) is null without ``keep_ids``.  ``folder``
    holds the tokenizer files; by default those of the installed package.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    pieces = stage(rows.mapInPandas(_cut(window, folder, vocabulary, keep_ids), _PIECE), "pieces")
    counts = pieces.groupBy("length", "part").count()
    bases = stage(counts.withColumn("base", F.sum("count").over(
        Window.partitionBy("length").orderBy("part")) - F.col("count")), "bases")
    hist = {r["length"]: r["n"] for r in bases.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    base = bases.select("length", "part", "base")
    if bases.count() <= BROADCAST_ROWS:
        base = F.broadcast(base)
    ranked = pieces.join(base, ["length", "part"]).withColumn("rank", F.col("base") + F.col("place"))
    return ranked.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "rank", "ids").mapInPandas(
        _place(Plan(hist, window), keep_ids), _PLACED)
