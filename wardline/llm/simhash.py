"""Document fingerprints (operator 10): SimHash.

Terms are pairs of neighbouring words (the word itself in a text of one word).
Each distinct term votes with weight ``1 + ln(count)`` on ``BITS`` signed bits,
and the signs are the fingerprint, in lowercase hex.  The angle between two
fingerprints estimates the cosine of the weighted term vectors.

:func:`within` finds, for a query set, every fingerprint within a Hamming
radius: with ``radius + 2`` blocks, two fingerprints in reach agree on at least
two blocks, so a table keyed by each pair of blocks holds the match.

Edge cases: null text counts as empty; a text without words has the all-zero
fingerprint, like another such text by 1 and unlike any other by 0; rows of one
id follow each other by the hash of their text; the row after the last is the
first, so a table of one row is its own next; an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm.common import ship, stage

BITS = 256
_CHUNK = 4096
# Odd multipliers, one per 64 bits of the fingerprint.
_MULT = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)
_EMPTY = bytes(BITS // 8)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9FB21C651E98DF25)
    return h ^ (h >> np.uint64(32))


def fingerprint(text: str) -> bytes:
    """The SimHash of a whole text."""
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return _EMPTY
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    if len(h) > 1:
        h = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + _mix(h[1:])
    terms, counts = np.unique(h, return_counts=True)
    weight = (1.0 + np.log(counts)).astype(np.float32)
    votes = np.zeros(BITS, np.float32)
    for at in range(0, len(terms), _CHUNK):
        part = _mix(terms[at:at + _CHUNK, None] * _MULT[None, :])
        bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(len(part), -1), axis=1)
        votes += weight[at:at + _CHUNK] @ bits.astype(np.float32)
    return np.packbits(votes * 2 > weight.sum()).tobytes()


def likeness(a: bytes, b: bytes) -> float:
    """Estimated cosine of two fingerprints, 0 at right angles and beyond."""
    if a == _EMPTY or b == _EMPTY:
        return float(a == b)
    off = (int.from_bytes(a) ^ int.from_bytes(b)).bit_count()
    return max(0.0, float(np.cos(np.pi * off / BITS)))


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as much of the beginning of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


_OUT = ("seam int, part int, doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double, text string")


def _row(doc_id, text: str, fp: bytes, following: str, next_fp: bytes) -> tuple:
    new = edited(text, following)
    new_fp = fingerprint(new)
    return (0, 0, doc_id, len(text), hashlib.sha256(new.encode("utf-8", "replace")).hexdigest(), fp.hex(),
            new_fp.hex(), likeness(fp, new_fp), likeness(fp, next_fp), None)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=[x.split()[0] for x in _OUT.split(", ")])
    return out.astype({"doc_id": "Int64"})


def _sweep(batches):
    """Each row with the next one of its partition; the first and last rows too, for the seams."""
    part, before, out, size = TaskContext.get().partitionId(), None, [], 0
    for pdf in batches:
        for doc_id, text in zip(pdf["doc_id"], pdf["text"]):
            here = (None if pd.isna(doc_id) else int(doc_id), text or "", fingerprint(text or ""))
            if before is None:
                out.append((1, part, here[0], None, None, here[2].hex(), None, None, None, here[1]))
            else:
                out.append(_row(*before, *here[1:]))
            before = here
            if len(out) >= 2000:
                yield _frame(out)
                out = []
    if before is not None:
        out.append((2, part, before[0], None, None, before[2].hex(), None, None, None, before[1]))
    yield _frame(out)


def _stitch(batches):
    for pdf in batches:
        yield _frame([_row(None if pd.isna(i) else int(i), t, bytes.fromhex(f), nt, bytes.fromhex(nf))
                      for i, t, f, nt, nf in zip(pdf["doc_id"], pdf["text"], pdf["fingerprint"],
                                                 pdf["next_text"], pdf["next_fp"])])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document's fingerprint, that of its edited text, and its likeness to that and to the next one.

    Rows are ordered by range partitions and swept once; only a partition's
    first and last row need a neighbour from elsewhere.
    """
    ship(docs.sparkSession)
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), body.alias("text"),
                       F.xxhash64(body).alias("_tie"))
    swept = stage(rows.repartitionByRange("doc_id", "_tie").sortWithinPartitions("doc_id", "_tie")
                  .select("doc_id", "text").mapInPandas(_sweep, _OUT), "swept")
    heads = swept.where("seam = 1").select(F.col("part").alias("next_part"), F.col("text").alias("next_text"),
                                           F.col("fingerprint").alias("next_fp"))
    # One short row per partition.
    every = Window.orderBy("part")
    follow = swept.where("seam = 1").select("part").withColumn("next_part", F.coalesce(
        F.lead("part").over(every), F.min("part").over(Window.partitionBy())))
    tails = (swept.where("seam = 2").select("part", "doc_id", "text", "fingerprint")
             .join(follow, "part").join(heads, "next_part")
             .mapInPandas(_stitch, _OUT))
    cols = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return swept.where("seam = 0").select(*cols).unionByName(tails.select(*cols))


def within(queries: DataFrame, table: DataFrame, radius: int = 6) -> DataFrame:
    """``query_id, doc_id, distance`` of every fingerprint of ``table`` within ``radius`` bits.

    Both have ``doc_id`` and ``fingerprint`` (hex).  Equal fingerprints are
    one entry of the tables; their documents come back by an equality join.
    """
    digits, blocks = BITS // 4, radius + 2
    cuts = [digits * i // blocks for i in range(blocks + 1)]
    block = [F.substring("fingerprint", a + 1, b - a) for a, b in zip(cuts, cuts[1:])]
    keys = F.array(*[F.xxhash64(F.lit(i * blocks + j), block[i], block[j])
                     for i, j in combinations(range(blocks), 2)])
    ask = queries.select("fingerprint").distinct().withColumn("key", F.explode(keys))
    have = table.select("fingerprint").distinct().withColumn("key", F.explode(keys))
    pair = ask.join(have.withColumnRenamed("fingerprint", "found"), "key").select("fingerprint", "found").distinct()
    off = sum((F.bit_count(F.conv(F.substring("fingerprint", at, 15), 16, 10).cast("long").bitwiseXOR(
        F.conv(F.substring("found", at, 15), 16, 10).cast("long"))) for at in range(1, digits + 1, 15)), F.lit(0))
    near = pair.withColumn("distance", off).where(F.col("distance") <= radius)
    return (queries.select(F.col("doc_id").alias("query_id"), "fingerprint").join(near, "fingerprint")
            .join(table.select("doc_id", F.col("fingerprint").alias("found")), "found")
            .select("query_id", "doc_id", "distance"))
