"""Suffix-array dedup (operator 6): threshold-bounded interval expansion on a BWT.

Every byte covered by a string of ``length`` bytes that also starts elsewhere is
removed.  Equal texts are one text with a count.  A window of ``length`` bytes is
sent where its minimiser (the least hash of ``SEED`` bytes in it) is sent, so
equal windows meet whatever their texts:

1. Windows in a row with one minimiser, at one place, are a run; a run is a few
   numbers and a hash of its bytes.  Minimisers that occur once hold no repeat and are dropped.
2. Runs with equal bytes repeat as a whole.  What is left are minimisers with
   several different runs; only one of each kind has its bytes fetched.
3. Their bytes are sorted into a Burrows-Wheeler transform, whole minimiser groups
   at a time.  Breadth-first backward extension of its intervals sets the
   boundaries between neighbouring suffixes in the order of their common prefix,
   1, 2, 3, ..., and stops at ``length``: boundaries that are still open join windows
   that are equal.
4. Groups of more than ``GROUP`` different runs are counted window by window by
   hash instead, which combines before the shuffle and needs no group in one place.

Edge cases: a null text is empty; texts shorter than ``length`` keep all bytes;
overlapping copies in one text count; removal can cut a character in two, and
``kept_sha256`` is over the bytes left; repeated rows are copies of each other; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm.common import hot_join, ship, stage

LENGTH = 400
SEED = 128                 # bytes of a minimiser; a power of two
BATCH = 1 << 20            # bytes sorted at once, whole groups
GROUP = 8192
BROADCAST_ITEMS = 500_000
_PIECE = 1 << 21
_P = np.uint64(0x9E3779B97F4A7C15)
_EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def _seeds(raw: np.ndarray, seed: int) -> np.ndarray:
    """Hash of the ``seed`` bytes from each position, by doubling."""
    h, width = raw.astype(np.uint64) + np.uint64(1), 1
    while width < seed:
        h = _mix(h[:-width] * _P + h[width:])
        width *= 2
    return h


def _window_min(h: np.ndarray, width: int) -> np.ndarray:
    n = len(h) - width + 1
    x = np.concatenate([h, np.full(-len(h) % width, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    before = np.minimum.accumulate(x, axis=1).ravel()
    after = np.minimum.accumulate(x[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:n], before[width - 1:width - 1 + n])


def runs(raw: bytes, length: int = LENGTH, seed: int = SEED):
    """Yield (minimiser, first window, last window) over a whole text, in pieces."""
    for at in range(0, len(raw) - length + 1, _PIECE):
        part = np.frombuffer(raw, np.uint8, min(_PIECE + length - 1, len(raw) - at), at)
        h = _seeds(part, seed)
        least = _window_min(h, length - seed + 1)
        # A new run where the value changes, or where the window has left its leftmost place.
        starts = np.flatnonzero(np.concatenate([[True], (least[1:] != least[:-1]) | (h[:len(least) - 1] == least[:-1])]))
        ends = np.append(starts[1:], len(least)) - 1
        yield from zip((least[starts].astype(np.int64)).tolist(), (starts + at).tolist(), (ends + at).tolist())


def open_boundaries(segments: list[bytes], length: int) -> np.ndarray:
    """Whether the ``length`` bytes from each position occur at another one too.

    Positions are those of the segments laid end to end with one separator after each.
    """
    n = sum(map(len, segments)) + len(segments)
    text = np.zeros(n, np.int16)                            # 0 separates, a byte is 1 to 256
    at = 0
    for s in segments:
        text[at:at + len(s)] = np.frombuffer(s, np.uint8)
        text[at:at + len(s)] += 1
        at += len(s) + 1
    packed = np.zeros(n, np.int64)                          # seven symbols
    for j in range(7):
        packed <<= 9
        packed[:n - j] |= text[j:]
    place_of = np.int32 if n < 1 << 31 else np.int64        # places take most of the memory
    order = np.argsort(packed, kind="stable").astype(place_of)
    key, depth = packed[order], 7
    while True:
        rank = np.empty(n, place_of)
        rank[order] = np.concatenate([[0], np.cumsum(key[1:] != key[:-1], dtype=place_of)])
        if depth >= length or rank[order[-1]] == n - 1:
            break
        key = rank.astype(np.int64)
        key *= n + 2
        key[:n - depth] += rank[depth:]
        key[:n - depth] += 1
        del rank
        order = np.argsort(key, kind="stable").astype(place_of)
        key, depth = key[order], depth * 2
    del key, rank
    bwt = text[order - 1]
    lf = np.empty(n, place_of)
    lf[np.argsort(bwt.view(np.uint16), kind="stable")] = np.arange(n, dtype=place_of)

    # Common prefixes of up to six symbols show in the packed ones.
    known = np.zeros(n + 1, bool)
    known[[0, n]] = True
    key = packed[order]
    del packed
    for d in range(1, 8):
        differs = np.flatnonzero((key[1:] >> (63 - 9 * d)) != (key[:-1] >> (63 - 9 * d))) + 1
        newest = differs[~known[differs]]
        known[newest] = True
    # Intervals of seven symbols whose right boundary is as new as can be.
    edge = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1, [n]])
    right = np.isin(edge[1:], newest) if len(newest) else np.zeros(len(edge) - 1, bool)
    low, high = edge[:-1][right], edge[1:][right]
    del key, edge, right
    for _ in range(7, length):
        if not len(low):
            break
        size = high - low
        first = np.cumsum(size) - size
        owner = np.repeat(np.arange(len(low), dtype=place_of), size)
        place = np.arange(size.sum(), dtype=place_of) - np.repeat((first - low).astype(place_of), size)
        symbol = bwt[place]
        inside = symbol > 0
        owner, place, symbol = owner[inside], place[inside], symbol[inside]
        if not len(place):
            break
        key = owner.astype(np.int64) * 257 + symbol
        by = np.argsort(key, kind="stable")
        key, place = key[by], place[by]
        turn = np.flatnonzero(key[1:] != key[:-1]) + 1
        low = lf[place[np.concatenate([[0], turn])]]
        high = lf[place[np.concatenate([turn, [len(place)]]) - 1]] + 1
        new = ~known[high]
        low, high = low[new], high[new]
        known[high] = True
    still = np.flatnonzero(~known)
    repeated = np.zeros(n, bool)
    repeated[order[still]] = True
    repeated[order[still - 1]] = True
    return repeated


def _stretches(hit: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


def _runs(length: int, seed: int):
    def run(batches):
        for pdf in batches:
            out = []
            for tid, text in zip(pdf["tid"], pdf["text"]):
                raw = text.encode("utf-8", "replace")
                out += [(a, tid, lo, hi, xxhash.xxh3_64_intdigest(raw[lo:hi + length]) - (1 << 63))
                        for a, lo, hi in runs(raw, length, seed)]
                if len(out) >= 20_000:
                    yield pd.DataFrame(out, columns=["anchor", "tid", "lo", "hi", "seg"])
                    out = []
            yield pd.DataFrame(out, columns=["anchor", "tid", "lo", "hi", "seg"])
    return run


def _fetch(length: int):
    def run(batches):
        for pdf in batches:
            out, size = [], 0
            for tid, text, wanted in zip(pdf["tid"], pdf["text"], pdf["wanted"]):
                raw = text.encode("utf-8", "replace")
                for w in wanted:
                    out.append((w["anchor"], w["m"], w["big"], tid, w["lo"], w["hi"], raw[w["lo"]:w["hi"] + length]))
                    size += len(out[-1][-1])
                    if size >= _PIECE:
                        yield pd.DataFrame(out, columns=["anchor", "m", "big", "tid", "lo", "hi", "raw"])
                        out, size = [], 0
            yield pd.DataFrame(out, columns=["anchor", "m", "big", "tid", "lo", "hi", "raw"])
    return run


def _expand(length: int):
    def marks(rows: list[tuple]) -> pd.DataFrame:
        hit, out, at = open_boundaries([r[5] for r in rows], length), [], 0
        for _, m, tid, lo, hi, raw in rows:
            if m == 1:
                out += [(tid, lo + a, lo + b - 1) for a, b in _stretches(hit[at:at + hi - lo + 1])]
            at += len(raw) + 1
        return pd.DataFrame(out, columns=["tid", "lo", "hi"])

    def run(batches):
        rows, size = [], 0
        for pdf in batches:
            for row in zip(*(pdf[c] for c in ("anchor", "m", "tid", "lo", "hi", "raw"))):
                if size >= BATCH and row[0] != rows[-1][0]:
                    yield marks(rows)
                    rows, size = [], 0
                rows.append(row)
                size += len(row[5])
        if rows:
            yield marks(rows)
    return run


def _windows(length: int):
    def run(batches):
        for pdf in batches:
            out = []
            for anchor, m, tid, lo, hi, raw in zip(*(pdf[c] for c in ("anchor", "m", "tid", "lo", "hi", "raw"))):
                out += [(anchor, xxhash.xxh3_64_intdigest(raw[i:i + length]) - (1 << 63), m, tid, lo + i)
                        for i in range(hi - lo + 1)]
            yield pd.DataFrame(out, columns=["anchor", "h", "m", "tid", "lo"])
    return run


def _cover(length: int):
    def run(batches):
        for pdf in batches:
            out = []
            for key, text, marks in zip(pdf["key"], pdf["text"], pdf["marks"]):
                raw = text.encode("utf-8", "replace")
                spans, kept, at = 0, hashlib.sha256(), 0
                left, end = 0, -1
                for lo, hi in sorted((m["lo"], m["hi"]) for m in marks):
                    if lo > end:                            # a new span; touching ones are one run
                        spans += 1
                        kept.update(raw[at:lo])
                        left += lo - at
                    end = max(end, hi + length)
                    at = end
                kept.update(raw[at:])
                left += len(raw) - at
                out.append((key, len(raw) - left, spans, kept.hexdigest()))
            yield pd.DataFrame(out, columns=["key", "n_removed", "n_spans", "kept_sha256"])
    return run


def _sided(df: DataFrame, items: str) -> DataFrame:
    """``df`` for a join, broadcast when its arrays ``items`` hold few entries (of under 64 bytes) in all."""
    entries = df.agg(F.sum(F.size(items) + 1)).first()[0] or 0
    return F.broadcast(df) if entries <= BROADCAST_ITEMS else df


def _merged(found: DataFrame, length: int) -> DataFrame:
    """Per text the stretches of window starts whose bytes overlap or touch, as one array."""
    order = Window.partitionBy("tid").orderBy("lo")
    before = F.max("hi").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(F.col("lo") <= before + length, 0).otherwise(1)
    one = found.groupBy("tid", "lo").agg(F.max("hi").alias("hi"))
    return (one.withColumn("span", fresh).withColumn("span", F.sum("span").over(order))
            .groupBy("tid", "span").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
            .groupBy("tid").agg(F.collect_list(F.struct("lo", "hi")).alias("marks")))


def strip_repeats(docs: DataFrame, length: int = LENGTH, seed: int = SEED, group: int = GROUP,
                  doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every document."""
    ship(docs.sparkSession)
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    keyed = docs.withColumn("key", F.sha2("text", 256))
    texts = stage(keyed.groupBy("key").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))
                  .withColumn("n_bytes", F.octet_length("text").cast("long"))
                  .withColumn("tid", F.monotonically_increasing_id()), "texts")
    found = repeats(texts, length, seed, group)
    marked = stage(_merged(found, length), "marks")
    single = texts.where((F.col("copies") == 1) & (F.col("n_bytes") >= length))
    cut = stage(single.select("tid", "key", "text").join(_sided(marked, "marks"), "tid").select("key", "text", "marks").mapInPandas(
        _cover(length), "key string, n_removed long, n_spans long, kept_sha256 string"), "cut")
    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    judged = texts.select("key", "copies", "n_bytes").join(cut, "key", "left").select(
        "key", "copies", "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, F.lit(_EMPTY_SHA)).otherwise(F.coalesce("kept_sha256", "key")).alias("kept_sha256"))
    rows = stage(keyed.select("doc_id", "key"), "keys")
    return hot_join(rows, stage(judged, "judged"), "key", "copies", rows.count()).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def repeats(texts: DataFrame, length: int = LENGTH, seed: int = SEED, group: int = GROUP) -> DataFrame:
    """``tid, lo, hi``: first and last starts of windows that occur elsewhere, for distinct texts ``tid, text``.

    Windows of texts given with ``copies > 1`` repeat anyway and are left out unless another text has them.
    """
    long = texts.where(F.octet_length("text") >= length).select("tid", "text")
    found = stage(long.mapInPandas(_runs(length, seed), "anchor long, tid long, lo int, hi int, seg long"), "runs")
    groups = stage(found.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("n"), F.min("seg").alias("a"), F.max("seg").alias("b")).where("n > 1")
        .select("anchor", "n", (F.col("a") != F.col("b")).alias("mixed")), "anchors")
    hits = stage(hot_join(found, groups, "anchor", "n", found.count()).drop("n"), "hits")
    kinds = stage(hits.where("mixed").groupBy("anchor", "seg").agg(
        F.count(F.lit(1)).alias("m"), F.min(F.struct("tid", "lo", "hi")).alias("one")), "kinds")

    # Runs that repeat as a whole.
    alike = hits.where("not mixed").select("tid", "lo", "hi")
    several = kinds.where("m > 1").select(F.xxhash64("anchor", "seg").alias("pair"), "anchor", "seg", "m")
    several = several.groupBy("pair").agg(F.sum("m").alias("m"))
    some = hot_join(hits.where("mixed").withColumn("pair", F.xxhash64("anchor", "seg")), several, "pair", "m",
                    hits.count()).select("tid", "lo", "hi")

    # One of each kind of the rest, with its bytes.
    sizes = kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("k"))
    wanted = hot_join(kinds, sizes, "anchor", "k", kinds.count()).select(
        F.col("one.tid").alias("tid"), F.struct(
            "anchor", "m", (F.col("k") > group).alias("big"), F.col("one.lo").alias("lo"), F.col("one.hi").alias("hi")).alias("w"))
    wanted = stage(wanted.groupBy("tid").agg(F.collect_list("w").alias("wanted")), "wanted")
    pieces = stage(long.join(_sided(wanted, "wanted"), "tid").select("tid", "text", "wanted").mapInPandas(
        _fetch(length), "anchor long, m long, big boolean, tid long, lo int, hi int, raw binary"), "pieces")
    sorted_ = pieces.where("not big").drop("big").repartition("anchor").sortWithinPartitions("anchor")
    expanded = sorted_.mapInPandas(_expand(length), "tid long, lo int, hi int")

    windows = stage(pieces.where("big").mapInPandas(_windows(length), "anchor long, h long, m long, tid long, lo int"), "windows")
    twice = windows.groupBy("anchor", "h").agg(F.count(F.lit(1)).alias("c"), F.sum("m").alias("all")).where("all > 1")
    twice = twice.select(F.xxhash64("anchor", "h").alias("pair"), "c").groupBy("pair").agg(F.sum("c").alias("c"))
    counted = hot_join(windows.withColumn("pair", F.xxhash64("anchor", "h")), twice, "pair", "c", windows.count()).where(
        "m = 1").select("tid", "lo", F.col("lo").alias("hi"))
    return alike.unionByName(some).unionByName(stage(expanded, "expanded")).unionByName(counted)
