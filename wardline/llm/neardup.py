"""MinHash near-dedup (operator 5): SetSketch registers.

A document is its set of distinct word shingles.  Register ``i`` of its sketch
is ``floor(1 - log_b(min h_i))`` over exponential hashes of the set, truncated
to ``0..Q+1``: mergeable by maximum, and two sketches agree in a register with
about the probability of their Jaccard similarity.

1. Equal sets are one node.  ``BANDS`` keys of ``ROWS`` registers put nodes in buckets.
2. Each bucket compares its members with its centre, the member that shares
   most buckets with others.  The similarity of a pair is estimated jointly with
   its sizes by maximum likelihood; pairs far below the threshold go, all others
   are verified on their full sets.
3. Verified links make components.  Members of one centre that are still apart
   meet block by block: registers tell which of them can have a partner, full
   sets decide, and a block returns a spanning forest of its links.  So every pair
   that shares a bucket is tested or already joined, and no group is expanded
   into its pairs.

At a similarity of 0.8 a pair shares no bucket with probability
``(1 - 0.8**ROWS)**BANDS`` (5e-8), and the estimate loses one in a few million.

Edge cases: null text, or text without words, is the empty set: size 0, linked
with nothing; fewer words than a shingle are one shingle, the whole sequence;
letters other than A-Z keep their case; rows of one id with different texts are
nodes of their own; repeated rows share a component; a null id never represents
a component that has another id; an empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import by_group, hot_join, ship, stage

BANDS, ROWS = 32, 4
REGISTERS = BANDS * ROWS
BASE, RATE, Q = 1.001, 20.0, (1 << 16) - 2
SHINGLE = 4
THRESHOLD = 80             # percent
SLACK = 5.0                # standard errors below the threshold at which an estimate rejects
BLOCK = 1024               # members of one centre compared at once with as many others
BROADCAST_ROWS = 1_000_000
_CHUNK = 2048

_rng = np.random.Generator(np.random.Philox(1729))
_A = _rng.integers(0, 1 << 64, REGISTERS, np.uint64) | np.uint64(1)
_B = _rng.integers(0, 1 << 64, REGISTERS, np.uint64)
_STEP = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                  0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9FB21C651E98DF25)
    return h ^ (h >> np.uint64(32))


def shingles(text: str | None, k: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``k``-word shingles of a whole text."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(k, len(h))
    n = len(h) - width + 1
    out = np.full(n, width, np.uint64)
    for i in range(width):
        out = _mix(out * _STEP[i % len(_STEP)] + h[i:i + n])
    return np.unique(out)


def registers(items: np.ndarray) -> np.ndarray:
    """SetSketch registers of a non-empty set of hashes."""
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(items), _CHUNK):
        np.minimum(least, (items[at:at + _CHUNK, None] * _A + _B).min(axis=0), out=least)
    exponential = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0 ** 64) / RATE
    k = np.floor(1.0 - np.log(np.maximum(exponential, 1e-300)) / math.log(BASE))
    return np.clip(k, 0, Q + 1).astype("<u2")


def band_keys(regs: np.ndarray) -> list[int]:
    rows = regs.reshape(BANDS, ROWS)
    return [xxhash.xxh3_64_intdigest(rows[i].tobytes(), seed=i) - (1 << 63) for i in range(BANDS)]


_GRID = np.linspace(0.0, 1.0, 401)


def estimate(u: np.ndarray, v: np.ndarray, nu: np.ndarray, nv: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of sketch pairs, given the set sizes.

    A register of U is larger, smaller or equal with probabilities
    ``p(x - yJ)``, ``p(y - xJ)`` and the rest, where ``x, y`` are the sizes'
    shares and ``p(z) = -log_b(1 - z (b - 1) / b)``.
    """
    more, less = (u > v).sum(axis=1)[:, None], (u < v).sum(axis=1)[:, None]
    same = u.shape[1] - more - less
    x = (nu / (nu + nv))[:, None]
    y = 1.0 - x
    j = _GRID[None, :] * np.minimum(x / y, y / x)
    p = lambda z: -np.log1p(-np.clip(z, 0.0, 1.0) * (BASE - 1) / BASE) / math.log(BASE)
    up, down = p(x - y * j), p(y - x * j)
    log = lambda q: np.log(np.maximum(q, 1e-12))
    fit = more * log(up) + less * log(down) + same * log(1.0 - up - down)
    return np.take_along_axis(j, fit.argmax(axis=1)[:, None], 1)[:, 0]


def _least(threshold: int) -> float:
    t = threshold / 100
    return t - SLACK * math.sqrt(t * (1 - t) / REGISTERS)


def _sketch(k: int):
    def run(batches):
        for pdf in batches:
            out = []
            for doc_id, digest, text in zip(pdf["doc_id"], pdf["digest"], pdf["text"]):
                items = shingles(text, k)
                doc_id = None if pd.isna(doc_id) else int(doc_id)
                if len(items):
                    regs = registers(items)
                    out.append((doc_id, digest, len(items), xxhash.xxh3_128_digest(items.tobytes()), regs.tobytes(), band_keys(regs)))
                else:
                    out.append((doc_id, digest, 0, None, None, None))
            yield pd.DataFrame(out, columns=["doc_id", "digest", "n", "node", "regs", "bands"]).astype({"doc_id": "Int64"})
    return run


def _estimated(threshold: int):
    least = _least(threshold)

    def run(batches):
        for pdf in batches:
            if len(pdf):
                regs = lambda c: np.frombuffer(b"".join(pdf[c]), "<u2").reshape(len(pdf), -1)
                j = np.concatenate([estimate(*(a[i:i + 512] for a in (
                    regs("regs"), regs("c_regs"), pdf["n"].to_numpy(float), pdf["c_n"].to_numpy(float))))
                    for i in range(0, len(pdf), 512)])
                yield pdf.loc[j >= least, ["nid", "centre"]]
    return run


def _linked(a: int, b: int, both, threshold: int):
    return 100 * both >= threshold * (a + b - both)


def _verified(threshold: int, k: int):
    def run(batches):
        centres: dict = {}                                  # sets of the latest centres
        for pdf in batches:
            keep = []
            for x, c, y in zip(pdf["text"], pdf["centre"], pdf["c_text"]):
                if c not in centres:
                    if len(centres) >= 64:
                        centres.clear()
                    centres[c] = shingles(y, k)
                x, y = shingles(x, k), centres[c]
                keep.append(_linked(len(x), len(y), len(np.intersect1d(x, y, assume_unique=True)), threshold))
            yield pdf.loc[np.array(keep, bool), ["nid", "centre"]]
    return run


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every end of ``edges`` (``u, v``); the label is the least node reachable.

    Label propagation with pointer jumping, each round stored.
    """
    both = stage(edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
                 .where("u != v").distinct(), "edges")
    labels = stage(both.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("node"), F.least("u", "m").alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("v"), "label"), "v").groupBy("u").agg(F.min("label").alias("m"))
        step = stage(labels.join(near, labels.node == near.u).select(
            "node", F.col("label").alias("old"), F.least("label", "m").alias("label")), "step")
        jump = step.select(F.col("node").alias("label"), F.col("label").alias("far"))
        new = stage(step.join(jump, "label").select("node", "old", F.least("label", "far").alias("label")), "labels")
        if new.where("label != old").isEmpty():
            return new.select("node", "label")
        labels = new.select("node", "label")


def _texts(docs: DataFrame, nodes: DataFrame, needed: DataFrame, k: int) -> DataFrame:
    """``nid, text``: one text of each needed node.

    Texts travel instead of sets: they are half as large, and their sets are
    made again where they are compared.
    """
    want = stage(nodes.join(needed.select("nid").distinct(), "nid").select(
        F.col("doc_id").alias("_want"), "nid", "node"), "wanted")
    n = want.count()

    def run(batches):
        for pdf in batches:
            # An id can occur with other texts.
            same = [xxhash.xxh3_128_digest(shingles(t, k).tobytes()) == node for node, t in zip(pdf["node"], pdf["text"])]
            yield pdf.loc[np.array(same, bool), ["nid", "text"]]

    found = docs.join(F.broadcast(want) if n <= BROADCAST_ROWS else want, docs.doc_id.eqNullSafe(want._want))
    found = stage(found.select("nid", "node", "text").mapInPandas(run, "nid long, text string"), "texts")
    return found if found.count() == n else found.dropDuplicates(["nid"])


def _blocks(members: DataFrame) -> DataFrame:
    """A row per member and pair of blocks of its centre that it takes part in: ``centre, i, j``."""
    sizes = members.groupBy("centre").agg(F.count(F.lit(1)).alias("size"))
    total = members.count()
    cut = hot_join(members, sizes, "centre", "size", total).withColumn(
        "blocks", F.ceil(F.col("size") / F.lit(BLOCK)).cast("int"))
    own = F.pmod(F.xxhash64("nid"), F.col("blocks")).cast("int")
    return (cut.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
            .drop("size", "blocks", "own", "other"))


def _hopeful(threshold: int):
    least = _least(threshold) * REGISTERS

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        regs = np.frombuffer(b"".join(pdf["regs"]), "<u2").reshape(len(pdf), -1)
        label = pd.factorize(pdf["label"])[0]
        n = pdf["n"].to_numpy()
        hit = np.zeros(len(pdf), bool)
        for a in range(len(pdf)):
            other = (label[a + 1:] != label[a]) & (100 * np.minimum(n[a + 1:], n[a]) >= threshold * np.maximum(n[a + 1:], n[a]))
            at = a + 1 + np.flatnonzero(other)
            if len(at):
                close = at[(regs[at] == regs[a]).sum(axis=1) >= least]
                if len(close):
                    hit[a] = True
                    hit[close] = True
        return pdf.loc[hit, ["centre", "nid"]]
    return run


def _forest(threshold: int, k: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        sets = [shingles(t, k) for t in pdf["text"]]
        nodes, size = pdf["nid"].tolist(), np.array([len(s) for s in sets])
        _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        shared = times > 1                                  # others meet nobody
        place = np.cumsum(shared) - 1
        row = np.repeat(np.arange(len(sets)), size)
        row, column = row[shared[column]], place[column[shared[column]]]
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        # Whole numbers below 2**24 are exact in single precision.
        kind = np.float32 if 2 * (100 + threshold) * int(size.max()) < 1 << 24 else np.float64
        both = np.zeros((len(sets), len(sets)), kind)
        for at in range(0, int(shared.sum()), _CHUNK):
            a, b = np.searchsorted(column, (at, at + _CHUNK))
            m = np.zeros((len(sets), _CHUNK), kind)
            m[row[a:b], column[a:b] - at] = 1
            both += m @ m.T
        least = (size[:, None] + size[None, :]).astype(kind)
        least *= threshold
        both *= 100 + threshold
        near = both >= least
        edges, waiting = [], np.ones(len(sets), bool)
        for start in range(len(sets)):
            if waiting[start]:
                waiting[start] = False
                front = [start]
                while front:
                    x = front.pop()
                    fresh = np.flatnonzero(near[x] & waiting)
                    waiting[fresh] = False
                    edges += [(nodes[x], nodes[y]) for y in fresh.tolist()]
                    front += fresh.tolist()
        return pd.DataFrame(edges, columns=["u", "v"])
    return run


def link(docs: DataFrame, k: int = SHINGLE, threshold: int = THRESHOLD, doc_id: str = "doc_id",
         text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every document.

    ``digest`` (of the text) and ``stays`` follow: ``stays`` marks one text of each component.
    """
    ship(docs.sparkSession)
    body = F.coalesce(F.col(text), F.lit(""))
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), body.alias("text"))
    rows = stage(docs.withColumn("digest", F.sha2("text", 256)).mapInPandas(
        _sketch(k), "doc_id long, digest string, n long, node binary, regs binary, bands array<long>"), "sketches")
    full = rows.where("n > 0")
    nodes = stage(full.groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "digest")).alias("first"),
        F.count(F.lit(1)).alias("size"), F.max("n").alias("n"),
        F.max("regs").alias("regs"), F.first("bands").alias("bands"))
        .withColumn("nid", F.monotonically_increasing_id()), "nodes")

    # Buckets with company, and their centres.
    keys = nodes.select("nid", F.explode("bands").alias("key"))
    buckets = stage(keys.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "buckets")
    total = nodes.count() * BANDS
    members = stage(hot_join(keys, buckets, "key", "size", total), "members")
    rank = members.groupBy("nid").agg(F.sum("size").alias("rank"))
    ranked = stage(members.join(rank, "nid"), "ranked")
    centres = ranked.groupBy("key").agg(F.max(F.struct("rank", "nid")).alias("top"), F.max("size").alias("size")).select(
        "key", "size", F.col("top.nid").alias("centre"))
    stars = stage(hot_join(ranked.select("key", "nid"), centres, "key", "size", total)
                  .select("nid", "centre").distinct().where("nid != centre"), "stars")

    # Pairs of a member and its centre: estimated, then verified.
    sketch = nodes.select("nid", "n", "regs")
    n_stars = stars.count()
    star_sizes = stars.groupBy("centre").agg(F.count(F.lit(1)).alias("size"))
    hubs = star_sizes.join(sketch.select(F.col("nid").alias("centre"), F.col("n").alias("c_n"), F.col("regs").alias("c_regs")), "centre")
    likely = stage(hot_join(stars.join(sketch, "nid"), hubs, "centre", "size", n_stars)
                   .select("nid", "n", "regs", "centre", "c_n", "c_regs")
                   .mapInPandas(_estimated(threshold), "nid long, centre long"), "likely")
    texts = _texts(docs, nodes, likely.select("nid").unionByName(likely.select(F.col("centre").alias("nid"))), k)
    hub_texts = likely.groupBy("centre").agg(F.count(F.lit(1)).alias("size")).join(
        texts.select(F.col("nid").alias("centre"), F.col("text").alias("c_text")), "centre")
    links = stage(hot_join(likely.join(texts, "nid"), hub_texts, "centre", "size", likely.count())
                  .select("nid", "text", "centre", "c_text")
                  .mapInPandas(_verified(threshold, k), "nid long, centre long")
                  .select(F.col("nid").alias("u"), F.col("centre").alias("v")), "links")
    labels = components(links).withColumnRenamed("node", "nid")

    # Members of one centre that are still apart.
    labelled = stage(stars.join(labels, "nid", "left").select("nid", "centre", F.coalesce("label", "nid").alias("label")), "labelled")
    apart = labelled.groupBy("centre").agg(F.min("label").alias("a"), F.max("label").alias("b")).where("a != b").select("centre")
    open_sizes = star_sizes.join(apart, "centre")
    open_members = stage(hot_join(labelled, open_sizes, "centre", "size", n_stars).drop("size"), "open")
    hopeful = stage(by_group(_blocks(open_members.join(sketch, "nid")), ["centre", "i", "j"], _hopeful(threshold),
                             "centre long, nid long").distinct(), "hopeful")
    more_texts = _texts(docs, nodes, hopeful, k)
    more = stage(by_group(_blocks(hopeful.join(more_texts, "nid")), ["centre", "i", "j"], _forest(threshold, k),
                          "u long, v long").distinct(), "more-links")
    labels = components(links.unionByName(more)).withColumnRenamed("node", "nid")

    # Every node's component, by its smallest document.
    named = stage(nodes.select("nid", "node", "doc_id", "first", "size").join(labels, "nid", "left").withColumn(
        "label", F.coalesce("label", "nid")), "named")
    tops = named.groupBy("label").agg(F.min("doc_id").alias("component_id"), F.min("first").alias("top"),
                                      F.count(F.lit(1)).alias("members"))
    owner = hot_join(named.select("node", "size", "label"), tops, "label", "members", total // BANDS).select(
        "node", "size", "component_id", "top")
    found = hot_join(full.select("doc_id", "digest", "n", "node"), owner, "node", "size", rows.count()).select(
        "doc_id", "digest", "n", "component_id",
        (F.col("doc_id").eqNullSafe(F.col("top.doc_id")) & (F.col("digest") == F.col("top.digest"))).alias("stays"))
    alone = rows.where("n = 0").select("doc_id", "digest", "n", F.col("doc_id").alias("component_id"), F.lit(True).alias("stays"))
    return found.unionByName(alone).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "digest", "stays")


def kept_rows(docs: DataFrame, k: int = 5, threshold: int = THRESHOLD, doc_id: str = "doc_id",
              text: str = "text") -> DataFrame:
    """One row of every component, that of the smallest id, with all its columns.

    Rows without words are linked with nothing and all stay; rows that share
    id and text are one row (any of them).
    """
    kept = stage(link(docs, k, threshold, doc_id, text).where("stays").select(
        F.col("doc_id").alias("_wardline_id"), F.col("digest").alias("_wardline_keep")), "kept")
    keep = kept.distinct()
    marked = docs.withColumn("_wardline_digest", F.sha2(F.coalesce(F.col(text), F.lit("")), 256))
    hit = (F.col("_wardline_digest") == F.col("_wardline_keep")) & F.col(doc_id).cast("long").eqNullSafe(F.col("_wardline_id"))
    out = marked.join(keep, hit, "left_semi")
    if kept.count() != keep.count():
        out = out.dropDuplicates([doc_id, "_wardline_digest"])
    return out.drop("_wardline_digest")
