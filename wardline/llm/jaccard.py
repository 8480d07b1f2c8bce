"""N-gram Jaccard join (operator 12): a metric-space join by pivots.

``1 - J`` of shingle sets is a metric, so distances to pivots bound distances
between documents.  Far from all pivots they say nothing, as nearly all pairs
of documents are at distance 1; pivots are therefore found where documents can be
near at all, and regions are cut from there.

1. *Nodes.*  Documents of equal sets are one node.
2. *Pivots.*  If two sets link, at most ``k`` shingles are in one of them only, ``k`` a
   function of the smaller size.  The hash range is cut into more than ``k`` classes,
   so some class holds the same shingles of both, and its content is a key.  Sets with
   too many empty classes also give single shingles as keys (a prefix of
   ``n - ceil(t n) + 1``), as two such sets may agree in empty classes only.  The pivot of a
   key is the holder that shares most; a region is a pivot with all holders of
   its keys.  Linked nodes share a key, hence a region.
3. *Voronoi regions.*  A large region takes pivots of its own.  Each member goes to
   its nearest pivot, its home, and is replicated to every pivot within
   ``d(home) + 2 (1 - t)``: a linked pair always meets in the home of either.  Regions are
   cut again and again, over the cluster while they are larger than a task
   should hold, in the task below that, until they are small or the windows
   keep nearly everything together.  What is then still large (documents all near each
   other) is joined block by block.
4. *Join.*  Small regions compare full sets exactly.  A pair found in several places counts
   once: in the first common region, and there in the home of the lower node.

So every pair at the threshold is found and counted once; no pair is written, a region
returns counts of links and a star of links per group.

Edge cases: null text, or text without words, is the empty set: size 0, linked with
nothing; fewer words than a shingle are one shingle, the whole sequence; letters
other than A-Z keep their case; rows of one id with different texts are nodes of
their own; repeated rows link like other equal texts; a null id never names a
component that has another id; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from functools import lru_cache, reduce
from math import isqrt

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm.common import HOT_SHARE, by_group, hot_join, ship, stage
from wardline.llm.neardup import _mix, components, shingles
from wardline.operators.joins import key_table

SHINGLE = 4
THRESHOLD = 85             # percent
LIMIT = 1024               # members that a task joins at once ...
LIMIT_ITEMS = 1 << 22      # ... and shingles of these
PIVOTS = 16                # of a region cut over the cluster
INNER, INNER_PIVOTS = 64, 8    # the same within a task
BINS = 64                  # of the counts that tell far sets apart
LEAST_HOT = 8              # documents of a batch that make a key a candidate for a hot one
GAIN = 0.5                 # share of the pairs that a cut must save to be made
_SLOPE = 1e-9              # windows are this much wider than rounding can need
_COLUMNS = 2048


# ---------------------------------------------------------------- keys

def _differ(n: int, threshold: int) -> int:
    """Most shingles in one set only, of a linked pair whose smaller set has ``n``."""
    return (100 - threshold) * (n + 100 * n // threshold) // (100 + threshold)


def _needed(n: int, threshold: int) -> tuple[int, int]:
    """Classes that a pair with smaller size ``n`` looks at, and how many may be empty."""
    k = _differ(n, threshold)
    slack = 1 + k // 16
    return k + 1 + slack, slack


def _tag(n: int) -> int:
    """Sizes of one tag share their classes; a tag spans half an octave."""
    octave = n.bit_length() - 1
    return 2 * octave + (n > _top(2 * octave))


def _top(tag: int) -> int:
    """The largest size of a tag."""
    octave = tag // 2
    return (1 << (octave + 1)) - 1 if tag % 2 else isqrt((1 << (2 * octave + 1)) - 1)


@lru_cache(maxsize=256)
def _bounds(tag: int, threshold: int) -> np.ndarray:
    """Lowest hash of each class of a tag, and of none."""
    classes = _needed(_top(tag), threshold)[0]
    return np.array([(j << 64) // classes for j in range(classes)], np.uint64)


def keys(items: np.ndarray, threshold: int = THRESHOLD) -> np.ndarray:
    """Keys of a sorted set; linked different sets share one."""
    n = len(items)
    least = -(-threshold * n // 100)                   # the smallest set that it links with
    out, weak = [], False
    for tag in range(_tag(least), _tag(n) + 1) if n else ():
        low, high = max(least, _top(tag - 1) + 1), min(n, _top(tag))       # smaller sizes of its pairs
        if low > high or not _differ(high, threshold):
            continue                                   # links equal sets only
        bounds = _bounds(tag, threshold)
        take = _needed(high, threshold)[0]
        edge = np.append(np.searchsorted(items, bounds[:take + 1]), [n] if take == len(bounds) else []).astype(np.int64)
        full = np.flatnonzero(edge[1:] > edge[:-1])
        weak |= take - len(full) > _needed(low, threshold)[1]
        if len(full):
            content = np.add.reduceat(_mix(items[:edge[-1]]), edge[full])
            out.append(_mix(content + _mix(full.astype(np.uint64) + np.uint64(tag << 32))))
    if weak:
        out.append(_mix(items[:n - least + 1] ^ np.uint64(0x5BD1E995A7C31F2D)))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _counts(items: np.ndarray) -> bytes:
    """Shingles by hash, in ``BINS`` bins: as far apart as the sets at most."""
    return np.minimum(np.bincount((items & np.uint64(BINS - 1)).astype(np.int64), minlength=BINS), 65535).astype("<u2").tobytes()


def _sketch(k: int, threshold: int):
    """A row per document; after each batch a row (``n`` = -1) of the keys that many of its documents have."""
    names = ["rid", "n", "node", "bins", "keys"]

    def run(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            out = []
            for rid, text in zip(pdf["rid"], pdf["text"]):
                items = shingles(text, k)
                full = len(items) > 0
                out.append((rid, len(items), xxhash.xxh3_128_digest(items.tobytes()) if full else None, _counts(items) if full else None,
                            keys(items, threshold).view(np.int64)))
            key, times = np.unique(np.concatenate([o[4] for o in out]), return_counts=True)
            often = key[times >= max(len(out) // HOT_SHARE, LEAST_HOT)]
            # Ids as text: a null would turn the numbers of its batch into floats.
            yield pd.DataFrame(out, columns=names).assign(rk=pdf["rk"], doc_id=pdf["doc_id"])
            yield pd.DataFrame([(-1, -1, None, None, often)], columns=names).assign(rk=0, doc_id=None)
    return run


# ---------------------------------------------------------------- regions

def _parts(column) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    parts = [np.frombuffer(b, np.uint64) for b in column]
    size = np.array([len(p) for p in parts], np.int64)
    return np.concatenate(parts), size, parts


def _distances(flat: np.ndarray, size: np.ndarray, pivots: list[np.ndarray]) -> np.ndarray:
    """Jaccard distances of the sets laid end to end in ``flat`` to each pivot."""
    starts = np.concatenate([[0], np.cumsum(size)[:-1]])
    out = np.empty((len(size), len(pivots)))
    for j, p in enumerate(pivots):
        at = np.minimum(np.searchsorted(p, flat), len(p) - 1)
        both = np.add.reduceat((p[at] == flat).astype(np.int64), starts)
        out[:, j] = 1 - both / (size + len(p) - both)
    return out


def _windows(distance: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Home of each member, and the regions that it is in."""
    home = distance.argmin(axis=1)
    reach = distance.min(axis=1) + 2 * (1 - threshold / 100) + _SLOPE
    return home, distance <= reach[:, None]


def _near(parts: list[np.ndarray], size: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs ``i < j`` at the threshold, by exact intersections."""
    _, column, times = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
    shared = times > 1                                  # others meet nobody
    place = np.cumsum(shared) - 1
    row = np.repeat(np.arange(len(size)), size)
    row, column = row[shared[column]], place[column[shared[column]]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    # Whole numbers below 2**24 are exact in single precision.
    kind = np.float32 if int(size.max()) < 1 << 24 else np.float64
    both = np.zeros((len(size), len(size)), kind)
    for at in range(0, int(shared.sum()), _COLUMNS):
        a, b = np.searchsorted(column, (at, at + _COLUMNS))
        m = np.zeros((len(size), _COLUMNS), kind)
        m[row[a:b], column[a:b] - at] = 1
        both += m @ m.T
    whole = both.astype(np.int64)
    return np.nonzero(np.triu((100 + threshold) * whole >= threshold * (size[:, None] + size[None, :]), 1))


def _pairs(parts: list[np.ndarray], size: np.ndarray, home: np.ndarray, threshold: int, depth: int = 0):
    """Linked index pairs ``i < j`` whose ``i`` is at home here; the region is cut while that saves work."""
    m = len(parts)
    if m > INNER:
        rank = _mix(np.arange(m, dtype=np.uint64) + np.uint64((depth + 1) << 40))
        pivots = np.sort(np.argsort(rank)[:INNER_PIVOTS])
        nearest, within = _windows(_distances(np.concatenate(parts), size, [parts[p] for p in pivots]), threshold)
        if (within.sum(axis=0).astype(float) ** 2).sum() <= GAIN * m * m:
            found = []
            for q in range(len(pivots)):
                at = np.flatnonzero(within[:, q])
                if len(at) > 1:
                    i, j = _pairs([parts[x] for x in at], size[at], home[at] & (nearest[at] == q), threshold, depth + 1)
                    found.append((at[i], at[j]))
            return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 2
    i, j = _near(parts, size, threshold)
    return i[home[i]], j[home[i]]


def _first_here(i, j, regions, root: int) -> np.ndarray:
    """Which pairs have no common region before ``root``."""
    before = [[r for r in own if r < root] for own in regions]
    ids = {r: c for c, r in enumerate(sorted({r for own in before for r in own}))}
    if not ids:
        return np.ones(len(i), bool)
    member = np.zeros((len(before), len(ids)), bool)
    for row, own in enumerate(before):
        member[row, [ids[r] for r in own]] = True
    step = max(1, (1 << 24) // len(ids))
    return ~np.concatenate([np.zeros(0, bool)] + [(member[i[a:a + step]] & member[j[a:a + step]]).any(axis=1)
                                                 for a in range(0, len(i), step)])


def _joined(threshold: int):
    """Links of one region, or of two blocks of it: counts by node and a star of edges per group."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("nid", ignore_index=True)
        nid, copies = pdf["nid"].to_numpy(), pdf["copies"].to_numpy()
        _, size, parts = _parts(pdf["items"])
        i, j = _pairs(parts, size, pdf["home"].to_numpy(bool), threshold)
        across = pdf["i"].iat[0] != pdf["j"].iat[0]
        if across:
            own = pdf["own"].to_numpy()
            apart = own[i] != own[j]
            i, j = i[apart], j[apart]
        first = _first_here(i, j, pdf["regions"].tolist(), int(pdf["root"].iat[0]))
        i, j = i[first], j[first]
        links = np.zeros(len(nid), np.int64)
        np.add.at(links, i, copies[j])
        np.add.at(links, j, copies[i])
        label = np.arange(len(nid))
        while True:
            low = np.minimum(label[i], label[j])
            new = label.copy()
            np.minimum.at(new, i, low)
            np.minimum.at(new, j, low)
            new = new[new]
            if (new == label).all():
                break
            label = new
        linked = np.flatnonzero(links)
        return pd.DataFrame({"u": nid[linked], "v": nid[label[linked]], "links": links[linked]})
    return run


def _possible(threshold: int):
    """Members of a region with a partner that the counts do not rule out."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        bins = np.frombuffer(b"".join(pdf["bins"]), "<u2").reshape(len(pdf), BINS).astype(np.int32)
        n = pdf["n"].to_numpy()
        hit = np.zeros(len(pdf), bool)
        for a in range(len(pdf) - 1):
            apart = np.abs(bins[a + 1:] - bins[a]).sum(axis=1)
            close = (100 + threshold) * apart <= (100 - threshold) * (n[a + 1:] + n[a])
            hit[a] |= close.any()
            hit[a + 1:] |= close
        return pdf.loc[hit, ["region", "nid", "n"]]
    return run


def _assigned(threshold: int):
    """Homes and windows of the members of one block of a region, by the region's pivots."""
    names = ["region", "root", "nid", "n", "home", "child"]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pivots = pdf[pdf["pivot"]].sort_values("nid")
        pdf = pdf[~pdf["pivot"]]
        if not len(pdf):
            return pd.DataFrame({c: [] for c in names})
        flat, size, _ = _parts(pdf["items"])
        home, within = _windows(_distances(flat, size, _parts(pivots["items"])[2]), threshold)
        row, q = np.nonzero(within)
        out = pdf[names[:5]].iloc[row]
        return out.assign(home=out["home"].to_numpy(bool) & (home[row] == q), child=pivots["nid"].to_numpy()[q])
    return run


def _sized(regions: DataFrame) -> DataFrame:
    """The region rows with ``members`` and ``blocks`` (tasks' worth) of their region."""
    blocks = F.greatest(F.ceil(F.col("members") / F.lit(LIMIT)), F.ceil(F.col("weight") / F.lit(LIMIT_ITEMS))).cast("int")
    sizes = (regions.groupBy("region").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("weight"))
             .select("region", "members", blocks.alias("blocks")))
    return stage(hot_join(regions, sizes, "region", "members", regions.count()), "jaccard-regions")


def _own_block():
    return F.pmod(F.xxhash64("nid"), F.col("blocks")).cast("int")


def _every_block():
    return F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))


def _cut(large: DataFrame, sets: DataFrame, level: int, threshold: int) -> DataFrame:
    """``region, root, nid, n, home, child``: members of large regions by their pivots' windows."""
    rank = F.row_number().over(Window.partitionBy("region").orderBy(F.xxhash64("nid", "region", F.lit(level)), "nid"))
    pivots = (large.withColumn("_rank", rank).where(F.col("_rank") <= PIVOTS)
              .withColumn("block", _every_block()).withColumn("pivot", F.lit(True)).drop("_rank"))
    rows = large.withColumn("block", _own_block()).withColumn("pivot", F.lit(False))
    return by_group(rows.unionByName(pivots).join(sets.select("nid", "items"), "nid"), ["region", "block"], _assigned(threshold),
                    "region long, root long, nid long, n long, home boolean, child long")


def _links(regions: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """``u, v, links``: parts of the nodes' link counts, and edges that connect what is linked."""
    part = lambda r, i, j, own: r.select(
        "region", "root", "nid", "home", i.cast("int").alias("i"), j.cast("int").alias("j"), own.cast("int").alias("own"))
    zero, ready, level = F.lit(0), [], 0
    while True:
        regions = _sized(regions)
        ready.append(part(regions.where("blocks = 1"), zero, zero, zero))
        large = regions.where("blocks > 1")
        if large.isEmpty():
            break
        cut = stage(_cut(large, sets, level, threshold), "jaccard-cut")
        # A cut is made where it saves work, in pairs held.
        child = cut.groupBy("region", "child").agg(F.count(F.lit(1)).cast("double").alias("m"))
        sizes = large.groupBy("region").agg(F.max("members").alias("members"))
        good = stage(child.groupBy("region").agg(F.sum(F.col("m") * F.col("m")).alias("work")).join(sizes, "region")
                     .where(F.col("work") <= F.lit(GAIN) * F.col("members") * F.col("members")).select("region"), "jaccard-good")
        good, _ = key_table(good, "region")
        dense = large.join(good, "region", "left_anti").withColumn("own", _own_block()).withColumn("other", _every_block())
        ready.append(part(dense, F.least("own", "other"), F.greatest("own", "other"), F.col("own")))
        regions = cut.join(good, "region", "left_semi").select(
            F.xxhash64("region", "child").alias("region"), "root", "nid", "n", "home")
        level += 1
    whole = reduce(DataFrame.unionByName, ready).join(sets, "nid")
    return stage(by_group(whole, ["region", "i", "j"], _joined(threshold), "u long, v long, links long"), "jaccard-links")


def join(docs: DataFrame, k: int = SHINGLE, threshold: int = THRESHOLD, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, n_links`` of every document.

    ``n_links`` counts the other rows that it links with, those of the same set included.
    """
    ship(docs.sparkSession)
    body = F.coalesce(F.col(text), F.lit(""))
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), body.alias("text")).withColumn("rk", F.xxhash64("doc_id", "text"))
    rows = stage(docs.withColumn("rid", F.monotonically_increasing_id()).withColumn("doc_id", F.col("doc_id").cast("string"))
                 .mapInPandas(_sketch(k, threshold), "rid long, n long, node binary, bins binary, keys array<long>, rk long, doc_id string")
                 .withColumn("doc_id", F.col("doc_id").cast("long")), "jaccard-rows")
    full, n_rows = rows.where("n > 0"), rows.where("n >= 0").count()
    nodes = stage(full.groupBy("node").agg(
        F.min("rid").alias("nid"), F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"), F.max("n").alias("n"),
        F.min_by("rk", "rid").alias("rk")), "jaccard-nodes")

    # Keys with company; copies of a node leave first.  A key that a large share of all documents
    # has is one of some batch too, so hot keys, at most HOT_SHARE times the keys of a document,
    # are known before any row moves; rows of the others move once.
    copies = hot_join(full.select("rid", "node"), nodes.where("copies > 1").select("node", "nid", "copies"), "node", "copies", n_rows)
    extra, _ = key_table(stage(copies.where("rid != nid").select("rid"), "jaccard-copies"), "rid")
    each = full.select("rid", "keys").join(extra, "rid", "left_anti").select(F.col("rid").alias("nid"), F.explode("keys").alias("key"))
    often = stage(rows.where("n = -1").select(F.explode("keys").alias("key")).distinct(), "jaccard-often")
    often, small = key_table(often, "key")
    hot = each.join(often, "key", "left_semi").groupBy("key").agg(F.count(F.lit(1)).alias("holders")) if small else None
    if hot is not None:
        hot = F.broadcast(stage(hot.where(F.col("holders") > max(n_rows // HOT_SHARE, 1)), "jaccard-hot"))
        cold, hot = each.join(hot.select("key"), "key", "left_anti"), each.join(hot, "key")
    else:
        cold, hot = each, each.withColumn("holders", F.lit(0).cast("long")).where(F.lit(False))
    company = F.count(F.lit(1)).over(Window.partitionBy("key"))
    held = stage(cold.withColumn("holders", company).where("holders > 1").unionByName(hot), "jaccard-held")
    total = held.count()

    # The pivot of a key is the holder that shares most; its region are all holders.
    rank = held.groupBy("nid").agg(F.sum("holders").alias("rank"))
    pivots = (held.join(rank, "nid").groupBy("key").agg(F.max(F.struct("rank", "nid")).alias("top"), F.max("holders").alias("holders"))
              .select("key", "holders", F.col("top.nid").alias("region")))
    regions = stage(hot_join(held.select("key", "nid"), pivots, "key", "holders", total).select("region", "nid").distinct(), "jaccard-first")

    # Members that cannot link with anybody leave; regions of more than a task's worth keep theirs.
    counted = regions.join(rows.select(F.col("rid").alias("nid"), "n", "bins"), "nid")
    sizes = regions.groupBy("region").agg(F.count(F.lit(1)).alias("members"))
    sized = stage(hot_join(counted, sizes, "region", "members", regions.count()), "jaccard-sized")
    regions = stage(by_group(sized.where(F.col("members") <= LIMIT), ["region"], _possible(threshold), "region long, nid long, n long")
                    .unionByName(sized.where(F.col("members") > LIMIT).select("region", "nid", "n")), "jaccard-possible")

    # The sets of the others, made again from one text each.
    own = regions.groupBy("nid").agg(F.sort_array(F.collect_list("region")).alias("regions"))
    want = stage(nodes.join(own, "nid").select("nid", "n", "copies", "regions", "rk", "node"), "jaccard-wanted")
    wanted, _ = key_table(want, "rk", "nid", "node")

    def remade(batches):
        for pdf in batches:
            out = [(nid, node, shingles(t, k).tobytes()) for nid, node, t in zip(pdf["nid"], pdf["node"], pdf["text"])]
            yield pd.DataFrame([(nid, items) for nid, node, items in out if xxhash.xxh3_128_digest(items) == bytes(node)],
                               columns=["nid", "items"])

    items = stage(docs.select("rk", "text").join(wanted, "rk").select("nid", "node", "text")
                  .mapInPandas(remade, "nid long, items binary").dropDuplicates(["nid"]), "jaccard-items")
    sets = items.join(want.select("nid", "copies", "regions"), "nid")
    regions = regions.select("region", F.col("region").alias("root"), "nid", "n", F.lit(True).alias("home"))
    links = _links(regions, sets, threshold)

    labels = components(links.where("u != v").select("u", "v")).withColumnRenamed("node", "nid")
    counts = links.groupBy(F.col("u").alias("nid")).agg(F.sum("links").alias("links"))
    named = stage(nodes.join(labels, "nid", "left").join(counts, "nid", "left").select(
        "node", "doc_id", "copies", F.coalesce("label", "nid").alias("label"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "jaccard-named")
    least = named.groupBy("label").agg(F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("members"))
    owner = hot_join(named, least, "label", "members", n_rows).select("node", "copies", "component_id", "n_links")
    linked = hot_join(full.select("doc_id", "n", "node"), owner, "node", "copies", n_rows)
    alone = rows.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"), F.lit(0).cast("long").alias("n_links"))
    return linked.select("doc_id", "n", "component_id", "n_links").unionByName(alone).withColumnRenamed("n", "n_shingles")
