"""Mixing sources to target weights (operator 8): cube-method balanced sampling.

Every source has a target number of words.  A document of a source whose
target is ``f`` times its words is taken ``floor(f)`` times for sure and once
more with probability ``f - floor(f)``.  The cube method turns these
probabilities into 0 or 1 while the source's expected words and documents stay
as they are: three undecided documents at a time move along the null space of
the two balancing equations until one of them is decided.  Blocks of
``BLOCK`` documents fly on their own; the two undecided ones of each block meet
in the next round's blocks, until one block a source is left.  There
a dozen of documents (the landing) get whatever choice is nearest the target.

Edge cases: a null text has no words; documents without words are taken zero
words and count as documents only; a null source is a source of its own, last
in order; repeated rows are units of their own and spread over the blocks; an empty table gives no rows;
extra columns are kept by :func:`mix`.  All coins come from hashes of the seed,
source, block and round, so reruns agree.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm.common import WORD, hot_join, ship, stage

BLOCK = 1024
SHARE, CAP, WEIGHTS = 1.5, 2.0, (3.0, 1.0, 2.0)
SEED = 20240229
# Documents settled with the last two of the flight, by trying every choice.
LANDING = 11


def word_count(text):
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ranked(df: DataFrame, *order) -> DataFrame:
    """``df`` with ``rank`` from 0 in the given order, without a one-task sort."""
    parts = stage(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranked")
    before = parts.groupBy("_part").count().withColumn(
        "_first", F.sum("count").over(Window.orderBy("_part")) - F.col("count"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return (parts.withColumn("_place", place)
            .join(F.broadcast(before.select("_part", "_first")), "_part")
            .withColumn("rank", F.col("_first") + F.col("_place") - 1)
            .drop("_part", "_place", "_first"))


def targets(sources: DataFrame, share: float = SHARE, cap: float = CAP,
            weights: tuple = WEIGHTS) -> DataFrame:
    """Add ``rank, weight, target`` to a row per source (``source, source_size``).

    Sources share ``share`` times all words by weight; one stops at ``cap``
    times its own words and what is over is shared anew.  A source is capped
    when ``cap * words < level * weight``, and the level only rises, so each
    round is one aggregate over the sources.
    """
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    rows = stage(ranked(sources, F.col("source").asc_nulls_last()).withColumn(
        "weight", F.element_at(cycle, (F.col("rank") % len(weights) + 1).cast("int"))), "sources")
    most = F.col("source_size") * F.lit(cap)
    level = 0.0
    while True:
        over = most < F.lit(level) * F.col("weight")
        total, full, open_weight = rows.agg(
            F.sum("source_size"), F.sum(F.when(over, most)), F.sum(F.when(~over, F.col("weight")))).first()
        if not total or not open_weight:
            break
        risen = (share * total - (full or 0.0)) / open_weight
        if risen <= level:
            break
        level = risen
    return rows.withColumn("target", F.least(most, F.lit(level) * F.col("weight")))


def apart(rows: DataFrame) -> DataFrame:
    """Stored ``rows`` without ``_place`` (file and place there); of rows with one ``_order`` the k-th gets its k hashed in.

    Any number of copies spreads over all blocks then.  Copies are counted by file,
    then over the files, so none meet in one task; which copy has which k is open.
    """
    again = stage(rows.groupBy("_order").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1"), "repeated")
    total = again.agg(F.sum("_n")).first()[0]
    if not total:
        return rows.drop("_place")
    file = F.shiftright("_place", 33).alias("_file")
    copies = stage(hot_join(rows.select("_order", "_place", file), again, "_order", "_n", total).drop("_n").withColumn(
        "_k", F.row_number().over(Window.partitionBy("_file", "_order").orderBy("_place"))), "copies")
    before = copies.groupBy("_order", "_file").agg(F.max("_k").alias("_in")).withColumn(
        "_before", F.sum("_in").over(Window.partitionBy("_order").orderBy("_file")) - F.col("_in"))
    number = copies.join(before, ["_order", "_file"]).select("_place", (F.col("_before") + F.col("_k")).alias("_k"))
    return rows.join(number, "_place", "left").withColumn("_order", F.when(F.col("_k").isNull(), F.col("_order")).otherwise(
        F.xxhash64("_order", "_k"))).drop("_place", "_k")


def fly(size: np.ndarray, p: np.ndarray, coins, land: bool) -> np.ndarray:
    """Move ``p`` to 0 or 1, all but two of them, keeping ``sum(p)`` and ``sum(p * size)``.

    With ``land``, ``LANDING`` of them, spread over all sizes, stay out of the
    flight; they and the two that it leaves get the choice, of all, that is
    nearest in words, then in documents.
    """
    size, p = size.tolist(), p.tolist()
    waiting = [i for i in range(len(p)) if 0.0 < p[i] < 1.0][::-1]
    saved = []
    if land:                                   # some of every size wait for the landing
        every = max(1, len(waiting) // LANDING)
        saved = waiting[::every][:LANDING]
        held = set(saved)
        waiting = [x for x in waiting if x not in held]
    now: list[int] = []
    while True:
        while len(now) < 3 and waiting:
            now.append(waiting.pop())
        if len(now) < 3:
            break
        i, j, k = now
        u = (size[k] - size[j], size[i] - size[k], size[j] - size[i])
        if not any(u):
            u = (1.0, -1.0, 0.0)
        up = down = math.inf
        for x, v in zip(now, u):
            if v:
                a, b = (1.0 - p[x]) / abs(v), p[x] / abs(v)
                up, down = min(up, a if v > 0 else b), min(down, b if v > 0 else a)
        step = up if next(coins) * (up + down) < down else -down
        rest = []
        for x, v in zip(now, u):
            moved = p[x] + step * v
            p[x] = 0.0 if moved < 1e-9 else 1.0 if moved > 1.0 - 1e-9 else moved
            if 0.0 < p[x] < 1.0:
                rest.append(x)
        now = rest
    if land:
        last = now + saved
        pick = ((np.arange(2 ** len(last))[:, None] >> np.arange(len(last))) & 1).astype(float)
        moved = pick - np.array([p[x] for x in last])
        off = np.abs(moved @ np.array([size[x] for x in last]).reshape(len(last)))
        best = np.lexsort((np.abs(moved.sum(axis=1)), np.round(off, 6)))[0]
        for x, v in zip(last, pick[best].tolist()):
            p[x] = v
    return np.array(p)


def _fly_block(seed: int, round_no: int, land: bool):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_size", "_order"], ascending=[False, True], kind="stable")
        draws = np.random.Generator(np.random.Philox(
            np.random.SeedSequence([seed, round_no, int(key[0]), int(key[1])])))
        coins = iter(draws.random(len(pdf) + 3).tolist())
        pdf["_p"] = fly(pdf["_size"].to_numpy(float), pdf["_p"].to_numpy(float), coins, land)
        return pdf
    return run


def mix(docs: DataFrame, share: float = SHARE, cap: float = CAP, weights: tuple = WEIGHTS,
        source: str = "source", text: str = "text", doc_id: str = "doc_id",
        keep: list[str] | None = None, seed: int = SEED) -> DataFrame:
    """The columns ``keep`` (all by default), then ``_size, _source_size, _target, _times``.

    ``_times`` is how often the mix takes the row (0, 1 or 2 with the default cap).
    """
    ship(docs.sparkSession)
    carried = list(docs.columns if keep is None else keep)
    key = F.when(F.col(f"`{source}`").isNull(), F.lit("")).otherwise(
        F.concat(F.lit("="), F.col(f"`{source}`").cast("string")))
    rows = docs.select(
        *[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(carried)], key.alias("_key"), word_count(F.col(f"`{text}`")).alias("_size"),
        F.xxhash64(F.lit(seed), F.col(f"`{doc_id}`"), F.crc32(F.coalesce(F.col(f"`{text}`"), F.lit("")))).alias("_order"))
    rows = apart(stage(rows.withColumn("_place", F.monotonically_increasing_id()), "mix-rows"))
    sources = rows.groupBy("_key").agg(F.sum("_size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    sources = targets(sources.withColumn("source", F.when(
        F.col("_key") != "", F.expr("substring(_key, 2)"))), share, cap, weights)
    times = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    sources = sources.select(
        "_key", "n", F.col("rank").alias("_sid"), F.col("source_size").alias("_source_size"),
        F.col("target").alias("_target"), F.floor(times).cast("int").alias("_whole"),
        (times - F.floor(times)).alias("_p"), F.ceil(F.col("n") / F.lit(BLOCK)).alias("_blocks"))
    n, most = sources.agg(F.sum("n"), F.max("_blocks")).first()
    units = hot_join(rows, sources, "_key", "n", n or 0).withColumn(
        "_block", F.pmod(F.col("_order"), F.col("_blocks"))).drop("n", "_blocks", "_key")
    fan, blocks, round_no, decided = BLOCK // 2, most or 1, 0, None
    while True:
        units = units.groupBy("_sid", "_block").applyInPandas(
            _fly_block(seed, round_no, blocks == 1), units.schema)
        units = stage(units, "mix-round")
        done = units.where("_p = 0 or _p = 1")
        decided = done if decided is None else decided.unionByName(done)
        if blocks == 1:
            break
        units = units.where("_p > 0 and _p < 1").withColumn(
            "_block", F.floor(F.col("_block") / fan).cast("long"))
        blocks, round_no = math.ceil(blocks / fan), round_no + 1
    return decided.select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(carried)], "_size", "_source_size", "_target",
                          (F.col("_whole") + F.col("_p").cast("int")).alias("_times"))


def taken(docs: DataFrame) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` of every document."""
    return mix(docs, keep=["doc_id"]).select(
        "doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"), (F.col("_size") * F.col("_times")).alias("taken"))


def mixed_rows(docs: DataFrame) -> DataFrame:
    """The mix itself: each row as often as it is taken."""
    mixed = mix(docs).toDF(*[f"_c{i}" for i in range(len(docs.columns))], "_size", "_source_size", "_target", "_times")
    return mixed.withColumn("_time", F.explode(F.expr("array_repeat(0, _times)"))).select(
        *[F.col(f"_c{i}").alias(c) for i, c in enumerate(docs.columns)])
