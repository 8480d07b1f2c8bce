"""Language ID (operator 3): Bayesian evidence fusion.

The posterior of a language is the product of four pieces of evidence:

* the text: tempered likelihood of its byte trigrams under a multinomial model
  per language, fitted on a bounded sample of labelled rows
  (``FIT_ROWS`` expected rows a language), against ``und``, a flat model that wins
  where no language explains the text;
* the declared language (markup ``lang``, or a column), weighed by how often
  it goes with each language over the whole table;
* the host, whose prior is smoothed towards that of its registered domain, that
  towards the address suffix's and that towards all rows';
* the suffix, as a level of that hierarchy.

All counts are grouped aggregations over every row.  A row is accepted when a
language wins with at least ``ACCEPT``.

Edge cases: null text counts as empty; a text without words of letters is ``und`` and not
accepted; null or unknown declarations, hosts and suffixes say nothing; labels
with fewer than ``LEAST_LABELS`` rows make no model; without any model every row
is ``und``; ties go to the language first in alphabetical order; repeated rows are
judged alike; extra columns are kept as asked.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import hot_join, ship, stage

FIT_ROWS = 500          # expected labelled rows a language that the text model is fitted on
LEAST_LABELS = 5
BUCKETS = 1 << 15       # hashed byte trigrams
ALPHA = 0.1             # their smoothing
TEMPER = 0.25           # neighbouring trigrams overlap, so each counts for less than one
KAPPA = 20.0            # pseudo-rows that a level of the hierarchy takes from the level above
UNKNOWN = 0.01          # prior of und
ACCEPT = 0.5
UNIVERSE = 1 << 17      # und takes all trigrams of so many as equally likely
_PIECE = 1 << 20
# Words of letters, with or without marks around them; numbers, addresses and keys are in no language.
_WORD = re.compile(rb"(?<!\S)[^\w\s\x80-\xff]*([a-z\x80-\xff]+(?:['-][a-z\x80-\xff]+)*)[^\w\s\x80-\xff]*(?!\S)")


def trigrams(text: str):
    """Hashed byte trigrams of the lower-cased words of letters, joined by single spaces, in pieces."""
    words = _WORD.findall(text.lower().encode("utf-8", "replace"))
    if not words:
        return
    raw = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8)
    for at in range(0, len(raw) - 2, _PIECE):
        b = raw[at:at + _PIECE + 2].astype(np.uint32)
        code = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
        yield ((code * np.uint32(2654435761)) >> np.uint32(17)).astype(np.int64)


class TextModel:
    """Trigram log-probabilities, a row per language."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        p = counts + ALPHA
        self.logp = np.ascontiguousarray(np.log(p / p.sum(axis=1, keepdims=True)).T.astype(np.float32))

    def score(self, text: str) -> tuple[int, list[float]]:
        """Number of trigrams and their log-likelihood under each language."""
        n, total = 0, np.zeros(len(self.languages))
        for codes in trigrams(text):
            n += len(codes)
            total += self.logp[codes].sum(axis=0, dtype=np.float64)
        return n, total.tolist()


def _count(names: list[str]):
    def run(batches):
        counts = np.zeros((len(names), BUCKETS), np.int64)
        at = {x: i for i, x in enumerate(names)}
        for pdf in batches:
            for text, label in zip(pdf["text"], pdf["label"]):
                for codes in trigrams(text):
                    counts[at[label]] += np.bincount(codes, minlength=BUCKETS)
        i, j = np.nonzero(counts)
        yield pd.DataFrame({"i": i, "bucket": j, "n": counts[i, j]})
    return run


def fit(labelled: DataFrame, text: str = "text", label: str = "lang") -> TextModel:
    """A text model from a hash sample of labelled rows, ``FIT_ROWS`` a language in expectation."""
    ship(labelled.sparkSession)
    rows = labelled.select(F.coalesce(F.col(text), F.lit("")).alias("text"), F.lower(F.col(label)).alias("label"))
    sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().where(
        F.col("label").isNotNull() & (F.col("count") >= LEAST_LABELS)).collect()}
    names = sorted(sizes)
    counts = np.zeros((len(names), BUCKETS))
    if names:
        share = F.create_map(*[F.lit(x) for k in names for x in (k, min(1.0, FIT_ROWS / sizes[k]))])
        sample = rows.where(F.col("label").isin(names)).where(
            F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < F.element_at(share, F.col("label")) * (1 << 20))
        # At most one row per language and bucket: the model's own size.
        for r in (sample.mapInPandas(_count(names), "i int, bucket int, n long")
                  .groupBy("i", "bucket").agg(F.sum("n").alias("n")).collect()):
            counts[r["i"], r["bucket"]] = r["n"]
    return TextModel(names, counts)


def declared_in(html):
    """The language that markup declares: ``<html lang=...>``, primary subtag."""
    found = F.lower(F.regexp_extract(html, r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]+)", 1))
    return F.when(found != "", found)


def host_of(url):
    return F.lower(F.try_parse_url(url, F.lit("HOST")))


def _levels(host):
    """Registered domain (last two labels) and suffix (last label) of a host."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    return (F.when(n >= 2, F.concat_ws(".", F.element_at(labels, -2), F.element_at(labels, -1))).otherwise(host),
            F.when(n >= 2, F.element_at(labels, -1)).otherwise(F.lit("")))


def _priors(rows: DataFrame, n_langs: int) -> DataFrame:
    """A row per host: its rows ``n`` and its smoothed language prior ``prior``."""
    votes = [F.sum(F.when(F.col("_text_best") == i, 1).otherwise(0)).cast("double") for i in range(n_langs)]
    domain, suffix = _levels(F.col("_host"))
    hosts = stage(rows.groupBy("_host").agg(F.count(F.lit(1)).alias("n"), F.array(*votes).alias("votes"))
                  .withColumn("_domain", domain).withColumn("_suffix", suffix), "hosts")
    total = F.array(*[F.sum(F.col("votes")[i]) for i in range(n_langs)])
    every = (hosts.agg(total.alias("v")).first()["v"] or [])
    every = [(v or 0.0) + 1.0 for v in every] or [1.0] * n_langs
    world = F.array(*[F.lit(v / sum(every)) for v in every])

    def smooth(votes, above):
        mass = F.aggregate(votes, F.lit(0.0), lambda a, v: a + v) + F.lit(KAPPA)
        return F.zip_with(votes, above, lambda v, p: (v + F.lit(KAPPA) * p) / mass)

    suffixes = hosts.groupBy("_suffix").agg(F.count(F.lit(1)).alias("k"), total.alias("v")).select(
        "_suffix", "k", smooth(F.col("v"), world).alias("above"))
    domains = hosts.groupBy("_domain").agg(F.count(F.lit(1)).alias("hosts"), F.first("_suffix").alias("_suffix"), total.alias("v"))
    n_hosts = hosts.count()
    domains = hot_join(domains, suffixes, "_suffix", "k", n_hosts).select(
        "_domain", "hosts", smooth(F.col("v"), F.col("above")).alias("above"))
    return hot_join(hosts, domains, "_domain", "hosts", n_hosts).select(
        "_host", "n", smooth(F.col("votes"), F.col("above")).alias("prior"))


def identify(docs: DataFrame, model: TextModel, text="text", declared=None, host=None,
             keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all by default) and ``_language, _posterior, _accepted``.

    ``declared`` and ``host`` are column names or columns; without them that
    evidence is absent.
    """
    ship(docs.sparkSession)
    carried = list(docs.columns if keep is None else keep)
    names = model.languages
    if not names:
        return docs.select(*[F.col(f"`{c}`") for c in carried], F.lit("und").alias("_language"),
                           F.lit(1.0).alias("_posterior"), F.lit(False).alias("_accepted"))
    as_col = lambda c: F.lit(None).cast("string") if c is None else F.col(f"`{c}`") if isinstance(c, str) else c

    @F.pandas_udf("array<double>")
    def score(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            n, total = model.score(t)
            out.append([float(n), *total])
        return pd.Series(out)

    said = F.regexp_extract(F.lower(as_col(declared)), "^[a-z]+", 0)
    rows = docs.select(
        *[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(carried)], score(F.coalesce(as_col(text), F.lit(""))).alias("_s"),
        F.coalesce(F.lower(as_col(host)), F.lit("")).alias("_host"),
        F.when(said.isin(names), said).otherwise(F.lit("")).alias("_said"))
    likelihood = F.slice("_s", 2, len(names))
    rows = stage(rows.withColumn("_text_best", F.when(F.col("_s")[0] > 0, F.array_position(
        likelihood, F.array_max(likelihood)).cast("int") - 1)), "scored")
    # (languages + 1) x languages counts, whatever the table.
    pairs = {(r["_said"], r["_text_best"]): r["count"] for r in
             rows.where("_text_best is not null").groupBy("_said", "_text_best").count().collect()}
    of = [sum(pairs.get((s, i), 0) for s in ("", *names)) for i in range(len(names))]
    weigh = F.create_map(*[x for s in ("", *names) for x in (F.lit(s), F.array(*[
        F.lit(0.0 if s == "" else math.log((pairs.get((s, i), 0) + 1.0) / (of[i] + len(names) + 1.0)))
        for i in range(len(names))]))])
    judged = hot_join(rows, _priors(rows, len(names)), "_host", "n", rows.count())
    flat = F.lit(math.log(UNKNOWN)) - F.col("_s")[0] * F.lit(TEMPER * math.log(UNIVERSE))
    # und has no declaration of its own: it expects each one as often as the table has it.
    known = sum(of) or 1
    expect = F.create_map(*[x for s in ("", *names) for x in (F.lit(s), F.lit(0.0 if s == "" else math.log(
        (sum(pairs.get((s, i), 0) for i in range(len(names))) + 1.0) / (known + len(names) + 1.0))))])
    scores = [F.col("_s")[i + 1] * F.lit(TEMPER) + F.log(F.col("prior")[i]) + F.element_at(weigh, F.col("_said"))[i]
              for i in range(len(names))] + [flat + F.element_at(expect, F.col("_said"))]
    judged = judged.withColumn("_scores", F.array(*scores))
    top = F.array_max("_scores")
    mass = F.aggregate("_scores", F.lit(0.0), lambda a, v: a + F.exp(v - F.array_max(F.col("_scores"))))
    best = F.element_at(F.array(*[F.lit(x) for x in (*names, "und")]), F.array_position("_scores", top).cast("int"))
    words = F.col("_s")[0] > 0
    language = F.when(words, best).otherwise(F.lit("und"))
    return judged.select(
        *[F.col(f"_c{i}").alias(c) for i, c in enumerate(carried)], language.alias("_language"),
        F.when(words, 1.0 / mass).otherwise(F.lit(1.0)).alias("_posterior"),
        (words & (language != "und") & (1.0 / mass >= ACCEPT)).alias("_accepted"))


def languages(docs: DataFrame) -> DataFrame:
    """``doc_id, declared, host, language, posterior, accepted`` of every row of ``documents``."""
    return identify(docs, fit(docs), declared="lang", host="source", keep=["doc_id", "lang", "source"]).select(
        "doc_id", F.col("lang").alias("declared"), F.col("source").alias("host"), F.col("_language").alias("language"),
        F.col("_posterior").alias("posterior"), F.col("_accepted").alias("accepted"))


def accepted_rows(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` in a known language."""
    judged = identify(docs, fit(docs), declared="lang", host="source")
    names = [f"_c{i}" for i in range(len(docs.columns))]
    return judged.toDF(*names, "_language", "_posterior", "_accepted").where("_accepted").select(
        *[F.col(n).alias(c) for n, c in zip(names, docs.columns)])
