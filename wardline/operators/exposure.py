"""Drug exposure: term classification, drug events, before-index flags.

The study's term lists become literal expressions, so matching needs no join;
a dictionary given as a table, of any size, is matched by an equality join on
rare substrings.  The drug tables are only filtered, classified and joined
to the narrow base key table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.functions import dictionaries as dic
from wardline.functions.dictionaries import Term
from wardline.functions.match import classify_terms, contains_any
from wardline.functions.windows import flag
from wardline.operators.joins import keyed_join
from wardline.operators.patterns import match_rows

c = F.col


# ---------------------------------------------------------------- U24: classification

def classify_drugs(df: DataFrame, text: str = "drug",
                   priority=dic.STATIN_TERMS_PRIORITY,
                   classes: Sequence[str] = ("lipophilic", "hydrophilic")) -> DataFrame:
    """Adds ``statin_type`` (first matching generic by priority) and ``statin_class``.

    The class is the first of ``classes`` that any matching term belongs to,
    whatever the order of the generics.
    """
    low, kind = F.lower(c(text)), c("statin_type")
    # The type settles most classes: no type, no term; a type of the first class needs no test.
    cls = None
    for name in reversed(classes):
        terms = [t for _, of, group in priority for t in group if of == name]
        if terms:
            hit = contains_any(low, terms)
            cls = F.when(hit, F.lit(name)) if cls is None else F.when(hit, F.lit(name)).otherwise(cls)
    cls = F.lit(None).cast("string") if cls is None else cls
    first = [g for g in dict.fromkeys(g for g, _, _ in priority)
             if {of for other, of, _ in priority if other == g} == set(classes[:1])]
    settled = F.when(kind.isNull(), F.lit(None).cast("string"))
    if first:
        settled = settled.when(kind.isin(*first), F.lit(classes[0]))
    return (df.withColumn("statin_type", classify_terms(c(text), priority))
            .withColumn("statin_class", settled.otherwise(cls)))


# ---------------------------------------------------------------- U25: drug events

def statin_rows(base: DataFrame, rx: DataFrame, *, key: str = "hadm_id", stay: str = "stay_id",
                index_time: str = "icu_intime", priority=dic.STATIN_TERMS_PRIORITY,
                excluded_type: str = dic.EXCLUDED_DRUG_TYPE) -> DataFrame:
    """Classified drug rows with a start time, not of the excluded type, joined to base.

    ``drug_type`` NULL is kept (only the excluded type is dropped).  Carries
    the index time for the before-index test.
    """
    kept = rx.where(c("starttime").isNotNull()
                    & (F.coalesce(c("drug_type"), F.lit("")) != excluded_type))
    terms = [t for _, _, group in priority for t in group]
    typed = classify_drugs(kept.where(contains_any(F.lower(c("drug")), terms)), "drug", priority)
    return keyed_join(typed, base, [key, stay, index_time], key, "inner")


def drug_events(rows: DataFrame, *, stay: str = "stay_id") -> DataFrame:
    """Stage table: distinct (stay, drug text, type, class, start, stop)."""
    return rows.select(stay, c("drug").alias("drug_name_original"), "statin_type",
                       "statin_class", "starttime", "stoptime").distinct()


# ---------------------------------------------------------------- U26: before-index flags

def exposure_names(generics: Sequence[str] = dic.STATIN_FLAG_ORDER) -> list[str]:
    """Flag columns in output order: any, the two classes, then one per generic."""
    return (["statin_before_icu", "lipophilic_statin_before_icu",
             "hydrophilic_statin_before_icu"] + [f"{g}_before_icu" for g in generics])


def _flag_conditions(generics: Sequence[str]) -> list:
    return ([F.lit(True), c("statin_class") == "lipophilic", c("statin_class") == "hydrophilic"]
            + [c("statin_type") == g for g in generics])


def exposure_rollup(rows: DataFrame, *, stay: str = "stay_id", index_time: str = "icu_intime",
                    generics: Sequence[str] = dic.STATIN_FLAG_ORDER) -> DataFrame:
    """Per stay exposed strictly before the index time: any / by class / by generic."""
    before = rows.where(c("starttime") < c(index_time))
    return before.groupBy(stay).agg(*[
        F.max(flag(cond)).alias(name)
        for name, cond in zip(exposure_names(generics), _flag_conditions(generics))])


def exposure_flags(base: DataFrame, rows: DataFrame, *, stay: str = "stay_id",
                   generics: Sequence[str] = dic.STATIN_FLAG_ORDER, **kw) -> DataFrame:
    """Stage table: every base stay with 0/1 exposure flags (smallint, 0 default)."""
    agg = exposure_rollup(rows, stay=stay, generics=generics, **kw)
    j = base.select(stay).join(agg, stay, "left")
    return j.select(stay, *[F.coalesce(c(n), F.lit(0)).cast("smallint").alias(n)
                            for n in exposure_names(generics)])


# ---------------------------------------------------------------- U27: term match join

def match_terms(df: DataFrame, terms, *, key: str = "patientunitstayid", text: str = "drugname",
                keep: Sequence[str] = ("generic_name", "statin_type")) -> DataFrame:
    """Distinct (key, generic, class) for every term contained in ``lower(text)``.

    The study's theta join (``text LIKE '%' || term || '%'``) lets a row match
    several terms.  A sequence of :class:`Term` becomes one conditional per
    term behind a filter on any of them.  A DataFrame (``generic_name,
    statin_type, match_term``) of any size is matched by its rarest grams, with
    the wildcards of ``LIKE`` (:mod:`wardline.operators.patterns`).
    """
    low = F.lower(F.coalesce(c(text), F.lit("")))
    if isinstance(terms, DataFrame):
        return match_rows(df, low, terms, carry=(key,), keep=keep)
    hits = F.array(*[F.when(low.contains(t.term), F.struct(
        F.lit(t.generic).alias("generic_name"), F.lit(t.drug_class).alias("statin_type"),
        F.lit(t.term).alias("match_term"))) for t in terms])
    rows = df.where(contains_any(low, [t.term for t in terms])).select(key, F.explode(hits).alias("_t"))
    return rows.where(c("_t").isNotNull()).select(key, *[c(f"_t.{k}").alias(k) for k in keep]).distinct()


def term_class_rollup(df: DataFrame, terms, *, key: str = "patientunitstayid",
                      text: str = "drugname") -> DataFrame:
    """U27 and U28 in one step: per key with any match, the any and class flags."""
    low = F.lower(F.coalesce(c(text), F.lit("")))
    of = lambda cls: [t.term for t in terms if cls in (None, t.drug_class)]
    rows = df.where(contains_any(low, of(None))).select(
        key, flag(contains_any(low, of("lipophilic"))).alias("_lipo"),
        flag(contains_any(low, of("hydrophilic"))).alias("_hydro"))
    return rows.groupBy(key).agg(
        F.lit(1).alias("pre_statin"), F.max("_lipo").alias("pre_lipophilic_statin"),
        F.max("_hydro").alias("pre_hydrophilic_statin"))


# ---------------------------------------------------------------- U28: undated flags

def undated_exposure(base: DataFrame, matches: DataFrame, *, key: str = "patientunitstayid",
                     cls: str = "statin_type") -> DataFrame:
    """Stage table: every base stay, any / lipophilic / hydrophilic match (smallint)."""
    agg = undated_rollup(matches, key=key, cls=cls)
    j = base.select(key).join(agg, key, "left")
    return j.select(key, *[F.coalesce(c(n), F.lit(0)).cast("smallint").alias(n)
                           for n in ("pre_statin", "pre_lipophilic_statin",
                                     "pre_hydrophilic_statin")])


def undated_rollup(matches: DataFrame, *, key: str = "patientunitstayid",
                   cls: str = "statin_type") -> DataFrame:
    return matches.groupBy(key).agg(
        F.lit(1).alias("pre_statin"),
        F.max(flag(c(cls) == "lipophilic")).alias("pre_lipophilic_statin"),
        F.max(flag(c(cls) == "hydrophilic")).alias("pre_hydrophilic_statin"))
