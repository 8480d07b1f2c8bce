"""Eligibility and documented-condition flags from codes and free text.

Child tables (diagnoses, past history) are reduced to one row per key
*before* they meet the base: each flag is a ``max`` of a row predicate, and
``max`` over a left-joined fan-out equals ``greatest`` of per-child maxima,
so joining pre-aggregated children 1:1 gives the same flags as joining the
raw children, without the many-to-many blow-up.  Rows that raise no flag
are dropped before the shuffle (they cannot change a ``max`` of 0/1 that
defaults to 0).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.functions import dictionaries as dic
from wardline.functions.dictionaries import CodeRule
from wardline.functions.match import (code_rule, list_code_flag, matches_any, normalise_code,
                                      phrase_flag, contains_any)
from wardline.functions.windows import any_of, flag
from wardline.operators.joins import keyed_join

c = F.col


def low_text(col: str) -> Column:
    """``lower(coalesce(col, ''))``: the null-safe form the text rules test."""
    return F.lower(F.coalesce(c(col), F.lit("")))


# ---------------------------------------------------------------- U9: describe codes

def describe_codes(dx: DataFrame, dictionary: DataFrame, *, key: str = "hadm_id") -> DataFrame:
    """Normalised code, version and lower-cased title ('' when the code is unknown).

    The dictionary is matched on the raw code and the version.  A code
    dictionary is a bounded vocabulary; ``keyed_join`` still checks its
    size before broadcasting it.
    """
    j = keyed_join(dx, dictionary, ["icd_code", "icd_version", "long_title"],
                   ["icd_code", "icd_version"], "left")
    return j.select(key, normalise_code(c("icd_code")).alias("icd_code_clean"), "icd_version",
                    F.lower(F.coalesce(c("long_title"), F.lit(""))).alias("long_title"))


# ---------------------------------------------------------------- U10: code rules

def code_flags(described: DataFrame, rules: Sequence[CodeRule], *,
               key: str = "hadm_id") -> DataFrame:
    """Per key present in ``described``: one 0/1 flag per rule (int)."""
    return described.groupBy(key).agg(*[
        F.max(flag(code_rule(r, c("icd_code_clean"), c("icd_version"), c("long_title"))))
         .alias(r.name) for r in rules])


def code_flag_hits(dx: DataFrame, dictionary: DataFrame, rules: Sequence[CodeRule], *,
                   key: str = "hadm_id") -> DataFrame:
    """Keys with at least one rule hit, and their flags (pipeline path of U9+U10).

    Titles matter only through the title terms, so the dictionary is first
    reduced to the entries whose title hits some rule; only that subset is
    joined (broadcast when its size is proven small).  Diagnosis rows that
    hit nothing are dropped before the aggregation shuffle.
    """
    title = F.lower(F.coalesce(c("long_title"), F.lit("")))
    titled = dictionary.select(
        "icd_code", "icd_version",
        *[flag(matches_any(title, r.title_terms)).alias(f"_t_{r.name}")
          for r in rules if r.title_terms])
    tcols = [f"_t_{r.name}" for r in rules if r.title_terms]
    if tcols:
        titled = titled.where(any_of(*[c(t) for t in tcols]) == 1)
    # The titled subset is no larger than the dictionary, whose bound is checked.
    j = keyed_join(dx, titled, None, ["icd_code", "icd_version"], "left",
                   bound_from=dictionary)
    clean = normalise_code(c("icd_code"))
    per_rule = []
    for r in rules:
        hit = code_rule(r, clean, c("icd_version"))
        if r.title_terms:
            hit = hit | (F.coalesce(c(f"_t_{r.name}"), F.lit(0)) == 1)
        per_rule.append(flag(hit).alias(r.name))
    rows = j.select(key, *per_rule)
    rows = rows.where(any_of(*[c(r.name) for r in rules]) == 1)
    return rows.groupBy(key).agg(*[F.max(r.name).alias(r.name) for r in rules])


# ---------------------------------------------------------------- U11: eligibility

def eligibility(base: DataFrame, flags: DataFrame, *, key: str = "hadm_id",
                carry: Sequence[str] = ("stay_id",), names: Sequence[str] | None = None,
                eligible: str = "sae_eligible", dtype: str = "smallint") -> DataFrame:
    """Every base row with its condition flags (0 when absent) and ``eligible`` = no flag."""
    names = list(names or [n for n in flags.columns if n != key])
    j = base.select(*carry, key).join(flags.select(key, *names), key, "left")
    filled = [F.coalesce(c(n), F.lit(0)).cast(dtype).alias(n) for n in names]
    none = None
    for n in names:
        z = F.coalesce(c(n), F.lit(0)) == 0
        none = z if none is None else (none & z)
    return j.select(*carry, key, *filled, flag(none, dtype).alias(eligible))


# ---------------------------------------------------------------- U12-U14: documented condition

def sepsis_phrase(text: Column) -> Column:
    """U12 with the study's lists: names sepsis/septic and no rule-out/history phrase."""
    return phrase_flag(text, dic.SEPSIS_DIAGNOSIS_TERMS, dic.SEPSIS_EXCLUDE_PHRASES)


def sepsis_codes(codes: Column) -> Column:
    """U13 with the study's lists: whole 995.91/995.92/785.52, or a code starting 038."""
    return list_code_flag(codes, dic.SEPSIS_WHOLE_CODES, dic.SEPSIS_PREFIX_CODES)


def rollup_flags(df: DataFrame, key: str, conds: Mapping[str, Column],
                 hits_only: bool = True) -> DataFrame:
    """Per key: ``max(CASE WHEN cond THEN 1 ELSE 0 END)`` for each named condition.

    With ``hits_only`` rows raising no flag are dropped first, so only keys
    with some hit come out (callers fill 0 after their left join).
    """
    rows = df.select(key, *[flag(cond).alias(n) for n, cond in conds.items()])
    if hits_only:
        rows = rows.where(any_of(*[c(n) for n in conds]) == 1)
    return rows.groupBy(key).agg(*[F.max(n).alias(n) for n in conds])


def diagnosis_sepsis_conds() -> dict[str, Column]:
    text, codes = low_text("diagnosisstring"), F.coalesce(c("icd9code"), F.lit(""))
    return {"_dx_sepsis": sepsis_phrase(text) | sepsis_codes(codes)}


def sepsis_flag(base: DataFrame, diagnosis: DataFrame, *, key: str = "patientunitstayid",
                admission_dx: str = "apacheadmissiondx") -> DataFrame:
    """Stage table: every base stay, 1 when the admission text or any diagnosis row
    documents sepsis (int)."""
    hits = rollup_flags(diagnosis, key, diagnosis_sepsis_conds())
    adm = contains_any(low_text(admission_dx), dic.SEPSIS_ADMISSION_TERMS)
    j = base.select(key, admission_dx).join(hits, key, "left")
    return j.select(key, flag(adm | (F.coalesce(c("_dx_sepsis"), F.lit(0)) == 1))
                    .alias("sepsis"))


# ---------------------------------------------------------------- U15: many child tables

def diagnosis_exclusion_conds() -> dict[str, Column]:
    text = low_text("diagnosisstring")
    return {"_dx_neuro": matches_any(text, dic.NEURO_DIAGNOSIS_TERMS),
            "_dx_alcohol": matches_any(text, dic.ALCOHOL_DIAGNOSIS_TERMS)}


def history_exclusion_conds() -> dict[str, Column]:
    text = low_text("pasthistorypath")
    return {"_ph_neuro": matches_any(text, dic.NEURO_HISTORY_TERMS),
            "_ph_alcohol": matches_any(text, dic.ALCOHOL_HISTORY_TERMS)}


def admission_exclusion_conds(admission_dx: str = "apacheadmissiondx") -> dict[str, Column]:
    text = low_text(admission_dx)
    return {"_adm_neuro": matches_any(text, dic.NEURO_ADMISSION_TERMS),
            "_adm_alcohol": matches_any(text, dic.ALCOHOL_ADMISSION_TERMS)}


def exclusion_columns(admission_dx: str = "apacheadmissiondx") -> dict[str, Column]:
    """Over base ⋈ (diagnosis hits) ⋈ (history hits): the two conditions and eligibility."""
    adm = admission_exclusion_conds(admission_dx)

    def cond(kind: str) -> Column:
        return (adm[f"_adm_{kind}"]
                | (F.coalesce(c(f"_dx_{kind}"), F.lit(0)) == 1)
                | (F.coalesce(c(f"_ph_{kind}"), F.lit(0)) == 1))

    neuro, alcohol = flag(cond("neuro")), flag(cond("alcohol"))
    return {"acute_brain_injury_or_major_neuro": neuro, "alcohol_abuse": alcohol,
            "sae_eligible": flag((neuro == 0) & (alcohol == 0))}


def eligibility_multi(base: DataFrame, diagnosis: DataFrame, pasthistory: DataFrame, *,
                      key: str = "patientunitstayid",
                      admission_dx: str = "apacheadmissiondx") -> DataFrame:
    """Stage table: every base stay with the neuro and alcohol flags from three text
    sources (diagnosis rows, past history rows, admission text) and eligibility (int)."""
    dx = rollup_flags(diagnosis, key, diagnosis_exclusion_conds())
    ph = rollup_flags(pasthistory, key, history_exclusion_conds())
    j = base.select(key, admission_dx).join(dx, key, "left").join(ph, key, "left")
    return j.select(key, *[col.alias(n) for n, col in exclusion_columns(admission_dx).items()])
