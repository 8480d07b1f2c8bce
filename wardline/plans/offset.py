"""Cohort on minute offsets from unit admission (offset 0 = admission).

Stages:

1. base         first stay per hospitalisation (visit counter = 1), decoded
                age / sex / discharge status, hospital region; adults only
2. sepsis       admission text or any diagnosis row documents sepsis
3. eligibility  neuro and alcohol conditions from three text sources
4. first-day minimum score (per-offset minimum first, closed window 0..1440)
5. first charted delirium in the window
6. admission-drug term matches -> exposure flags
7. final cohort: base ⋈ sepsis ⋈ eligible, three left joins, 27 typed columns

The study computes stages 4 and 5 over all stays; the per-operator stage
tables keep that, while ``cohort`` restricts them to the base first and reads
the charting table once for both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.functions import dictionaries as dic
from wardline.functions.decode import decode_age, decode_by_substring
from wardline.functions.match import contains_any
from wardline.functions.windows import any_flag
from wardline.operators import eligibility as elig
from wardline.operators import exposure as expo
from wardline.operators import outcome
from wardline.operators.joins import keyed_join, materialize, narrowed, restrict
from wardline.operators.select import first_by_counter

c = F.col
KEY = "patientunitstayid"

BASE_COLUMNS = ("uniquepid", "patienthealthsystemstayid", "patientunitstayid", "unitvisitnumber",
                "hospitalid", "region", "unittype", "apacheadmissiondx", "unitdischargeoffset",
                "hospitaldischargeyear", "age", "sex_male", "race", "hosp_mort", "icu_mort")

FINAL_COLUMNS = ("uniquepid", "patienthealthsystemstayid", "patientunitstayid", "hospitalid",
                 "region", "unittype", "apacheadmissiondx", "unitdischargeoffset",
                 "hospitaldischargeyear", "age", "sex_male", "race", "icu_mort", "hosp_mort",
                 "acute_brain_injury_or_major_neuro", "alcohol_abuse", "sae_eligible",
                 "gcs_min_firstday", "first_gcs_offset", "first_low_gcs_offset_firstday",
                 "sae_by_gcs_firstday", "first_delirium_offset", "delirium_firstday",
                 "sae_within_24h", "statin_before_icu", "lipophilic_statin_before_icu",
                 "hydrophilic_statin_before_icu")


# ---------------------------------------------------------------- stage 1

def decoded_patients(src) -> DataFrame:
    """U5+U6 on every patient row: age, sex and discharge status from text."""
    p = src["patient"]
    return p.select(
        KEY,
        decode_age(c("age")).alias("age"),
        decode_by_substring(c("gender"), dic.SEX_MALE_DECODE).alias("sex_male"),
        decode_by_substring(c("hospitaldischargestatus"), dic.DISCHARGE_DEATH_DECODE)
        .alias("hosp_mort"),
        decode_by_substring(c("unitdischargestatus"), dic.DISCHARGE_DEATH_DECODE)
        .alias("icu_mort"))


def base_cohort(src, materialized: bool = True) -> DataFrame:
    """U2+U8: adult first visits with decoded attributes and the hospital's region.

    A hospital without a match keeps the row (left join; the hospital table
    is broadcast once its size is checked).
    """
    p = first_by_counter(src["patient"], "unitvisitnumber")
    j = keyed_join(p, src["hospital"], None, "hospitalid", "left")
    b = j.select(
        *[c(n) for n in ("uniquepid", "patienthealthsystemstayid", KEY, "unitvisitnumber",
                         "hospitalid", "region", "unittype", "apacheadmissiondx",
                         "unitdischargeoffset", "hospitaldischargeyear")],
        decode_age(c("age")).alias("age"),
        decode_by_substring(c("gender"), dic.SEX_MALE_DECODE).alias("sex_male"),
        c("ethnicity").alias("race"),
        decode_by_substring(c("hospitaldischargestatus"), dic.DISCHARGE_DEATH_DECODE)
        .alias("hosp_mort"),
        decode_by_substring(c("unitdischargestatus"), dic.DISCHARGE_DEATH_DECODE)
        .alias("icu_mort"),
    ).where(c("age") >= 18)
    return materialize(b) if materialized else b


# ---------------------------------------------------------------- stages 2-6

def sepsis_stage(src, base: DataFrame) -> DataFrame:
    """U14 stage table."""
    return elig.sepsis_flag(base, narrowed(src["diagnosis"], base, KEY))


def eligibility_stage(src, base: DataFrame) -> DataFrame:
    """U15 stage table."""
    return elig.eligibility_multi(base, narrowed(src["diagnosis"], base, KEY),
                                  narrowed(src["pasthistory"], base, KEY))


def gcs_stage(src) -> DataFrame:
    """U17+U19+U20 stage table (all stays with a valid first-day score)."""
    return outcome.offset_min(src["nursecharting"])


def delirium_stage(src) -> DataFrame:
    """U23 stage table (all stays with charted delirium in the first day)."""
    return outcome.charted_first(src["nursecharting"])


def term_matches(src, base: DataFrame | None = None) -> DataFrame:
    """U27 over admission drugs (optionally only base stays)."""
    drugs = src["admissiondrug"] if base is None else restrict(src["admissiondrug"], base, KEY)
    return expo.match_terms(drugs, dic.admission_statin_terms())


def exposure_stage(src, base: DataFrame) -> DataFrame:
    """U28 stage table."""
    drugs = narrowed(src["admissiondrug"], base, KEY)
    return expo.undated_exposure(base, expo.match_terms(drugs, dic.admission_statin_terms()))


# ---------------------------------------------------------------- stage 7

def cohort(src, base: DataFrame | None = None, written: dict | None = None) -> DataFrame:
    """U32: the final offset cohort, 27 columns, septic and eligible stays only.

    Diagnosis rows are scanned once for both the sepsis and the exclusion
    rules (one roll-up), past history once; every roll-up is joined 1:1.
    ``written`` may hold all five stage tables of this base (``sepsis``,
    ``eligibility``, ``gcs``, ``delirium``, ``exposure``); the sources are then not read.
    """
    b = base if base is not None else base_cohort(src)
    if written:
        septic = written["sepsis"].where(c("sepsis") == 1).select(KEY)
        kept = b.join(septic, KEY, "left_semi").join(written["eligibility"].where(c("sae_eligible") == 1), KEY)
        out = kept
        for name in ("gcs", "delirium", "exposure"):
            out = out.join(written[name], KEY, "left")
    else:
        dx = elig.rollup_flags(narrowed(src["diagnosis"], b, KEY), KEY,
                               {**elig.diagnosis_sepsis_conds(), **elig.diagnosis_exclusion_conds()})
        ph = elig.rollup_flags(narrowed(src["pasthistory"], b, KEY), KEY,
                               elig.history_exclusion_conds())
        j = b.join(dx, KEY, "left").join(ph, KEY, "left")
        adm_sepsis = contains_any(elig.low_text("apacheadmissiondx"), dic.SEPSIS_ADMISSION_TERMS)
        j = j.where(adm_sepsis | (F.coalesce(c("_dx_sepsis"), F.lit(0)) == 1))
        flags = [col.alias(n) for n, col in elig.exclusion_columns().items()]
        kept = j.select("*", *flags).where(c("sae_eligible") == 1)

        charted = outcome.offset_outcomes(narrowed(src["nursecharting"], b, KEY))
        e = expo.term_class_rollup(narrowed(src["admissiondrug"], b, KEY), dic.admission_statin_terms())
        out = kept.join(charted, KEY, "left").join(e, KEY, "left")
    gcs_flag = F.coalesce(c("sae_by_gcs_firstday"), F.lit(0)).cast("smallint")
    del_flag = F.coalesce(c("delirium_firstday"), F.lit(0)).cast("smallint")
    cols = {
        "sae_by_gcs_firstday": gcs_flag, "delirium_firstday": del_flag,
        "sae_within_24h": any_flag(gcs_flag, del_flag),
        "statin_before_icu": F.coalesce(c("pre_statin"), F.lit(0)).cast("smallint"),
        "lipophilic_statin_before_icu":
            F.coalesce(c("pre_lipophilic_statin"), F.lit(0)).cast("smallint"),
        "hydrophilic_statin_before_icu":
            F.coalesce(c("pre_hydrophilic_statin"), F.lit(0)).cast("smallint"),
    }
    return out.select(*[cols[n].alias(n) if n in cols else c(n) for n in FINAL_COLUMNS])
