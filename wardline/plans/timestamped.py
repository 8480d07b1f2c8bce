"""Cohort on absolute timestamps (stays with in/out times, charted events with times).

Stages, each a lazy DataFrame over a sources map (see
:func:`wardline.sources.adapter.sources`):

1. base      first stay per patient (ranked over all stays) ⋈ sepsis onset
             ⋈ admission ⋈ patient, adults only; materialised once
2. eligibility  versioned code rules + dictionary titles per admission
3. first-day minimum score in [intime, least(outtime, intime + 24 h))
4. feature rows and the co-occurrence rule (delirium)
5. drug events and before-admission exposure flags
6. death inside the stay interval
7. final cohort: base ⋈ eligible, four left joins, 32 typed columns

``cohort`` does not chain the per-base stage tables (each of which is
already a left join from the base); it joins every child roll-up to the
base once, which Catalyst cannot do for us.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.functions import dictionaries as dic
from wardline.functions.decode import anchored_age
from wardline.functions.windows import any_flag, flag, in_interval_flag
from wardline.operators import eligibility as elig
from wardline.operators import exposure as expo
from wardline.operators import outcome
from wardline.operators.joins import key_table, keyed_join, materialize, narrowed
from wardline.operators.select import first_per_entity, onset_rollup

c = F.col

BASE_COLUMNS = ("subject_id", "hadm_id", "stay_id", "icu_intime", "icu_outtime", "icu_los_days",
                "age", "gender", "race", "admittime", "deathtime", "death_time",
                "hospital_expire_flag", "suspected_infection_time", "sepsis_time", "sofa_score")

FINAL_COLUMNS = ("subject_id", "hadm_id", "stay_id", "icu_intime", "icu_outtime",
                 "icu_los_days", "age", "gender", "race", "suspected_infection_time",
                 "sepsis_time", "sofa_score", "acute_brain_injury", "alcohol_abuse",
                 "sae_eligible", "gcs_min_firstday", "first_low_gcs_time",
                 "sae_by_gcs_firstday", "first_delirium_time", "delirium_positive_firstday",
                 "sae_within_24h", *expo.exposure_names(), "icu_death")

RULES = (dic.BRAIN_RULE, dic.ALCOHOL_RULE)


# ---------------------------------------------------------------- stage 1

def first_stays(src) -> DataFrame:
    """U1: each patient's first stay by (intime, stay_id), NULL intime last."""
    first = first_per_entity(src["icustays"], ["subject_id"],
                             [c("intime").asc_nulls_last(), c("stay_id").asc_nulls_last()])
    return first.select("subject_id", "hadm_id", "stay_id", c("intime").alias("icu_intime"),
                        c("outtime").alias("icu_outtime"), c("los").alias("icu_los_days"))


def onset(src) -> DataFrame:
    """U3: per stay, earliest infection and score times and the highest score."""
    return onset_rollup(src["sepsis3"], "stay_id",
                        {"suspected_infection_time": "suspected_infection_time",
                         "sofa_time": "sepsis_time"},
                        {"sofa_score": "sofa_score"})


def _patients(src) -> DataFrame:
    return src["patients"].select("subject_id", "anchor_age", "anchor_year", "gender",
                                  c("dod").alias("death_time"))


def _admissions(src) -> DataFrame:
    return src["admissions"].select("hadm_id", "admittime", "deathtime", "race",
                                    "hospital_expire_flag")


def _age(df: DataFrame) -> DataFrame:
    return df.withColumn("age", anchored_age(c("anchor_age"), c("anchor_year"), c("admittime")))


def stay_ages(src, stays: DataFrame) -> DataFrame:
    """U4: stays with patient and admission attributes and the anchored age.

    Over all stays a patient may own very many of them, so patients and
    admissions are joined as key tables (broadcast when bounded, hot keys
    apart otherwise).
    """
    j = keyed_join(stays, _admissions(src), None, "hadm_id", "inner")
    j = keyed_join(j, _patients(src), None, "subject_id", "inner")
    return _age(j)


def base_cohort(src, materialized: bool = True) -> DataFrame:
    """U7: adult first stays with a sepsis onset (16 columns).

    The rank runs over all stays before the onset join and the age filter,
    so a patient whose first stay is not septic is out even if a later one is.
    Join order follows the partitioning: the rank leaves the stays hashed by
    patient, so the patient join needs no second shuffle of them; the onset
    roll-up arrives hashed by stay from its own aggregation.
    """
    b = (first_stays(src).join(_patients(src), "subject_id")
         .join(onset(src), "stay_id").join(_admissions(src), "hadm_id"))
    b = _age(b).where(c("age") >= 18).select(*BASE_COLUMNS)
    return materialize(b) if materialized else b


# ---------------------------------------------------------------- stages 2-6

def eligibility_hits(src, base: DataFrame) -> DataFrame:
    dx = narrowed(src["diagnoses_icd"], base, "hadm_id")
    return elig.code_flag_hits(dx, src["d_icd_diagnoses"], RULES, key="hadm_id")


def eligibility_hit_stays(src, base: DataFrame) -> DataFrame:
    """Stay ids of base stays whose admission has any condition hit.

    Diagnoses meet the base's (admission, stay) keys once, which both restricts
    them and brings the stay id; hits are aggregated by stay.  Beyond the broadcast
    bound hits are aggregated by admission before they meet the base.
    """
    keys, small = key_table(base, "hadm_id", "stay_id")
    if not small:
        hits = elig.code_flag_hits(src["diagnoses_icd"], src["d_icd_diagnoses"], RULES, key="hadm_id")
        return hits.select("hadm_id").join(keys, "hadm_id").select("stay_id")
    dx = src["diagnoses_icd"].join(keys, "hadm_id")
    return elig.code_flag_hits(dx, src["d_icd_diagnoses"], RULES, key="stay_id").select("stay_id")


def eligibility_stage(src, base: DataFrame) -> DataFrame:
    """U9-U11: every base stay with both condition flags and eligibility (smallint)."""
    return elig.eligibility(base, eligibility_hits(src, base), key="hadm_id",
                            carry=("stay_id",), names=[r.name for r in RULES])


def gcs_stage(src, base: DataFrame) -> DataFrame:
    """U16+U18 stage table."""
    return outcome.window_min(base, src["gcs"])


def delirium_features_stage(src, base: DataFrame) -> DataFrame:
    """U21 stage table."""
    return outcome.feature_rows(base, src["chartevents"])


def delirium_status_stage(src, base: DataFrame) -> DataFrame:
    """U22 stage table (built from the U21 rows, as the study does)."""
    return outcome.rule_status(base, delirium_features_stage(src, base))


def statin_rows(src, base: DataFrame) -> DataFrame:
    return expo.statin_rows(base, src["prescriptions"])


def statins_stage(src, base: DataFrame) -> DataFrame:
    """U24+U25 stage table."""
    return expo.drug_events(statin_rows(src, base))


def exposure_stage(src, base: DataFrame) -> DataFrame:
    """U26 stage table."""
    return expo.exposure_flags(base, statin_rows(src, base))


def mortality_stage(base: DataFrame) -> DataFrame:
    """U29: death inside [intime, outtime]; a NULL bound gives 0."""
    return base.select("stay_id", in_interval_flag(c("deathtime"), c("icu_intime"),
                                                   c("icu_outtime")).alias("icu_death"))


def composite_stage(src, base: DataFrame) -> DataFrame:
    """U30 over the base: both components and their OR (smallint)."""
    g = outcome.window_min_rollup(base, src["gcs"])
    d = outcome.cam_positive_rollup(base, src["chartevents"])
    j = base.select("stay_id").join(g, "stay_id", "left").join(d, "stay_id", "left")
    gcs_flag = flag(c("gcs_min_firstday") < dic.GCS_LOW_BELOW, "smallint")
    cam_flag = flag(c("first_delirium_time").isNotNull(), "smallint")
    return j.select("stay_id", gcs_flag.alias("sae_by_gcs_firstday"),
                    cam_flag.alias("delirium_positive_firstday"),
                    any_flag(gcs_flag, cam_flag).alias("sae_within_24h"))


# ---------------------------------------------------------------- stage 7

def cohort(src, base: DataFrame | None = None, written: dict | None = None) -> DataFrame:
    """U31: the final timestamp cohort, 32 columns, eligible stays only.

    ``written`` may hold the stage tables ``gcs``, ``delirium`` and ``exposure``
    of this base, and ``eligibility``; those are then read instead of the events
    and the diagnoses.

    Eligibility is an anti-join against stays whose admission has any
    condition hit (eligible = no hit), so the kept rows carry flags 0, 0 and
    1; the hits are mapped to stay ids first, so every join of the final
    cohort is on the stay key.  Each outcome and exposure roll-up holds one
    row per stay with data and is joined once; absent rows become 0 flags
    and NULL times.
    """
    b = base if base is not None else base_cohort(src)
    if written and "eligibility" in written:
        eligible = written["eligibility"].where(c("sae_eligible") == 1).select("stay_id")
        kept = b.join(eligible, "stay_id", "left_semi")
    else:
        kept = b.join(eligibility_hit_stays(src, b), "stay_id", "left_anti")
    if written:
        g = written["gcs"].select("stay_id", "gcs_min_firstday", "first_low_gcs_time")
        d = written["delirium"].select("stay_id", "first_delirium_time")
        e = written["exposure"]
    else:
        g = outcome.window_min_rollup(b, src["gcs"])
        d = outcome.cam_positive_rollup(b, src["chartevents"])
        e = expo.exposure_rollup(statin_rows(src, b))
    j = (kept.join(g, "stay_id", "left").join(d, "stay_id", "left")
             .join(e, "stay_id", "left"))
    gcs_flag = flag(c("gcs_min_firstday") < dic.GCS_LOW_BELOW, "smallint")
    cam_flag = flag(c("first_delirium_time").isNotNull(), "smallint")
    zero, one = F.lit(0).cast("smallint"), F.lit(1).cast("smallint")
    cols = {
        "acute_brain_injury": zero, "alcohol_abuse": zero, "sae_eligible": one,
        "sae_by_gcs_firstday": gcs_flag, "delirium_positive_firstday": cam_flag,
        "sae_within_24h": any_flag(gcs_flag, cam_flag),
        "icu_death": in_interval_flag(c("deathtime"), c("icu_intime"), c("icu_outtime")),
    }
    for n in expo.exposure_names():
        cols[n] = F.coalesce(c(n), F.lit(0)).cast("smallint")
    return j.select(*[cols[n].alias(n) if n in cols else c(n) for n in FINAL_COLUMNS])
