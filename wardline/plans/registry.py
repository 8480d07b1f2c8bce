"""One callable per operator query: ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver tables of ``sf_dir`` through the adapter, over
whole tables; nothing is sampled or capped.  Stage-table queries use the
study's own base cohort; ``first_day_min_score`` runs on all first stays
(no age or sepsis filter) so that the window operator sees every patient.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.functions import dictionaries as dic
from wardline.functions.match import terms_frame
from wardline.operators import code_rules
from wardline.operators import eligibility as elig
from wardline.operators import exposure as expo
from wardline.operators import outcome
from wardline.operators import patterns
from wardline.operators.joins import materialize
from wardline.operators.summary import cohort_summary
from wardline.plans import offset as off
from wardline.plans import timestamped as ts
from wardline.sources.adapter import sources

c = F.col
Query = Callable[[SparkSession, str], DataFrame]


def first_stay_per_patient(spark, sf_dir):
    return ts.first_stays(sources(spark, sf_dir))


def first_visit_base(spark, sf_dir):
    return off.base_cohort(sources(spark, sf_dir), materialized=False)


def onset_rollup(spark, sf_dir):
    return ts.onset(sources(spark, sf_dir))


def anchored_age(spark, sf_dir):
    src = sources(spark, sf_dir)
    stays = src["icustays"].select("subject_id", "hadm_id", "stay_id")
    return (ts.stay_ages(src, stays).where(c("age") >= 18)
              .select("stay_id", "subject_id", "hadm_id", "age"))


def decode_demographics(spark, sf_dir):
    return off.decoded_patients(sources(spark, sf_dir))


def base_cohort_ts(spark, sf_dir):
    return ts.base_cohort(sources(spark, sf_dir), materialized=False)


def describe_codes(spark, sf_dir):
    src = sources(spark, sf_dir)
    return elig.describe_codes(src["diagnoses_icd"], src["d_icd_diagnoses"])


def code_rule_flags(spark, sf_dir):
    src = sources(spark, sf_dir)
    described = elig.describe_codes(src["diagnoses_icd"], src["d_icd_diagnoses"])
    return elig.code_flags(described, ts.RULES)


def eligibility_codes(spark, sf_dir):
    src = sources(spark, sf_dir)
    return ts.eligibility_stage(src, ts.base_cohort(src))


def phrase_flag(spark, sf_dir):
    dx = sources(spark, sf_dir)["diagnosis"]
    return elig.rollup_flags(dx, "patientunitstayid",
                             {"sepsis_phrase": elig.sepsis_phrase(elig.low_text("diagnosisstring"))},
                             hits_only=False)


def list_code_flag(spark, sf_dir):
    dx = sources(spark, sf_dir)["diagnosis"]
    codes = F.coalesce(c("icd9code"), F.lit(""))
    return elig.rollup_flags(dx, "patientunitstayid", {"sepsis_code": elig.sepsis_codes(codes)},
                             hits_only=False)


def sepsis_documented(spark, sf_dir):
    src = sources(spark, sf_dir)
    return off.sepsis_stage(src, off.base_cohort(src))


def eligibility_multi_source(spark, sf_dir):
    src = sources(spark, sf_dir)
    return off.eligibility_stage(src, off.base_cohort(src))


def first_day_min_score(spark, sf_dir):
    src = sources(spark, sf_dir)
    return outcome.window_min(materialize(ts.first_stays(src)), src["gcs"])


def first_day_min_score_offset(spark, sf_dir):
    return off.gcs_stage(sources(spark, sf_dir))


def cam_feature_rows(spark, sf_dir):
    src = sources(spark, sf_dir)
    return ts.delirium_features_stage(src, ts.base_cohort(src))


def cam_status(spark, sf_dir):
    src = sources(spark, sf_dir)
    return ts.delirium_status_stage(src, ts.base_cohort(src))


def charted_condition_first(spark, sf_dir):
    return off.delirium_stage(sources(spark, sf_dir))


def classify_drugs(spark, sf_dir):
    rx = sources(spark, sf_dir)["prescriptions"]
    return expo.classify_drugs(rx).select("hadm_id", "drug", "statin_type", "statin_class")


def drug_events(spark, sf_dir):
    src = sources(spark, sf_dir)
    return ts.statins_stage(src, ts.base_cohort(src))


def pre_index_exposure(spark, sf_dir):
    src = sources(spark, sf_dir)
    return ts.exposure_stage(src, ts.base_cohort(src))


def term_match_join(spark, sf_dir):
    return off.term_matches(sources(spark, sf_dir))


def term_match_table(spark, sf_dir):
    """U27 with the terms as a pattern table."""
    drugs = sources(spark, sf_dir)["admissiondrug"]
    return expo.match_terms(drugs, terms_frame(spark, dic.admission_statin_terms()))


def classify_drugs_table(spark, sf_dir):
    """U24 with the terms as a pattern table."""
    terms = [(i, generic, cls, t) for i, (generic, cls, group) in enumerate(dic.STATIN_TERMS_PRIORITY) for t in group]
    table = spark.createDataFrame(terms, "priority int, generic_name string, statin_type string, match_term string")
    rx = sources(spark, sf_dir)["prescriptions"].select("hadm_id", "drug")
    return patterns.classify_rows(rx, "drug", table)


def text_flags_table(spark, sf_dir):
    """U12 and the diagnosis lists of U15 as one pattern table: every flag of a stay by its diagnosis texts."""
    rows = ([("sepsis", True, t) for t in dic.SEPSIS_DIAGNOSIS_TERMS]
            + [("sepsis", False, t) for t in dic.SEPSIS_EXCLUDE_PHRASES]
            + [("neuro", True, t) for t in dic.NEURO_DIAGNOSIS_TERMS]
            + [("alcohol", True, t) for t in dic.ALCOHOL_DIAGNOSIS_TERMS])
    table = spark.createDataFrame(rows, "flag string, include boolean, pattern string")
    dx = sources(spark, sf_dir)["diagnosis"]
    return patterns.flag_rows(dx, "patientunitstayid", elig.low_text("diagnosisstring"), table)


def code_rule_table(spark, sf_dir):
    """U10 with rules and title terms as tables: the rules that an admission satisfies."""
    src = sources(spark, sf_dir)
    return code_rules.rule_hits(src["diagnoses_icd"], code_rules.rules_frame(spark, ts.RULES),
                                dictionary=src["d_icd_diagnoses"], titles=code_rules.titles_frame(spark, ts.RULES))


def undated_exposure(spark, sf_dir):
    src = sources(spark, sf_dir)
    return off.exposure_stage(src, off.base_cohort(src))


def death_in_interval(spark, sf_dir):
    return ts.mortality_stage(ts.base_cohort(sources(spark, sf_dir), materialized=False))


def composite_outcome(spark, sf_dir):
    src = sources(spark, sf_dir)
    return ts.composite_stage(src, ts.base_cohort(src))


def cohort_timestamped(spark, sf_dir):
    return ts.cohort(sources(spark, sf_dir))


def cohort_offset(spark, sf_dir):
    return off.cohort(sources(spark, sf_dir))


def cohort_summaries(spark, sf_dir):
    src = sources(spark, sf_dir)
    return (cohort_summary(ts.cohort(src), "timestamped")
            .unionByName(cohort_summary(off.cohort(src), "offset")))


QUERIES: dict[str, Query] = {
    "first_stay_per_patient": first_stay_per_patient,
    "first_visit_base": first_visit_base,
    "onset_rollup": onset_rollup,
    "anchored_age": anchored_age,
    "decode_demographics": decode_demographics,
    "base_cohort_ts": base_cohort_ts,
    "describe_codes": describe_codes,
    "code_rule_flags": code_rule_flags,
    "eligibility_codes": eligibility_codes,
    "phrase_flag": phrase_flag,
    "list_code_flag": list_code_flag,
    "sepsis_documented": sepsis_documented,
    "eligibility_multi_source": eligibility_multi_source,
    "first_day_min_score": first_day_min_score,
    "first_day_min_score_offset": first_day_min_score_offset,
    "cam_feature_rows": cam_feature_rows,
    "cam_status": cam_status,
    "charted_condition_first": charted_condition_first,
    "classify_drugs": classify_drugs,
    "drug_events": drug_events,
    "pre_index_exposure": pre_index_exposure,
    "term_match_join": term_match_join,
    "term_match_table": term_match_table,
    "classify_drugs_table": classify_drugs_table,
    "text_flags_table": text_flags_table,
    "code_rule_table": code_rule_table,
    "undated_exposure": undated_exposure,
    "death_in_interval": death_in_interval,
    "composite_outcome": composite_outcome,
    "cohort_timestamped": cohort_timestamped,
    "cohort_offset": cohort_offset,
    "cohort_summary": cohort_summaries,
}
