"""Offset model: operator semantics on hand-written rows."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from wardline.functions.decode import decode_age, decode_by_substring
from wardline.functions import dictionaries as dic
from wardline.operators import eligibility as elig
from wardline.operators import exposure as expo
from wardline.operators import outcome
from wardline.plans import offset as off


def rows_by(df, key):
    return {r[key]: r for r in df.collect()}


def _patient(pid, stay, visit=1, hosp=1, apache=None, age="60", gender="Female",
             hstatus="Alive", ustatus="Alive", upid="p1"):
    return (upid, 5000 + stay, stay, visit, hosp, "MICU", apache, 100, 2014, age, gender, "A",
            hstatus, ustatus)


def test_base_decodes_and_first_visit(make):
    src = {
        "patient": make("patient", [
            _patient(1, 1, age="> 89"), _patient(1, 2, age=""), _patient(1, 3, age="17"),
            _patient(1, 4, age="18", gender="Male", hstatus="Expired", ustatus=""),
            _patient(1, 5, age="Unknown"), _patient(1, 6, age=None),
            _patient(1, 7, age="40", gender="Other", hosp=99, hstatus="", ustatus=None),
            _patient(1, 8, visit=2, age="40"),
            _patient(2, 9, age="40", gender=None, upid="p1")]),   # uniquepid may repeat
        "hospital": make("hospital", [(1, "Midwest")]),
    }
    base = rows_by(off.base_cohort(src, materialized=False), "patientunitstayid")
    assert set(base) == {1, 4, 7, 9}
    assert base[1]["age"] == 91 and base[4]["age"] == 18
    assert (base[1]["sex_male"], base[4]["sex_male"], base[7]["sex_male"], base[9]["sex_male"]) \
        == (0, 1, None, None)
    assert (base[4]["hosp_mort"], base[4]["icu_mort"]) == (1, None)
    assert (base[1]["hosp_mort"], base[7]["hosp_mort"]) == (0, None)
    assert base[7]["region"] is None and base[1]["region"] == "Midwest"


def test_text_decodes(spark):
    df = spark.createDataFrame([("> 89",), ("",), ("007",), ("18\n",), ("-1",), (None,),
                                ("99999999999",)], "t string")
    got = [r[0] for r in df.select(decode_age(F.col("t"))).collect()]
    assert got == [91, None, 7, None, None, None, None]
    df = spark.createDataFrame([("FEMALE",), ("male",), ("",), (None,)], "t string")
    got = [r[0] for r in df.select(decode_by_substring(F.col("t"), dic.SEX_MALE_DECODE)).collect()]
    assert got == [0, 1, None, None]


def _nc(stay, off_, value, label="Glasgow coma score", name="GCS Total", cat="Scores"):
    return (stay, off_, cat, label, name, value)


def test_offset_minimum_per_offset_before_validity(make):
    nc = make("nursecharting", [
        _nc(1, -1, "3"), _nc(1, 0, "14"), _nc(1, 1440, "13"), _nc(1, 1441, "3"),
        _nc(2, 10, "2"), _nc(2, 20, "2.5", "Score (Glasgow Coma Scale)", "Value"),
        _nc(3, 10, "15."), _nc(3, 20, "15.5", cat="Other Vital Signs and Infusions"),
        _nc(4, 10, "16"), _nc(4, 20, "-"), _nc(4, 30, "."), _nc(4, 40, "abc"), _nc(4, 50, " 14 "),
        _nc(5, 10, "-3"),
        _nc(6, 0, "1"), _nc(6, 0, "14"), _nc(6, 60, "14"),
        _nc(7, 0, "10", cat="Vital Signs"), _nc(7, 0, "10", name="Eyes"),
        _nc(7, 0, "10", label="Score (Glasgow Coma Scale)", name="GCS Total"),
        _nc(8, 5, "14.999"), _nc(8, 6, "15"),
        _nc(9, 30, "15"), _nc(9, 30, "Yes", "Pain Score", "Value")])
    got = rows_by(outcome.offset_min(nc), "patientunitstayid")
    assert set(got) == {1, 2, 3, 6, 8, 9}
    r = got[1]
    assert (r.gcs_min_firstday, r.first_gcs_offset, r.first_low_gcs_offset_firstday,
            r.sae_by_gcs_firstday) == (Decimal(13), 0, 0, 1)
    assert got[2].gcs_min_firstday == Decimal("2.5") and got[2].first_gcs_offset == 20
    assert got[3].gcs_min_firstday == Decimal(15) and got[3].sae_by_gcs_firstday == 0
    assert got[3].first_low_gcs_offset_firstday is None
    assert got[6].first_gcs_offset == 60 and got[6].gcs_min_firstday == Decimal(14)
    assert got[8].gcs_min_firstday == Decimal("14.999") and got[8].sae_by_gcs_firstday == 1
    assert got[9].gcs_min_firstday == Decimal(15)
    # The valid range has two whole digits: the widest decimal for it keeps 36 of the fraction.
    assert dict(outcome.offset_min(nc).dtypes)["gcs_min_firstday"] == "decimal(38,36)"


def test_scores_keep_all_their_digits(make):
    long = "14." + "123456789" * 3 + "123"                       # thirty fraction digits
    huge = "1" * 30 + "." + "7" * 30
    nc = make("nursecharting", [
        _nc(1, 10, long), _nc(1, 20, long + "1"), _nc(1, 30, "14.2"),
        _nc(2, 10, huge), _nc(2, 10, huge + "1"), _nc(2, 20, "-" + huge), _nc(2, 30, "15"),
        _nc(3, 10, "15." + "9" * 30), _nc(3, 20, "15." + "9" * 31), _nc(4, 10, "2." + "0" * 50 + "1")])
    got = rows_by(outcome.offset_min(nc), "patientunitstayid")
    assert got[1].gcs_min_firstday == Decimal(long) and got[1].first_low_gcs_offset_firstday == 10
    assert got[2].gcs_min_firstday == Decimal(15) and got[2].first_gcs_offset == 30
    assert got[3].gcs_min_firstday == Decimal("15." + "9" * 30)
    text = rows_by(outcome.offset_min(nc, as_text=True), "patientunitstayid")
    assert [text[i].gcs_min_firstday for i in (1, 2, 3, 4)] == [long, "15", "15." + "9" * 30, "2." + "0" * 50 + "1"]
    wide = rows_by(outcome.offset_min(nc, valid_open=(-10 ** 31, 10 ** 31), as_text=True), "patientunitstayid")
    assert wide[2].gcs_min_firstday == "-" + huge
    assert outcome.score_scale((-10 ** 31, 10 ** 31)) == 6


def test_charted_condition(make):
    nc = make("nursecharting", [
        (1, 10, "x", "Delirium Scale/Score", "Delirium Score", "yes"),
        (2, 10, "x", "Delirium Scale/Score", "Delirium Score", "no"),
        (3, 10, "x", "Delirium Scale/Score", "Delirium Score", None),
        (4, 10, "x", "Symptoms of Delirium Present", "Value", "no"),   # label alone is positive
        (5, 10, "x", "Other", "Value", "delirium"),
        (6, 1441, "x", "Delirium", "Value", "Y"), (6, 1440, "x", "Delirium", "Value", "Y"),
        (7, -1, "x", "Delirium", "Value", "TRUE"), (7, 0, "x", None, "delirium", "1"),
        (8, 100, "x", "CAM", "Value", "positive")])                    # no delirium mention
    got = rows_by(outcome.charted_first(nc), "patientunitstayid")
    assert set(got) == {1, 4, 6, 7}
    assert got[6].first_delirium_offset == 1440 and got[7].first_delirium_offset == 0
    assert got[1].delirium_firstday == 1


def test_sepsis_phrase_codes_and_guard(spark, make):
    base = spark.createDataFrame(
        [(i, None) for i in range(1, 16)] + [(20, "Sepsis, renal/UTI"), (21, None)],
        "patientunitstayid long, apacheadmissiondx string")
    dx = make("diagnosis", [
        (1, "infectious|sepsis", None), (2, "cardio|septic shock", None),
        (3, "rule out sepsis", None), (4, "r/o sepsis", None), (5, "history of sepsis", None),
        (6, "rule out sepsis", "995.92"),                       # the code still counts
        (7, None, "995.91"), (8, None, "995.911"), (9, None, "A41.9,995.92"),
        (10, None, "x995.92"), (11, None, "785.52"), (12, None, "038.9"), (13, None, "1038"),
        (14, None, "785.52\n"), (15, "Hx of Sepsis", "")])
    got = rows_by(elig.sepsis_flag(base, dx), "patientunitstayid")
    assert {k for k, r in got.items() if r.sepsis == 1} == {1, 2, 6, 7, 9, 11, 12, 20}
    assert got[21].sepsis == 0 and len(got) == 17


def test_eligibility_many_sources_without_fanout(spark, make):
    base = spark.createDataFrame(
        [(1, None), (2, None), (3, "Head only trauma"), (4, "Overdose, alcohol"), (5, None),
         (6, None)], "patientunitstayid long, apacheadmissiondx string")
    dx = make("diagnosis", [(1, "neurologic|stroke", None), (1, "gi", None), (1, "renal", None),
                            (5, "toxicology|alcohol withdrawal", None)])
    ph = make("pasthistory", [(2, "Seizures/seizures"), (2, "GI"), (6, "Social/alcoholism"),
                              (6, "Renal")])
    got = rows_by(elig.eligibility_multi(base, dx, ph), "patientunitstayid")
    neuro = {k for k, r in got.items() if r.acute_brain_injury_or_major_neuro == 1}
    alcohol = {k for k, r in got.items() if r.alcohol_abuse == 1}
    assert neuro == {1, 2, 3} and alcohol == {4, 5, 6}
    assert {k for k, r in got.items() if r.sae_eligible == 1} == set()
    assert len(got) == 6


def test_term_match_join_many_terms_per_row(spark, make):
    drugs = make("admissiondrug", [
        (1, "amlodipine / atorvastatin (Lipitor)"), (2, "simvastatin or rosuvastatin"),
        (3, "Nystatin"), (4, None), (5, "PRAVACHOL")])
    from wardline.functions.match import terms_frame
    m = expo.match_terms(drugs, dic.admission_statin_terms())
    as_frame = expo.match_terms(drugs, terms_frame(spark, dic.admission_statin_terms()))
    assert sorted(m.collect()) == sorted(as_frame.collect())
    got = sorted((r.patientunitstayid, r.generic_name, r.statin_type) for r in m.collect())
    assert got == [(1, "atorvastatin", "lipophilic"), (2, "rosuvastatin", "hydrophilic"),
                   (2, "simvastatin", "lipophilic"), (5, "pravastatin", "hydrophilic")]
    base = spark.createDataFrame([(i,) for i in range(1, 7)], "patientunitstayid long")
    flags = rows_by(expo.undated_exposure(base, m), "patientunitstayid")
    assert (flags[2].pre_statin, flags[2].pre_lipophilic_statin,
            flags[2].pre_hydrophilic_statin) == (1, 1, 1)
    assert flags[6].pre_statin == 0 and len(flags) == 6


def test_final_offset_cohort(make):
    src = {
        "patient": make("patient", [_patient(1, 1, apache="Sepsis, pulmonary"),
                                    _patient(2, 2, apache="Sepsis, pulmonary"),
                                    _patient(3, 3, apache="Cardiac arrest"),
                                    _patient(4, 4)]),
        "hospital": make("hospital", [(1, "West")]),
        "diagnosis": make("diagnosis", [(2, "neurologic|stroke", None), (4, None, "038.1")]),
        "pasthistory": make("pasthistory", []),
        "nursecharting": make("nursecharting", [_nc(1, 30, "14"), _nc(3, 30, "9")]),
        "admissiondrug": make("admissiondrug", [(4, "crestor")]),
    }
    out = off.cohort(src, base=off.base_cohort(src, materialized=False))
    assert out.columns == list(off.FINAL_COLUMNS) and len(out.columns) == 27
    got = rows_by(out, "patientunitstayid")
    assert set(got) == {1, 4}                      # 2 ineligible, 3 not septic
    assert got[1].sae_within_24h == 1 and got[1].gcs_min_firstday == Decimal(14)
    assert got[4].gcs_min_firstday is None and got[4].sae_by_gcs_firstday == 0
    assert got[4].delirium_firstday == 0 and got[4].statin_before_icu == 1
    assert got[4].hydrophilic_statin_before_icu == 1 and got[4].lipophilic_statin_before_icu == 0
    types = dict(out.dtypes)
    assert types["sae_eligible"] == "int" and types["delirium_firstday"] == "smallint"
