"""Declared input schemas of the clinical source tables, and a check.

The study reads fixed upstream schemas; nothing is inferred.  ``check_schema``
compares names and types of a DataFrame against one of these declarations
on the driver (metadata only, no job).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

L, I, S, D, TS = T.LongType(), T.IntegerType(), T.StringType(), T.DoubleType(), T.TimestampNTZType()
SH, DT = T.ShortType(), T.DateType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Timestamp model.
ICUSTAYS = _schema(("subject_id", L), ("hadm_id", L), ("stay_id", L), ("intime", TS),
                   ("outtime", TS), ("los", D))
SEPSIS3 = _schema(("stay_id", L), ("suspected_infection_time", TS), ("sofa_time", TS),
                  ("sofa_score", I))
PATIENTS = _schema(("subject_id", L), ("gender", S), ("anchor_age", I), ("anchor_year", I),
                   ("dod", DT))
ADMISSIONS = _schema(("hadm_id", L), ("admittime", TS), ("deathtime", TS), ("race", S),
                     ("hospital_expire_flag", SH))
DIAGNOSES_ICD = _schema(("hadm_id", L), ("icd_version", I), ("icd_code", S))
D_ICD_DIAGNOSES = _schema(("icd_code", S), ("icd_version", I), ("long_title", S))
GCS = _schema(("stay_id", L), ("charttime", TS), ("gcs", I))
CHARTEVENTS = _schema(("stay_id", L), ("charttime", TS), ("itemid", I), ("valuenum", D),
                      ("value", S))
PRESCRIPTIONS = _schema(("hadm_id", L), ("drug", S), ("drug_type", S), ("starttime", TS),
                        ("stoptime", TS))

# Offset model.
PATIENT = _schema(("uniquepid", S), ("patienthealthsystemstayid", L), ("patientunitstayid", L),
                  ("unitvisitnumber", I), ("hospitalid", L), ("unittype", S),
                  ("apacheadmissiondx", S), ("unitdischargeoffset", I),
                  ("hospitaldischargeyear", I), ("age", S), ("gender", S), ("ethnicity", S),
                  ("hospitaldischargestatus", S), ("unitdischargestatus", S))
HOSPITAL = _schema(("hospitalid", L), ("region", S))
DIAGNOSIS = _schema(("patientunitstayid", L), ("diagnosisstring", S), ("icd9code", S))
PASTHISTORY = _schema(("patientunitstayid", L), ("pasthistorypath", S))
NURSECHARTING = _schema(("patientunitstayid", L), ("nursingchartoffset", I),
                        ("nursingchartcelltypecat", S), ("nursingchartcelltypevallabel", S),
                        ("nursingchartcelltypevalname", S), ("nursingchartvalue", S))
ADMISSIONDRUG = _schema(("patientunitstayid", L), ("drugname", S))

SOURCES: dict[str, T.StructType] = {
    "icustays": ICUSTAYS, "sepsis3": SEPSIS3, "patients": PATIENTS, "admissions": ADMISSIONS,
    "diagnoses_icd": DIAGNOSES_ICD, "d_icd_diagnoses": D_ICD_DIAGNOSES, "gcs": GCS,
    "chartevents": CHARTEVENTS, "prescriptions": PRESCRIPTIONS,
    "patient": PATIENT, "hospital": HOSPITAL, "diagnosis": DIAGNOSIS,
    "pasthistory": PASTHISTORY, "nursecharting": NURSECHARTING, "admissiondrug": ADMISSIONDRUG,
}


class SchemaMismatch(ValueError):
    pass


def conform(df: DataFrame, expected: T.StructType, name: str = "table") -> DataFrame:
    """Select the declared columns of ``df`` cast to their declared types.

    For stored tables whose physical types differ (e.g. ``timestamp`` for
    ``timestamp_ntz``, ``int`` ids); a missing column still fails.
    """
    missing = [f.name for f in expected.fields if f.name not in df.columns]
    if missing:
        raise SchemaMismatch(f"{name}: missing columns {', '.join(missing)}")
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in expected.fields])


def check_schema(df: DataFrame, expected: T.StructType, name: str = "table") -> DataFrame:
    """Fail fast if ``df`` lacks a declared column or carries it with another type.

    Extra columns are allowed (they are pruned by the scans).  Returns ``df``
    so the check can sit inline in a pipeline.
    """
    actual = {f.name: f.dataType for f in df.schema.fields}
    problems = []
    for f in expected.fields:
        if f.name not in actual:
            problems.append(f"missing column {f.name}")
        elif actual[f.name] != f.dataType:
            problems.append(f"{f.name}: {actual[f.name].simpleString()} "
                            f"(expected {f.dataType.simpleString()})")
    if problems:
        raise SchemaMismatch(f"{name}: " + "; ".join(problems))
    return df
