"""Deterministic adapter: driver tables -> clinical source shapes.

The driver ships TPC-H-like tables only, so every clinical source is derived
from them with integer arithmetic and ``CASE`` (FIXTURES.md §3).  Each
function returns a lazy DataFrame in the declared schema of
:mod:`wardline.sources.schemas`; nothing is materialised, so Catalyst prunes
the lineitem/orders columns each query needs and pushes filters to the scan.

Every table maps every row of its driver table.
"""

from __future__ import annotations

import weakref
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.sources import schemas
from wardline.sizes import note_rows
from wardline.sources.tables import read_table

c = F.col


def pick(index: Column, *values) -> Column:
    """``CASE index WHEN 0 THEN v0 WHEN 1 THEN v1 ... END`` (NULL beyond).

    Written as a lookup in a constant array: one array access per row and
    far less generated code than a chain of comparisons.
    """
    arr = F.array(*[F.lit(v) for v in values])
    if any(v is None for v in values):
        kind = "int" if all(isinstance(v, int) for v in values if v is not None) else "string"
        arr = arr.cast(f"array<{kind}>")
    return F.try_element_at(arr, (index + 1).cast("int"))


def _hours(n: Column | int, ts: Column) -> Column:
    return F.timestamp_add("HOUR", n if isinstance(n, Column) else F.lit(n), ts)


def _lines_with_orders(spark: SparkSession, sf_dir: str, *order_cols: str) -> DataFrame:
    """``lineitem l JOIN orders o ON l_orderkey = o_orderkey`` with pruned orders."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", *order_cols)
    lines = read_table(spark, sf_dir, "lineitem")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey, "inner")


# ---------------------------------------------------------------- timestamp model

def patients(spark, sf_dir):
    cu = read_table(spark, sf_dir, "customer")
    return cu.select(
        c("c_custkey").alias("subject_id"),
        pick(c("c_custkey") % 2, "M", "F").alias("gender"),
        (F.lit(10) + c("c_custkey") % 80).cast("int").alias("anchor_age"),
        F.lit(1995).alias("anchor_year"),
        F.lit(None).cast("date").alias("dod"),
    )


def icustays(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        c("o_custkey").alias("subject_id"),
        c("o_orderkey").alias("hadm_id"),
        (c("o_orderkey") + 30000000).alias("stay_id"),
        c("o_orderdate").alias("intime"),
        F.when(c("o_orderkey") % 11 == 0, F.lit(None))
         .otherwise(_hours((c("o_orderkey") % 5).cast("int") * 12, c("o_orderdate")))
         .alias("outtime"),
        ((c("o_orderkey") % 5).cast("double") / 2).alias("los"),
    )


def admissions(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    died = c("o_orderstatus") == "F"
    return o.select(
        c("o_orderkey").alias("hadm_id"),
        _hours(-24, c("o_orderdate")).alias("admittime"),
        F.when(died, _hours(24, c("o_orderdate"))).alias("deathtime"),
        c("o_orderpriority").alias("race"),
        F.when(died, 1).otherwise(0).cast("smallint").alias("hospital_expire_flag"),
    )


def sepsis3(spark, sf_dir):
    lo = _lines_with_orders(spark, sf_dir)
    # Lines of flag N belong to stays that no other table has.
    return lo.select(
        F.when(c("l_returnflag") == "N", -c("o_orderkey")).otherwise(c("o_orderkey") + 30000000)
        .alias("stay_id"),
        c("l_shipdate").alias("suspected_infection_time"),
        _hours(2, c("l_shipdate")).alias("sofa_time"),
        (F.lit(2) + c("l_linenumber")).alias("sofa_score"),
    )


def gcs(spark, sf_dir):
    lo = _lines_with_orders(spark, sf_dir, "o_orderdate")
    score = (F.lit(16) - F.least(c("l_partkey") % 16, c("l_suppkey") % 3)
             - F.when(c("l_partkey") % 9 == 0, 14).otherwise(0))
    return lo.select(
        (c("o_orderkey") + 30000000).alias("stay_id"),
        _hours((c("l_linenumber") - 1) * 6, c("o_orderdate")).alias("charttime"),
        F.when(c("l_partkey") % 13 == 0, F.lit(None)).otherwise(score.cast("int"))
         .cast("int").alias("gcs"),
    )


CHART_ITEMS = (228337, 228300, 229326, 228336, 228301, 229325, 228335, 228303, 229324,
               228302, 228334, 220045)


def chartevents(spark, sf_dir):
    lo = _lines_with_orders(spark, sf_dir, "o_orderdate")
    # Three chart rows per line item (j = 1, 3, 5): a generator, not a join.
    lo = lo.withColumn("j", F.explode(F.array(F.lit(1), F.lit(3), F.lit(5))))
    return lo.select(
        (c("o_orderkey") + 30000000).alias("stay_id"),
        _hours((c("l_linenumber") % 4) * 8, c("o_orderdate")).alias("charttime"),
        pick((c("l_partkey") * c("j") + c("l_suppkey")) % 12, *CHART_ITEMS).alias("itemid"),
        F.when(c("l_suppkey") % 7 == 0, F.lit(None))
         .otherwise((c("l_partkey") % 2).cast("double")).alias("valuenum"),
        pick(c("l_partkey") % 5, "Yes", "Positive (yes)", "UNABLE TO ASSESS - sedated", "No",
             None).alias("value"),
    )


ICD_CODES = ("4019", "25000", "42731", "430", "3453", "80121", "E8001", "2910", "30503", "486",
             "5849", "0389", "I10", "E11.9", "N17.9", "i63.9", "I679", "F10.20", "G41", "S06.5",
             "J18.9", "A41.9", "K70.3", "Z51")


def diagnoses_icd(spark, sf_dir):
    lo = _lines_with_orders(spark, sf_dir)
    return lo.select(
        c("o_orderkey").alias("hadm_id"),
        F.when(c("l_linenumber") % 2 == 0, 9).otherwise(10).alias("icd_version"),
        pick(c("l_partkey") % 24, *ICD_CODES).alias("icd_code"),
    )


ICD_DICTIONARY = (("4019", 9, "Unspecified essential hypertension"),
                  ("I10", 10, "Essential hypertension"),
                  ("K70.3", 10, "Alcohol-related cirrhosis"),
                  ("J18.9", 10, "Pneumonia"),
                  ("486", 9, "Epidural abscess note"),
                  ("A41.9", 10, None))


def d_icd_diagnoses(spark, sf_dir):
    df = spark.createDataFrame(list(ICD_DICTIONARY), schema=schemas.D_ICD_DIAGNOSES)
    return note_rows(df, len(ICD_DICTIONARY))


DRUGS = ("Atorvastatin 40mg", "LIPITOR", "Zocor", "Simvastatin", "Lovastatin", "Livalo",
         "Lescol XL", "Pravachol", "Rosuvastatin", "Crestor", "Nystatin", "Heparin", "Aspirin",
         "Insulin", "Vancomycin", None)


def prescriptions(spark, sf_dir):
    lo = _lines_with_orders(spark, sf_dir, "o_orderdate")
    return lo.select(
        c("o_orderkey").alias("hadm_id"),
        F.when(c("l_partkey") % 3 == 0, pick(c("l_partkey") % 16, *DRUGS))
         .otherwise("Sodium chloride 0.9%").alias("drug"),
        pick(c("l_suppkey") % 4, "MAIN", "BASE", "ADDITIVE", None).alias("drug_type"),
        F.when(c("l_suppkey") % 10 == 0, F.lit(None))
         .otherwise(_hours((c("l_linenumber") - 4) * 6, c("o_orderdate"))).alias("starttime"),
        _hours(c("l_linenumber") * 6, c("o_orderdate")).alias("stoptime"),
    )


# ------------------------------------------------------------------- offset model

APACHE_DX = ("Sepsis, pulmonary", "CVA, cerebrovascular accident/stroke", "Overdose, alcohol",
             "Cardiac arrest", None, "Sepsis, renal/UTI", "Head only trauma")


def patient(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    k, cust = c("o_orderkey"), c("o_custkey")
    return o.select(
        F.concat(F.lit("p"), cust.cast("string")).alias("uniquepid"),
        (k + 50000000).alias("patienthealthsystemstayid"),
        k.alias("patientunitstayid"),
        F.when(k % 4 == 0, 2).otherwise(1).alias("unitvisitnumber"),
        (cust % 30).alias("hospitalid"),
        c("o_orderpriority").alias("unittype"),
        pick(k % 7, *APACHE_DX).alias("apacheadmissiondx"),
        ((k % 97) * 60).cast("int").alias("unitdischargeoffset"),
        (F.lit(2014) + k % 2).cast("int").alias("hospitaldischargeyear"),
        F.when(k % 13 == 0, "> 89").when(k % 17 == 0, "").when(k % 19 == 0, "Unknown")
         .otherwise((F.lit(10) + cust % 80).cast("string")).alias("age"),
        pick(cust % 4, "Female", "Male", "Unknown", None).alias("gender"),
        pick(cust % 3, "A", "B", "C").alias("ethnicity"),
        pick(k % 3, "Alive", "Expired", "").alias("hospitaldischargestatus"),
        pick(k % 5, "Alive", "Alive", "Expired", "Alive", None).alias("unitdischargestatus"),
    )


def hospital(spark, sf_dir):
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        c("n_nationkey").cast("bigint").alias("hospitalid"), c("r_name").alias("region"))


DIAGNOSIS_STRINGS = ("cardiovascular|shock / hypotension|septic shock", "infectious diseases|sepsis",
                     "rule out sepsis", "history of sepsis", "neurologic|stroke",
                     "pulmonary|pneumonia", "renal|AKI", "toxicology|alcohol withdrawal", None,
                     "endocrine|DM", "burns/trauma|head trauma", "gi|bleeding")
DIAGNOSIS_CODES = ("995.91, A41.9", "995.911", "785.52", "038.9, A41.9", "486, J18.9", None, "",
                   "x995.92", "584.9,995.92", "401.9")


def diagnosis(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    # Two thirds of the lines belong to stays that no other table has.
    return li.select(
        F.when(c("l_suppkey") % 3 == 0, c("l_orderkey")).otherwise(-c("l_orderkey"))
         .alias("patientunitstayid"),
        pick(c("l_partkey") % 12, *DIAGNOSIS_STRINGS).alias("diagnosisstring"),
        pick(c("l_suppkey") % 10, *DIAGNOSIS_CODES).alias("icd9code"),
    )


HISTORY_PATHS = ("Organ Systems/Neurologic/Strokes/stroke - date unknown",
                 "Cardiovascular/Hypertension", "Pulmonary/COPD", "Social/alcoholism",
                 "NoPastHistory", "Renal", "Endocrine", "Seizures/seizures", "GI")


def pasthistory(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        c("l_orderkey").alias("patientunitstayid"),
        F.when(c("l_linenumber") <= 2, pick(c("l_suppkey") % 9, *HISTORY_PATHS))
         .otherwise("Gastrointestinal/reflux").alias("pasthistorypath"),
    )


CHART_LABELS = ("Glasgow coma score", "Score (Glasgow Coma Scale)", "Delirium Scale/Score",
                "Glasgow coma score", "Score (Glasgow Coma Scale)", "Pain Score",
                "Symptoms of Delirium Present", "Glasgow coma score")
CHART_NAMES = ("GCS Total", "Value", "Delirium Score", "Eyes", "Value", "Value", "Value",
               "GCS Total")
SCORE_TEXTS = ("15", "14", "15", "15.", "2", "2.5", "10", "-", "abc", "16", "15.5", "15", None,
               "14.9999999999999999999", "2.0000000000000000001", "-10000000000000000000000000")
ANSWER_TEXTS = ("Yes", "no", "Y", "Positive", "N/A")


def nursecharting(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    part8 = c("l_partkey") % 8
    return li.select(
        c("l_orderkey").alias("patientunitstayid"),
        ((c("l_linenumber") - 1) * 360).alias("nursingchartoffset"),
        pick(c("l_suppkey") % 3, "Scores", "Other Vital Signs and Infusions", "Vital Signs")
         .alias("nursingchartcelltypecat"),
        pick(part8, *CHART_LABELS).alias("nursingchartcelltypevallabel"),
        pick(part8, *CHART_NAMES).alias("nursingchartcelltypevalname"),
        F.when(part8.isin(0, 1, 3, 4, 7),
               pick((c("l_partkey") + c("l_suppkey")) % 16, *SCORE_TEXTS))
         .otherwise(pick(c("l_suppkey") % 5, *ANSWER_TEXTS)).alias("nursingchartvalue"),
    )


DRUG_NAMES = ("LIPITOR 40 MG", "atorvastatin", "Zocor", "simvastatin 20mg", "lovastatin",
              "Livalo", "lescol", "Pravachol", "rosuvastatin", "CRESTOR", "Nystatin",
              "amlodipine / atorvastatin (Lipitor)", "simvastatin or rosuvastatin", None,
              "aspirin")


def admissiondrug(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        c("l_orderkey").alias("patientunitstayid"),
        F.when(c("l_linenumber") <= 2, pick(c("l_partkey") % 30, *DRUG_NAMES))
         .otherwise("omeprazole").alias("drugname"),
    )


BUILDERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "icustays": icustays, "sepsis3": sepsis3, "patients": patients, "admissions": admissions,
    "diagnoses_icd": diagnoses_icd, "d_icd_diagnoses": d_icd_diagnoses, "gcs": gcs,
    "chartevents": chartevents, "prescriptions": prescriptions,
    "patient": patient, "hospital": hospital, "diagnosis": diagnosis,
    "pasthistory": pasthistory, "nursecharting": nursecharting, "admissiondrug": admissiondrug,
}


class Sources(dict):
    """Lazy ``name -> DataFrame`` map of clinical sources built on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self.spark, self.sf_dir = spark, sf_dir

    def __missing__(self, name: str) -> DataFrame:
        df = schemas.check_schema(BUILDERS[name](self.spark, self.sf_dir),
                                  schemas.SOURCES[name], name)
        self[name] = df
        return df


_CACHE: "weakref.WeakKeyDictionary[SparkSession, dict[str, Sources]]" = weakref.WeakKeyDictionary()


def sources(spark: SparkSession, sf_dir: str) -> Sources:
    """The source map of ``sf_dir``, shared by all queries of one session.

    DataFrames are immutable lazy plans, so reusing them only saves the
    driver-side work of building and analysing them again.
    """
    per_session = _CACHE.setdefault(spark, {})
    if sf_dir not in per_session:
        per_session[sf_dir] = Sources(spark, sf_dir)
    return per_session[sf_dir]
