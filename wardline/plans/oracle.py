"""Independent DuckDB SQL for every registered query (the correctness oracle).

Two parts:

* ``ADAPTER``: the FIXTURES.md adapter as SQL over the driver's views.  It
  is *input* (the same derivation the Spark adapter performs), shared text.
* ``FRAGMENTS`` / ``QUERIES``: the operator semantics written directly in
  SQL, not generated from the Spark code.  Every query is assembled as one
  ``WITH`` statement that pulls in the fragments it depends on.

Type notes (DuckDB vs Spark): ``year()`` and ``sum`` are widened by DuckDB,
so ages are cast to INTEGER and sums to BIGINT; flags are cast to the
study's SMALLINT / INTEGER; the charted score is DECIMAL(38,36), taken from its digits.

Column lists, item ids, codes, term and label values are fixed values of the
study and of the adapter: they must equal it for right results.
"""

from __future__ import annotations


def _lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return str(v)


def pick(expr: str, *values) -> str:
    arms = " ".join(f"WHEN {i} THEN {_lit(v)}" for i, v in enumerate(values))
    return f"CASE ({expr}) {arms} END"


L_JOIN_O = "lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"

# --------------------------------------------------------------------------- adapter (input)

ADAPTER = {
    "patients": f"""
SELECT c_custkey AS subject_id, {pick('c_custkey % 2', 'M', 'F')} AS gender,
       CAST(10 + c_custkey % 80 AS INTEGER) AS anchor_age, 1995 AS anchor_year,
       CAST(NULL AS DATE) AS dod
FROM customer""",
    "icustays": """
SELECT o_custkey AS subject_id, o_orderkey AS hadm_id, o_orderkey + 30000000 AS stay_id,
       o_orderdate AS intime,
       CASE WHEN o_orderkey % 11 = 0 THEN NULL
            ELSE o_orderdate + CAST(o_orderkey % 5 AS INTEGER) * INTERVAL '12' HOUR END AS outtime,
       CAST(o_orderkey % 5 AS DOUBLE) / 2 AS los
FROM orders""",
    "admissions": """
SELECT o_orderkey AS hadm_id, o_orderdate - INTERVAL '24' HOUR AS admittime,
       CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL '24' HOUR END AS deathtime,
       o_orderpriority AS race,
       CAST(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS SMALLINT) AS hospital_expire_flag
FROM orders""",
    "sepsis3": f"""
SELECT CASE WHEN l_returnflag = 'N' THEN -o_orderkey ELSE o_orderkey + 30000000 END AS stay_id,
       l_shipdate AS suspected_infection_time,
       l_shipdate + INTERVAL '2' HOUR AS sofa_time, 2 + l_linenumber AS sofa_score
FROM {L_JOIN_O}""",
    "gcs": f"""
SELECT o_orderkey + 30000000 AS stay_id,
       o_orderdate + (l_linenumber - 1) * INTERVAL '6' HOUR AS charttime,
       CASE WHEN l_partkey % 13 = 0 THEN NULL
            ELSE CAST(16 - least(l_partkey % 16, l_suppkey % 3)
                      - (CASE WHEN l_partkey % 9 = 0 THEN 14 ELSE 0 END) AS INTEGER) END AS gcs
FROM {L_JOIN_O}""",
    "chartevents": f"""
SELECT o_orderkey + 30000000 AS stay_id,
       o_orderdate + ((l_linenumber % 4) * 8) * INTERVAL '1' HOUR AS charttime,
       {pick('(l_partkey * j + l_suppkey) % 12', 228337, 228300, 229326, 228336, 228301, 229325,
             228335, 228303, 229324, 228302, 228334, 220045)} AS itemid,
       CASE WHEN l_suppkey % 7 = 0 THEN NULL ELSE CAST(l_partkey % 2 AS DOUBLE) END AS valuenum,
       {pick('l_partkey % 5', 'Yes', 'Positive (yes)', 'UNABLE TO ASSESS - sedated', 'No', None)}
         AS value
FROM {L_JOIN_O} CROSS JOIN (VALUES (1), (3), (5)) t(j)""",
    "diagnoses_icd": f"""
SELECT o_orderkey AS hadm_id, CASE WHEN l_linenumber % 2 = 0 THEN 9 ELSE 10 END AS icd_version,
       {pick('l_partkey % 24', '4019', '25000', '42731', '430', '3453', '80121', 'E8001', '2910',
             '30503', '486', '5849', '0389', 'I10', 'E11.9', 'N17.9', 'i63.9', 'I679', 'F10.20',
             'G41', 'S06.5', 'J18.9', 'A41.9', 'K70.3', 'Z51')} AS icd_code
FROM {L_JOIN_O}""",
    "d_icd_diagnoses": """
SELECT * FROM (VALUES ('4019', 9, 'Unspecified essential hypertension'),
                      ('I10', 10, 'Essential hypertension'),
                      ('K70.3', 10, 'Alcohol-related cirrhosis'),
                      ('J18.9', 10, 'Pneumonia'),
                      ('486', 9, 'Epidural abscess note'),
                      ('A41.9', 10, CAST(NULL AS VARCHAR))) t(icd_code, icd_version, long_title)""",
    "prescriptions": f"""
SELECT o_orderkey AS hadm_id,
       CASE WHEN l_partkey % 3 = 0 THEN
       {pick('l_partkey % 16', 'Atorvastatin 40mg', 'LIPITOR', 'Zocor', 'Simvastatin',
             'Lovastatin', 'Livalo', 'Lescol XL', 'Pravachol', 'Rosuvastatin', 'Crestor',
             'Nystatin', 'Heparin', 'Aspirin', 'Insulin', 'Vancomycin', None)}
       ELSE 'Sodium chloride 0.9%' END AS drug,
       {pick('l_suppkey % 4', 'MAIN', 'BASE', 'ADDITIVE', None)} AS drug_type,
       CASE WHEN l_suppkey % 10 = 0 THEN NULL
            ELSE o_orderdate + (l_linenumber - 4) * INTERVAL '6' HOUR END AS starttime,
       o_orderdate + l_linenumber * INTERVAL '6' HOUR AS stoptime
FROM {L_JOIN_O}""",
    "patient": f"""
SELECT concat('p', CAST(o_custkey AS VARCHAR)) AS uniquepid,
       o_orderkey + 50000000 AS patienthealthsystemstayid, o_orderkey AS patientunitstayid,
       CASE WHEN o_orderkey % 4 = 0 THEN 2 ELSE 1 END AS unitvisitnumber,
       o_custkey % 30 AS hospitalid, o_orderpriority AS unittype,
       {pick('o_orderkey % 7', 'Sepsis, pulmonary', 'CVA, cerebrovascular accident/stroke',
             'Overdose, alcohol', 'Cardiac arrest', None, 'Sepsis, renal/UTI',
             'Head only trauma')} AS apacheadmissiondx,
       CAST((o_orderkey % 97) * 60 AS INTEGER) AS unitdischargeoffset,
       CAST(2014 + o_orderkey % 2 AS INTEGER) AS hospitaldischargeyear,
       CASE WHEN o_orderkey % 13 = 0 THEN '> 89' WHEN o_orderkey % 17 = 0 THEN ''
            WHEN o_orderkey % 19 = 0 THEN 'Unknown'
            ELSE CAST(10 + o_custkey % 80 AS VARCHAR) END AS age,
       {pick('o_custkey % 4', 'Female', 'Male', 'Unknown', None)} AS gender,
       {pick('o_custkey % 3', 'A', 'B', 'C')} AS ethnicity,
       {pick('o_orderkey % 3', 'Alive', 'Expired', '')} AS hospitaldischargestatus,
       {pick('o_orderkey % 5', 'Alive', 'Alive', 'Expired', 'Alive', None)} AS unitdischargestatus
FROM orders""",
    "hospital": """
SELECT CAST(n_nationkey AS BIGINT) AS hospitalid, r_name AS region
FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "diagnosis": f"""
SELECT CASE WHEN l_suppkey % 3 = 0 THEN l_orderkey ELSE -l_orderkey END AS patientunitstayid,
       {pick('l_partkey % 12', 'cardiovascular|shock / hypotension|septic shock',
             'infectious diseases|sepsis', 'rule out sepsis', 'history of sepsis',
             'neurologic|stroke', 'pulmonary|pneumonia', 'renal|AKI',
             'toxicology|alcohol withdrawal', None, 'endocrine|DM', 'burns/trauma|head trauma',
             'gi|bleeding')} AS diagnosisstring,
       {pick('l_suppkey % 10', '995.91, A41.9', '995.911', '785.52', '038.9, A41.9',
             '486, J18.9', None, '', 'x995.92', '584.9,995.92', '401.9')} AS icd9code
FROM lineitem""",
    "pasthistory": f"""
SELECT l_orderkey AS patientunitstayid,
       CASE WHEN l_linenumber <= 2 THEN
       {pick('l_suppkey % 9', 'Organ Systems/Neurologic/Strokes/stroke - date unknown',
             'Cardiovascular/Hypertension', 'Pulmonary/COPD', 'Social/alcoholism',
             'NoPastHistory', 'Renal', 'Endocrine', 'Seizures/seizures', 'GI')}
       ELSE 'Gastrointestinal/reflux' END AS pasthistorypath
FROM lineitem""",
    "nursecharting": f"""
SELECT l_orderkey AS patientunitstayid, (l_linenumber - 1) * 360 AS nursingchartoffset,
       {pick('l_suppkey % 3', 'Scores', 'Other Vital Signs and Infusions', 'Vital Signs')}
         AS nursingchartcelltypecat,
       {pick('l_partkey % 8', 'Glasgow coma score', 'Score (Glasgow Coma Scale)',
             'Delirium Scale/Score', 'Glasgow coma score', 'Score (Glasgow Coma Scale)',
             'Pain Score', 'Symptoms of Delirium Present', 'Glasgow coma score')}
         AS nursingchartcelltypevallabel,
       {pick('l_partkey % 8', 'GCS Total', 'Value', 'Delirium Score', 'Eyes', 'Value', 'Value',
             'Value', 'GCS Total')} AS nursingchartcelltypevalname,
       CASE WHEN l_partkey % 8 IN (0, 1, 3, 4, 7)
            THEN {pick('(l_partkey + l_suppkey) % 16', '15', '14', '15', '15.', '2', '2.5', '10',
                       '-', 'abc', '16', '15.5', '15', None, '14.9999999999999999999',
                       '2.0000000000000000001', '-10000000000000000000000000')}
            ELSE {pick('l_suppkey % 5', 'Yes', 'no', 'Y', 'Positive', 'N/A')} END
         AS nursingchartvalue
FROM lineitem""",
    "admissiondrug": f"""
SELECT l_orderkey AS patientunitstayid,
       CASE WHEN l_linenumber <= 2 THEN
       {pick('l_partkey % 30', 'LIPITOR 40 MG', 'atorvastatin', 'Zocor', 'simvastatin 20mg',
             'lovastatin', 'Livalo', 'lescol', 'Pravachol', 'rosuvastatin', 'CRESTOR',
             'Nystatin', 'amlodipine / atorvastatin (Lipitor)', 'simvastatin or rosuvastatin',
             None, 'aspirin')} ELSE 'omeprazole' END AS drugname
FROM lineitem""",
}

# --------------------------------------------------------------------------- oracle fragments
# Fixed values.  The code lists, term alternations, item ids and labels below
# must equal the study's definitions (the same values as
# wardline/functions/dictionaries.py, written out again for the independent
# oracle), in the order the study lists them.

FIRST_DAY_END = "least(s.icu_outtime, s.icu_intime + INTERVAL 24 HOUR)"

BRAIN_SQL = """(
    (icd_version = 10 AND (left(code, 3) IN ('G00','G01','G02','G03','G04','G41','S06',
                                              'I60','I61','I62','I63','I64')
                           OR left(code, 3) BETWEEN 'I65' AND 'I69'))
 OR (icd_version = 9 AND (left(code, 3) BETWEEN '320' AND '323' OR left(code, 4) = '3453'
                          OR left(code, 3) BETWEEN '430' AND '438'
                          OR left(code, 3) BETWEEN '800' AND '804'
                          OR left(code, 3) BETWEEN '850' AND '854'))
 OR regexp_matches(title, 'meningitis|encephalitis|status epilepticus|traumatic brain injury|intracranial hemorrhage|subarachnoid hemorrhage|subdural|epidural|cerebral infarction|ischemic stroke|haemorrhagic stroke|hemorrhagic stroke|cerebrovascular accident'))"""

ALCOHOL_SQL = """(
    (icd_version = 10 AND left(code, 3) = 'F10')
 OR (icd_version = 9 AND (left(code, 3) IN ('291', '303') OR left(code, 4) = '3050'))
 OR regexp_matches(title, 'alcohol abuse|alcohol dependence|alcohol withdrawal|alcohol intoxication|alcoholism|alcohol-related'))"""

STATIN_TYPE_SQL = """CASE
    WHEN regexp_matches(lower(drug), 'atorvastatin|lipitor|atorvaliq') THEN 'atorvastatin'
    WHEN regexp_matches(lower(drug), 'simvastatin|zocor|flolipid|cholesnone|vytorin') THEN 'simvastatin'
    WHEN regexp_matches(lower(drug), 'lovastatin|mevacor|altoprev|altocor') THEN 'lovastatin'
    WHEN regexp_matches(lower(drug), 'pitavastatin|livalo|zypitamag|livazo|alipza') THEN 'pitavastatin'
    WHEN regexp_matches(lower(drug), 'fluvastatin|lescol') THEN 'fluvastatin'
    WHEN regexp_matches(lower(drug), 'pravastatin|pravachol|lipostat|mevalotin') THEN 'pravastatin'
    WHEN regexp_matches(lower(drug), 'rosuvastatin|crestor|vivacor|roszet') THEN 'rosuvastatin'
  END"""

STATIN_CLASS_SQL = """CASE
    WHEN regexp_matches(lower(drug), 'atorvastatin|lipitor|atorvaliq|simvastatin|zocor|flolipid|cholesnone|vytorin|lovastatin|mevacor|altoprev|altocor|pitavastatin|livalo|zypitamag|livazo|alipza|fluvastatin|lescol') THEN 'lipophilic'
    WHEN regexp_matches(lower(drug), 'pravastatin|pravachol|lipostat|mevalotin|rosuvastatin|crestor|vivacor|roszet') THEN 'hydrophilic'
  END"""

SEPSIS_DX_SQL = """(
    ((dx LIKE '%sepsis%' OR dx LIKE '%septic%')
      AND NOT regexp_matches(dx, 'rule out|r/o|history of|hx of|past history|family history|screening'))
 OR regexp_matches(codes, '(^|,| )(995\\.91|995\\.92|785\\.52)($|,| )')
 OR regexp_matches(codes, '(^|,| )038'))"""

NEURO_DX_RE = ("meningitis|encephalitis|status epilepticus|traumatic brain injury|head trauma|"
               "cerebrovascular accident|stroke|intracranial hemorrhage|subarachnoid hemorrhage|"
               "subdural|epidural|brain injury|brain abscess|anoxic brain")
NEURO_ADM_RE = ("(?s)cva|stroke|intracranial|subarachnoid|head.*trauma|traumatic brain injury|"
                "seizures|status epilepticus|meningitis|encephalitis|brain abscess|"
                "nontraumatic coma due to anoxia|anoxia/ischemia")
NEURO_PH_RE = ("stroke|cva|subarachnoid|intracranial|traumatic brain injury|meningitis|"
               "encephalitis|seizure|epilepsy")
ALC_DX_RE = "alcohol abuse|alcohol dependence|alcohol withdrawal|alcohol intoxication|alcoholism"
ALC_PH_RE = "alcohol abuse|alcohol dependence|alcohol withdrawal|alcoholism"

# The charted number as a struct that sorts like it: v = the first 18 fraction
# digits (whole parts of over 18 digits: 1e18), t = the sign of what follows.
# A number text is taken apart: sign, whole digits without leading zeros, fraction
# digits without closing ones.  Numbers order by sign, length of the whole, digits.
GCS_PARTS_SQL = """
SELECT *, ltrim(split_part(ltrim(nursingchartvalue, '-'), '.', 1), '0') AS w,
       rtrim(split_part(nursingchartvalue, '.', 2), '0') AS f,
       nursingchartvalue[1] = '-' AS neg
FROM nursecharting
WHERE nursingchartcelltypecat IN ('Scores', 'Other Vital Signs and Infusions')
  AND nursingchartoffset BETWEEN 0 AND 1440
  AND ((nursingchartcelltypevallabel = 'Glasgow coma score'
        AND nursingchartcelltypevalname = 'GCS Total')
       OR (nursingchartcelltypevallabel = 'Score (Glasgow Coma Scale)'
           AND nursingchartcelltypevalname = 'Value'))
  AND regexp_full_match(nursingchartvalue, '-?[0-9]+\\.?[0-9]*')"""
GCS_ORDER_SQL = """neg DESC, CASE WHEN neg THEN -length(w) ELSE length(w) END,
         CASE WHEN neg THEN '' ELSE w || f END, CASE WHEN neg THEN w || f ELSE '' END DESC"""

# name -> (dependencies, SQL).  Written directly from the study's semantics.
FRAGMENTS: dict[str, tuple[tuple[str, ...], str]] = {
    "first_stays": (("icustays",), """
SELECT subject_id, hadm_id, stay_id, intime AS icu_intime, outtime AS icu_outtime,
       los AS icu_los_days
FROM icustays
QUALIFY row_number() OVER (PARTITION BY subject_id
                           ORDER BY intime ASC NULLS LAST, stay_id ASC NULLS LAST) = 1"""),
    "onset": (("sepsis3",), """
SELECT stay_id, min(suspected_infection_time) AS suspected_infection_time,
       min(sofa_time) AS sepsis_time, max(sofa_score) AS sofa_score
FROM sepsis3 GROUP BY stay_id"""),
    "ts_ages": (("first_stays", "patients", "admissions"), """
SELECT * EXCLUDE (anchor_age, anchor_year),
       CAST(year(admittime) - anchor_year + anchor_age AS INTEGER) AS age
FROM first_stays
JOIN (SELECT hadm_id, race, admittime, deathtime, hospital_expire_flag FROM admissions) USING (hadm_id)
JOIN (SELECT subject_id, gender, anchor_age, anchor_year, dod AS death_time FROM patients) USING (subject_id)"""),
    "ts_base": (("ts_ages", "onset"), """
SELECT * FROM ts_ages JOIN onset USING (stay_id) WHERE NOT age < 18"""),
    "described": (("diagnoses_icd", "d_icd_diagnoses"), """
SELECT d.hadm_id, replace(upper(d.icd_code), '.', '') AS icd_code_clean, d.icd_version,
       lower(coalesce(t.long_title, '')) AS long_title
FROM diagnoses_icd d
LEFT JOIN d_icd_diagnoses t ON t.icd_code = d.icd_code AND t.icd_version = d.icd_version"""),
    "code_flags": (("described",), f"""
SELECT hadm_id,
       CAST(bool_or({BRAIN_SQL}) AS INTEGER) AS acute_brain_injury,
       CAST(bool_or({ALCOHOL_SQL}) AS INTEGER) AS alcohol_abuse
FROM (SELECT hadm_id, icd_version, icd_code_clean AS code, long_title AS title FROM described)
GROUP BY hadm_id"""),
    "ts_eligibility": (("ts_base", "code_flags"), """
SELECT b.stay_id, b.hadm_id,
       CAST(coalesce(f.acute_brain_injury, 0) AS SMALLINT) AS acute_brain_injury,
       CAST(coalesce(f.alcohol_abuse, 0) AS SMALLINT) AS alcohol_abuse,
       CAST(coalesce(f.acute_brain_injury, 0) + coalesce(f.alcohol_abuse, 0) = 0 AS SMALLINT)
         AS sae_eligible
FROM ts_base b LEFT JOIN code_flags f ON f.hadm_id = b.hadm_id"""),
    "ts_gcs": (("ts_base", "gcs"), f"""
SELECT s.stay_id, min(g.gcs) AS gcs_min_firstday,
       min(g.charttime) FILTER (WHERE g.gcs < 15) AS first_low_gcs_time,
       CAST(coalesce(min(g.gcs) < 15, false) AS SMALLINT) AS sae_by_gcs_firstday
FROM ts_base s
LEFT JOIN gcs g ON g.stay_id = s.stay_id AND g.gcs BETWEEN 3 AND 15
               AND g.charttime >= s.icu_intime AND g.charttime < {FIRST_DAY_END}
GROUP BY s.stay_id"""),
    "cam_rows": (("ts_base", "chartevents"), f"""
SELECT DISTINCT s.stay_id, e.charttime, e.itemid, e.valuenum,
       CAST(e.itemid IN (228337, 228300, 229326) AS INTEGER) AS feat1,
       CAST(e.itemid IN (228336, 228301, 229325) AS INTEGER) AS feat2,
       CAST(e.itemid IN (228335, 228303, 229324) AS INTEGER) AS feat3,
       CAST(e.itemid IN (228302, 228334) AS INTEGER) AS feat4
FROM ts_base s JOIN chartevents e ON e.stay_id = s.stay_id
WHERE e.itemid IN (228337, 228300, 229326, 228336, 228301, 229325, 228335, 228303, 229324,
                   228302, 228334)
  AND e.charttime >= s.icu_intime AND e.charttime < {FIRST_DAY_END}
  AND e.value NOT ILIKE '%unable to assess%'
  AND e.valuenum IS NOT NULL"""),
    "cam_instants": (("cam_rows",), """
SELECT stay_id, charttime,
       (max(feat1) + max(feat2) + max(feat3) >= 3) OR (max(feat1) + max(feat2) + max(feat4) >= 3)
         AS positive
FROM cam_rows GROUP BY stay_id, charttime"""),
    "ts_cam": (("ts_base", "cam_instants"), """
SELECT s.stay_id, min(i.charttime) FILTER (WHERE i.positive) AS first_delirium_time,
       CAST(coalesce(bool_or(i.positive), false) AS SMALLINT) AS delirium_positive_firstday
FROM ts_base s LEFT JOIN cam_instants i ON i.stay_id = s.stay_id
GROUP BY s.stay_id"""),
    "statin_rows": (("ts_base", "prescriptions"), f"""
SELECT s.stay_id, s.icu_intime, r.drug, {STATIN_TYPE_SQL} AS statin_type,
       {STATIN_CLASS_SQL} AS statin_class, r.starttime, r.stoptime
FROM ts_base s JOIN prescriptions r ON r.hadm_id = s.hadm_id
WHERE r.starttime IS NOT NULL
  AND (r.drug_type IS NULL OR r.drug_type <> 'BASE')
  AND {STATIN_TYPE_SQL} IS NOT NULL"""),
    "ts_exposure": (("ts_base", "statin_rows"), """
SELECT s.stay_id,
       CAST(count(r.stay_id) > 0 AS SMALLINT) AS statin_before_icu,
       CAST(count(*) FILTER (WHERE r.statin_class = 'lipophilic') > 0 AS SMALLINT)
         AS lipophilic_statin_before_icu,
       CAST(count(*) FILTER (WHERE r.statin_class = 'hydrophilic') > 0 AS SMALLINT)
         AS hydrophilic_statin_before_icu,
       CAST(count(*) FILTER (WHERE r.statin_type = 'atorvastatin') > 0 AS SMALLINT)
         AS atorvastatin_before_icu,
       CAST(count(*) FILTER (WHERE r.statin_type = 'simvastatin') > 0 AS SMALLINT)
         AS simvastatin_before_icu,
       CAST(count(*) FILTER (WHERE r.statin_type = 'rosuvastatin') > 0 AS SMALLINT)
         AS rosuvastatin_before_icu,
       CAST(count(*) FILTER (WHERE r.statin_type = 'pravastatin') > 0 AS SMALLINT)
         AS pravastatin_before_icu,
       CAST(count(*) FILTER (WHERE r.statin_type = 'lovastatin') > 0 AS SMALLINT)
         AS lovastatin_before_icu,
       CAST(count(*) FILTER (WHERE r.statin_type = 'pitavastatin') > 0 AS SMALLINT)
         AS pitavastatin_before_icu,
       CAST(count(*) FILTER (WHERE r.statin_type = 'fluvastatin') > 0 AS SMALLINT)
         AS fluvastatin_before_icu
FROM ts_base s
LEFT JOIN statin_rows r ON r.stay_id = s.stay_id AND r.starttime < r.icu_intime
GROUP BY s.stay_id"""),
    "ts_final": (("ts_base", "ts_eligibility", "ts_gcs", "ts_cam", "ts_exposure"), """
SELECT b.subject_id, b.hadm_id, b.stay_id, b.icu_intime, b.icu_outtime, b.icu_los_days, b.age,
       b.gender, b.race, b.suspected_infection_time, b.sepsis_time, b.sofa_score,
       e.acute_brain_injury, e.alcohol_abuse, e.sae_eligible,
       g.gcs_min_firstday, g.first_low_gcs_time, g.sae_by_gcs_firstday,
       d.first_delirium_time, d.delirium_positive_firstday,
       CAST(g.sae_by_gcs_firstday = 1 OR d.delirium_positive_firstday = 1 AS SMALLINT)
         AS sae_within_24h,
       x.statin_before_icu, x.lipophilic_statin_before_icu, x.hydrophilic_statin_before_icu,
       x.atorvastatin_before_icu, x.simvastatin_before_icu, x.rosuvastatin_before_icu,
       x.pravastatin_before_icu, x.lovastatin_before_icu, x.pitavastatin_before_icu,
       x.fluvastatin_before_icu,
       CAST(coalesce(b.deathtime BETWEEN b.icu_intime AND b.icu_outtime, false) AS SMALLINT)
         AS icu_death
FROM ts_base b
JOIN ts_eligibility e ON e.stay_id = b.stay_id AND e.sae_eligible = 1
JOIN ts_gcs g ON g.stay_id = b.stay_id
JOIN ts_cam d ON d.stay_id = b.stay_id
JOIN ts_exposure x ON x.stay_id = b.stay_id"""),
    # ---------------------------------------------------------------- offset model
    "rules": ((), """
SELECT * FROM (VALUES ('sex', 1, 'female', 0), ('sex', 2, 'male', 1), ('end', 1, 'expired', 1),
                      ('end', 2, 'alive', 0), ('age', 1, '> 89', 91)) t(field, rank, word, code)"""),
    # One decode table for all texts: the entry with the least rank that occurs wins.
    "decoded": (("patient", "rules"), """
SELECT p.*,
       (SELECT code FROM rules WHERE field = 'sex' AND contains(lower(p.gender), word)
        ORDER BY rank LIMIT 1) AS sex_male,
       (SELECT code FROM rules WHERE field = 'end' AND contains(lower(p.hospitaldischargestatus), word)
        ORDER BY rank LIMIT 1) AS hosp_mort,
       (SELECT code FROM rules WHERE field = 'end' AND contains(lower(p.unitdischargestatus), word)
        ORDER BY rank LIMIT 1) AS icu_mort,
       coalesce((SELECT code FROM rules WHERE field = 'age' AND word = p.age),
                CASE WHEN translate(p.age, '0123456789', '') = '' THEN TRY_CAST(p.age AS INTEGER) END) AS age_years
FROM patient p"""),
    "off_base": (("decoded", "hospital"), """
SELECT p.uniquepid, p.patienthealthsystemstayid, p.patientunitstayid, p.unitvisitnumber,
       p.hospitalid, h.region, p.unittype, p.apacheadmissiondx, p.unitdischargeoffset,
       p.hospitaldischargeyear, p.age_years AS age, p.sex_male, p.ethnicity AS race,
       p.hosp_mort, p.icu_mort
FROM decoded p LEFT JOIN hospital h ON h.hospitalid = p.hospitalid
WHERE p.unitvisitnumber = 1 AND p.age_years >= 18"""),
    "dx_text": (("diagnosis",), """
SELECT patientunitstayid, lower(coalesce(diagnosisstring, '')) AS dx,
       coalesce(icd9code, '') AS codes
FROM diagnosis"""),
    "off_sepsis": (("off_base", "dx_text"), f"""
SELECT b.patientunitstayid,
       CAST(lower(coalesce(b.apacheadmissiondx, '')) LIKE '%sepsis%'
            OR coalesce(bool_or({SEPSIS_DX_SQL}), false) AS INTEGER) AS sepsis
FROM off_base b LEFT JOIN dx_text d ON d.patientunitstayid = b.patientunitstayid
GROUP BY b.patientunitstayid, b.apacheadmissiondx"""),
    "dx_hits": (("dx_text",), f"""
SELECT patientunitstayid,
       bool_or(regexp_matches(dx, '{NEURO_DX_RE}')) AS neuro,
       bool_or(regexp_matches(dx, '{ALC_DX_RE}')) AS alcohol
FROM dx_text GROUP BY patientunitstayid"""),
    "ph_hits": (("pasthistory",), f"""
SELECT patientunitstayid,
       bool_or(regexp_matches(lower(coalesce(pasthistorypath, '')), '{NEURO_PH_RE}')) AS neuro,
       bool_or(regexp_matches(lower(coalesce(pasthistorypath, '')), '{ALC_PH_RE}')) AS alcohol
FROM pasthistory GROUP BY patientunitstayid"""),
    "off_eligibility": (("off_base", "dx_hits", "ph_hits"), f"""
SELECT patientunitstayid,
       CAST(neuro AS INTEGER) AS acute_brain_injury_or_major_neuro,
       CAST(alcohol AS INTEGER) AS alcohol_abuse,
       CAST(NOT neuro AND NOT alcohol AS INTEGER) AS sae_eligible
FROM (
  SELECT b.patientunitstayid,
         regexp_matches(lower(coalesce(b.apacheadmissiondx, '')), '{NEURO_ADM_RE}')
           OR coalesce(d.neuro, false) OR coalesce(h.neuro, false) AS neuro,
         regexp_matches(lower(coalesce(b.apacheadmissiondx, '')), 'alcohol')
           OR coalesce(d.alcohol, false) OR coalesce(h.alcohol, false) AS alcohol
  FROM off_base b
  LEFT JOIN dx_hits d ON d.patientunitstayid = b.patientunitstayid
  LEFT JOIN ph_hits h ON h.patientunitstayid = b.patientunitstayid)"""),
    "off_gcs": (("nursecharting",), f"""
WITH parts AS ({GCS_PARTS_SQL}),
per_offset AS (
  SELECT patientunitstayid, nursingchartoffset, neg, w, f, TRY_CAST('0' || w AS INTEGER) AS whole
  FROM parts
  QUALIFY row_number() OVER (PARTITION BY patientunitstayid, nursingchartoffset
                             ORDER BY {GCS_ORDER_SQL}) = 1),
valid AS (SELECT *, row_number() OVER (PARTITION BY patientunitstayid ORDER BY {GCS_ORDER_SQL}) AS place
          FROM per_offset
          WHERE NOT neg AND length(w) <= 2 AND whole < 16 AND (whole > 2 OR (whole = 2 AND f <> '')))
SELECT patientunitstayid,
       max(CAST('0' || w || '.' || f || '0' AS DECIMAL(38, 36))) FILTER (WHERE place = 1) AS gcs_min_firstday,
       min(nursingchartoffset) AS first_gcs_offset,
       min(nursingchartoffset) FILTER (WHERE whole < 15) AS first_low_gcs_offset_firstday,
       CAST(bool_or(place = 1 AND whole < 15) AS SMALLINT) AS sae_by_gcs_firstday
FROM valid GROUP BY patientunitstayid"""),
    "off_delirium": (("nursecharting",), """
SELECT patientunitstayid, min(nursingchartoffset) AS first_delirium_offset,
       CAST(1 AS SMALLINT) AS delirium_firstday
FROM (SELECT patientunitstayid, nursingchartoffset,
             lower(coalesce(nursingchartcelltypevallabel, '')) AS lab,
             lower(coalesce(nursingchartcelltypevalname, '')) AS nam,
             lower(coalesce(nursingchartvalue, '')) AS val
      FROM nursecharting WHERE nursingchartoffset BETWEEN 0 AND 1440)
WHERE (contains(lab, 'delirium') OR contains(nam, 'delirium') OR contains(val, 'delirium'))
  AND (val IN ('yes', 'y', 'true', '1', 'present', 'positive')
       OR lab = 'symptoms of delirium present')
GROUP BY patientunitstayid"""),
    "statin_terms": ((), """
SELECT * FROM (VALUES
  ('atorvastatin', 'lipophilic', 'atorvastatin'), ('atorvastatin', 'lipophilic', 'lipitor'),
  ('simvastatin', 'lipophilic', 'simvastatin'), ('simvastatin', 'lipophilic', 'zocor'),
  ('lovastatin', 'lipophilic', 'lovastatin'), ('lovastatin', 'lipophilic', 'mevacor'),
  ('lovastatin', 'lipophilic', 'altoprev'), ('pitavastatin', 'lipophilic', 'pitavastatin'),
  ('pitavastatin', 'lipophilic', 'livalo'), ('fluvastatin', 'lipophilic', 'fluvastatin'),
  ('fluvastatin', 'lipophilic', 'lescol'), ('pravastatin', 'hydrophilic', 'pravastatin'),
  ('pravastatin', 'hydrophilic', 'pravachol'), ('rosuvastatin', 'hydrophilic', 'rosuvastatin'),
  ('rosuvastatin', 'hydrophilic', 'crestor')) t(generic_name, statin_type, match_term)"""),
    "term_hits": (("admissiondrug", "statin_terms"), """
SELECT DISTINCT a.patientunitstayid, t.generic_name, t.statin_type
FROM admissiondrug a
JOIN statin_terms t ON contains(lower(coalesce(a.drugname, '')), t.match_term)"""),
    "off_exposure": (("off_base", "term_hits"), """
SELECT b.patientunitstayid,
       CAST(count(h.patientunitstayid) > 0 AS SMALLINT) AS pre_statin,
       CAST(count(*) FILTER (WHERE h.statin_type = 'lipophilic') > 0 AS SMALLINT)
         AS pre_lipophilic_statin,
       CAST(count(*) FILTER (WHERE h.statin_type = 'hydrophilic') > 0 AS SMALLINT)
         AS pre_hydrophilic_statin
FROM off_base b LEFT JOIN term_hits h ON h.patientunitstayid = b.patientunitstayid
GROUP BY b.patientunitstayid"""),
    "off_final": (("off_base", "off_sepsis", "off_eligibility", "off_gcs", "off_delirium",
                   "off_exposure"), """
SELECT b.uniquepid, b.patienthealthsystemstayid, b.patientunitstayid, b.hospitalid, b.region,
       b.unittype, b.apacheadmissiondx, b.unitdischargeoffset, b.hospitaldischargeyear, b.age,
       b.sex_male, b.race, b.icu_mort, b.hosp_mort,
       e.acute_brain_injury_or_major_neuro, e.alcohol_abuse, e.sae_eligible,
       g.gcs_min_firstday, g.first_gcs_offset, g.first_low_gcs_offset_firstday,
       CAST(coalesce(g.sae_by_gcs_firstday, 0) AS SMALLINT) AS sae_by_gcs_firstday,
       d.first_delirium_offset,
       CAST(coalesce(d.delirium_firstday, 0) AS SMALLINT) AS delirium_firstday,
       CAST(coalesce(g.sae_by_gcs_firstday, 0) = 1 OR coalesce(d.delirium_firstday, 0) = 1
            AS SMALLINT) AS sae_within_24h,
       x.pre_statin AS statin_before_icu, x.pre_lipophilic_statin AS lipophilic_statin_before_icu,
       x.pre_hydrophilic_statin AS hydrophilic_statin_before_icu
FROM off_base b
JOIN off_sepsis s ON s.patientunitstayid = b.patientunitstayid
JOIN off_eligibility e ON e.patientunitstayid = b.patientunitstayid
LEFT JOIN off_gcs g ON g.patientunitstayid = b.patientunitstayid
LEFT JOIN off_delirium d ON d.patientunitstayid = b.patientunitstayid
LEFT JOIN off_exposure x ON x.patientunitstayid = b.patientunitstayid
WHERE s.sepsis = 1 AND e.sae_eligible = 1"""),
}

SUMMARY_SQL = """
SELECT '{label}' AS cohort, count(*) AS n_rows,
       CAST(sum(statin_before_icu) AS BIGINT) AS n_exposed,
       CAST(sum(statin_before_icu) AS DOUBLE) / count(*) AS exposed_share,
       CAST(sum(sae_within_24h) AS BIGINT) AS n_outcome,
       CAST(sum(sae_within_24h) AS DOUBLE) / count(*) AS outcome_share
FROM {table}"""

# --------------------------------------------------------------------------- queries
# key -> (fragments used, final SELECT)

QUERIES: dict[str, tuple[tuple[str, ...], str]] = {
    "first_stay_per_patient": (("first_stays",), "SELECT * FROM first_stays"),
    "first_visit_base": (("off_base",), "SELECT * FROM off_base"),
    "onset_rollup": (("onset",), "SELECT * FROM onset"),
    "anchored_age": (("icustays", "admissions", "patients"), """
SELECT i.stay_id, i.subject_id, i.hadm_id,
       CAST(p.anchor_age + year(a.admittime) - p.anchor_year AS INTEGER) AS age
FROM icustays i JOIN admissions a ON a.hadm_id = i.hadm_id
JOIN patients p ON p.subject_id = i.subject_id
WHERE p.anchor_age + year(a.admittime) - p.anchor_year >= 18"""),
    "decode_demographics": (("decoded",), """
SELECT patientunitstayid, age_years AS age, sex_male, hosp_mort, icu_mort FROM decoded"""),
    "base_cohort_ts": (("ts_base",), "SELECT * FROM ts_base"),
    "describe_codes": (("described",), "SELECT * FROM described"),
    "code_rule_flags": (("code_flags",), "SELECT * FROM code_flags"),
    "eligibility_codes": (("ts_eligibility",), "SELECT * FROM ts_eligibility"),
    "phrase_flag": (("dx_text",), """
SELECT patientunitstayid,
       CAST(bool_or((dx LIKE '%sepsis%' OR dx LIKE '%septic%')
                    AND NOT regexp_matches(dx, 'rule out|r/o|history of|hx of|past history|family history|screening'))
            AS INTEGER) AS sepsis_phrase
FROM dx_text GROUP BY patientunitstayid"""),
    "list_code_flag": (("dx_text",), """
SELECT patientunitstayid,
       CAST(bool_or(regexp_matches(codes, '(^|,| )(995\\.91|995\\.92|785\\.52)($|,| )')
                    OR regexp_matches(codes, '(^|,| )038')) AS INTEGER) AS sepsis_code
FROM dx_text GROUP BY patientunitstayid"""),
    "sepsis_documented": (("off_sepsis",), "SELECT * FROM off_sepsis"),
    "eligibility_multi_source": (("off_eligibility",), "SELECT * FROM off_eligibility"),
    "first_day_min_score": (("first_stays", "gcs"), f"""
SELECT s.stay_id, min(g.gcs) AS gcs_min_firstday,
       min(g.charttime) FILTER (WHERE g.gcs < 15) AS first_low_gcs_time,
       CAST(coalesce(min(g.gcs) < 15, false) AS SMALLINT) AS sae_by_gcs_firstday
FROM first_stays s
LEFT JOIN gcs g ON g.stay_id = s.stay_id AND g.gcs BETWEEN 3 AND 15
               AND g.charttime >= s.icu_intime AND g.charttime < {FIRST_DAY_END}
GROUP BY s.stay_id"""),
    "first_day_min_score_offset": (("off_gcs",), "SELECT * FROM off_gcs"),
    "cam_feature_rows": (("cam_rows",), "SELECT * FROM cam_rows"),
    "cam_status": (("ts_cam",), "SELECT * FROM ts_cam"),
    "charted_condition_first": (("off_delirium",), "SELECT * FROM off_delirium"),
    "classify_drugs": (("prescriptions",), f"""
SELECT hadm_id, drug, {STATIN_TYPE_SQL} AS statin_type, {STATIN_CLASS_SQL} AS statin_class
FROM prescriptions"""),
    "drug_events": (("statin_rows",), """
SELECT DISTINCT stay_id, drug AS drug_name_original, statin_type, statin_class, starttime,
       stoptime
FROM statin_rows"""),
    "pre_index_exposure": (("ts_exposure",), "SELECT * FROM ts_exposure"),
    "term_match_join": (("term_hits",), "SELECT * FROM term_hits"),
    "term_match_table": (("admissiondrug", "statin_terms"), """
SELECT DISTINCT a.patientunitstayid, t.generic_name, t.statin_type
FROM admissiondrug a
JOIN statin_terms t ON lower(coalesce(a.drugname, '')) LIKE '%' || t.match_term || '%'"""),
    "classify_drugs_table": (("prescriptions",), f"""
SELECT hadm_id, drug, {STATIN_TYPE_SQL} AS statin_type, {STATIN_CLASS_SQL} AS statin_class
FROM prescriptions"""),
    "text_flags_table": (("dx_text",), """
SELECT DISTINCT patientunitstayid, flag
FROM (SELECT patientunitstayid, dx, unnest(['sepsis', 'neuro', 'alcohol']) AS flag FROM dx_text)
WHERE CASE flag
  WHEN 'sepsis' THEN regexp_matches(dx, 'sepsis|septic')
    AND NOT regexp_matches(dx, 'rule out|r/o|history of|hx of|past history|family history|screening')
  WHEN 'neuro' THEN regexp_matches(dx, 'meningitis|encephalitis|status epilepticus|traumatic brain injury|head trauma|cerebrovascular accident|stroke|intracranial hemorrhage|subarachnoid hemorrhage|subdural|epidural|brain injury|brain abscess|anoxic brain')
  ELSE regexp_matches(dx, 'alcohol abuse|alcohol dependence|alcohol withdrawal|alcohol intoxication|alcoholism') END"""),
    "code_rule_table": (("code_flags",), """
SELECT hadm_id, 'acute_brain_injury' AS rule FROM code_flags WHERE acute_brain_injury = 1
UNION ALL
SELECT hadm_id, 'alcohol_abuse' FROM code_flags WHERE alcohol_abuse = 1"""),
    "undated_exposure": (("off_exposure",), "SELECT * FROM off_exposure"),
    "death_in_interval": (("ts_base",), """
SELECT stay_id,
       CAST(coalesce(deathtime BETWEEN icu_intime AND icu_outtime, false) AS SMALLINT) AS icu_death
FROM ts_base"""),
    "composite_outcome": (("ts_gcs", "ts_cam"), """
SELECT g.stay_id, g.sae_by_gcs_firstday, d.delirium_positive_firstday,
       CAST(g.sae_by_gcs_firstday = 1 OR d.delirium_positive_firstday = 1 AS SMALLINT)
         AS sae_within_24h
FROM ts_gcs g JOIN ts_cam d ON d.stay_id = g.stay_id"""),
    "cohort_timestamped": (("ts_final",), "SELECT * FROM ts_final"),
    "cohort_offset": (("off_final",), "SELECT * FROM off_final"),
    "cohort_summary": (("ts_final", "off_final"),
                       SUMMARY_SQL.format(label="timestamped", table="ts_final")
                       + "\nUNION ALL" + SUMMARY_SQL.format(label="offset", table="off_final")),
}


def _resolve(names: tuple[str, ...], out: list[str]) -> None:
    for n in names:
        if n in out:
            continue
        if n in FRAGMENTS:
            _resolve(FRAGMENTS[n][0], out)
        if n not in out:
            out.append(n)


def build(key: str) -> str:
    deps, select = QUERIES[key]
    order: list[str] = []
    _resolve(deps, order)
    ctes = []
    for n in order:
        body = ADAPTER[n] if n in ADAPTER else FRAGMENTS[n][1]
        ctes.append(f"{n} AS ({body.strip()}\n)")
    return "WITH " + ",\n".join(ctes) + "\n" + select.strip()


def oracle_sql() -> dict[str, str]:
    return {k: build(k) for k in QUERIES}
