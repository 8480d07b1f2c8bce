"""Code sets, term lists and item maps used by the two cohort definitions.

Everything here is data.  Operators take these structures as parameters, so
a study can swap any list without touching operator code.  Term lists are
regular-expression alternatives (all but ``head.*trauma`` are plain words)
and are joined into one pattern, or into a ``contains`` chain where the
study matches with ``LIKE``, by :mod:`wardline.functions.match`.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class VersionCodes:
    """Code prefixes of one coding-system version.

    ``prefixes`` maps a prefix length to the allowed prefixes of that length;
    ``ranges`` holds inclusive ``(low, high)`` prefix ranges, compared on the
    first ``len(low)`` characters of the normalised code.
    """

    prefixes: dict[int, tuple[str, ...]] = field(default_factory=dict)
    ranges: tuple[tuple[str, str], ...] = ()


@dataclass(frozen=True)
class CodeRule:
    """A versioned code rule plus an optional title term list.

    A diagnosis row satisfies the rule if its version has an entry in
    ``by_version`` and its normalised code matches a prefix or a range of that
    entry, or if its (lower-cased) dictionary title contains one of
    ``title_terms`` whatever the version.
    """

    name: str
    by_version: dict[int, VersionCodes]
    title_terms: tuple[str, ...] = ()


@dataclass(frozen=True)
class Term:
    generic: str
    drug_class: str
    term: str


# --------------------------------------------------------------------------
# Fixed values.  These must equal the study definitions for the results to
# match, so they are written out plainly, in the order the study lists them.
# --------------------------------------------------------------------------

# Timestamp model: acute brain injury / major neurologic disease.
BRAIN_ICD10_PREFIXES = ("G00", "G01", "G02", "G03", "G04", "G41", "S06",
                        "I60", "I61", "I62", "I63", "I64")
BRAIN_ICD10_RANGES = (("I65", "I69"),)
BRAIN_ICD9_RANGES = (("320", "323"), ("430", "438"), ("800", "804"), ("850", "854"))
BRAIN_ICD9_PREFIXES4 = ("3453",)
BRAIN_TITLE_TERMS = ("meningitis", "encephalitis", "status epilepticus",
                     "traumatic brain injury", "intracranial hemorrhage",
                     "subarachnoid hemorrhage", "subdural", "epidural",
                     "cerebral infarction", "ischemic stroke", "haemorrhagic stroke",
                     "hemorrhagic stroke", "cerebrovascular accident")

# Timestamp model: alcohol use disorder.
ALCOHOL_ICD10_PREFIXES = ("F10",)
ALCOHOL_ICD9_PREFIXES = ("291", "303")
ALCOHOL_ICD9_PREFIXES4 = ("3050",)
ALCOHOL_TITLE_TERMS = ("alcohol abuse", "alcohol dependence", "alcohol withdrawal",
                       "alcohol intoxication", "alcoholism", "alcohol-related")

# Timestamp model: CAM-ICU feature item ids (feature number -> item ids).
CAM_FEATURE_ITEMS = {
    1: (228337, 228300, 229326),   # acute change / fluctuation
    2: (228336, 228301, 229325),   # inattention
    3: (228335, 228303, 229324),   # altered level of consciousness
    4: (228302, 228334),           # disorganized thinking
}
# Positive if all features of any one set are present at the same instant.
CAM_POSITIVE_SETS = ((1, 2, 3), (1, 2, 4))
CAM_EXCLUDED_VALUE = "%unable to assess%"

# Timestamp model: first-day score validity.
GCS_VALID_RANGE = (3, 15)
GCS_LOW_BELOW = 15

# Timestamp model: statins by priority (generic, class, terms).  The first
# generic whose terms match gives the drug its type.
STATIN_TERMS_PRIORITY = (
    ("atorvastatin", "lipophilic", ("atorvastatin", "lipitor", "atorvaliq")),
    ("simvastatin", "lipophilic", ("simvastatin", "zocor", "flolipid", "cholesnone", "vytorin")),
    ("lovastatin", "lipophilic", ("lovastatin", "mevacor", "altoprev", "altocor")),
    ("pitavastatin", "lipophilic", ("pitavastatin", "livalo", "zypitamag", "livazo", "alipza")),
    ("fluvastatin", "lipophilic", ("fluvastatin", "lescol")),
    ("pravastatin", "hydrophilic", ("pravastatin", "pravachol", "lipostat", "mevalotin")),
    ("rosuvastatin", "hydrophilic", ("rosuvastatin", "crestor", "vivacor", "roszet")),
)
EXCLUDED_DRUG_TYPE = "BASE"
# Output column order of the per-generic exposure flags.
STATIN_FLAG_ORDER = ("atorvastatin", "simvastatin", "rosuvastatin", "pravastatin",
                     "lovastatin", "pitavastatin", "fluvastatin")

# Offset model: admission-medication statin terms (generic, class, term).
ADMISSION_STATIN_TERMS = (
    ("atorvastatin", "lipophilic", "atorvastatin"),
    ("atorvastatin", "lipophilic", "lipitor"),
    ("simvastatin", "lipophilic", "simvastatin"),
    ("simvastatin", "lipophilic", "zocor"),
    ("lovastatin", "lipophilic", "lovastatin"),
    ("lovastatin", "lipophilic", "mevacor"),
    ("lovastatin", "lipophilic", "altoprev"),
    ("pitavastatin", "lipophilic", "pitavastatin"),
    ("pitavastatin", "lipophilic", "livalo"),
    ("fluvastatin", "lipophilic", "fluvastatin"),
    ("fluvastatin", "lipophilic", "lescol"),
    ("pravastatin", "hydrophilic", "pravastatin"),
    ("pravastatin", "hydrophilic", "pravachol"),
    ("rosuvastatin", "hydrophilic", "rosuvastatin"),
    ("rosuvastatin", "hydrophilic", "crestor"),
)

# Offset model: documented sepsis.
SEPSIS_ADMISSION_TERMS = ("sepsis",)
SEPSIS_DIAGNOSIS_TERMS = ("sepsis", "septic")
SEPSIS_EXCLUDE_PHRASES = ("rule out", "r/o", "history of", "hx of", "past history",
                          "family history", "screening")
SEPSIS_WHOLE_CODES = ("995.91", "995.92", "785.52")
SEPSIS_PREFIX_CODES = ("038",)

# Offset model: neurologic exclusion, one list per text source.
NEURO_DIAGNOSIS_TERMS = ("meningitis", "encephalitis", "status epilepticus",
                         "traumatic brain injury", "head trauma", "cerebrovascular accident",
                         "stroke", "intracranial hemorrhage", "subarachnoid hemorrhage",
                         "subdural", "epidural", "brain injury", "brain abscess",
                         "anoxic brain")
NEURO_ADMISSION_TERMS = ("cva", "stroke", "intracranial", "subarachnoid", "head.*trauma",
                         "traumatic brain injury", "seizures", "status epilepticus",
                         "meningitis", "encephalitis", "brain abscess",
                         "nontraumatic coma due to anoxia", "anoxia/ischemia")
NEURO_HISTORY_TERMS = ("stroke", "cva", "subarachnoid", "intracranial",
                       "traumatic brain injury", "meningitis", "encephalitis",
                       "seizure", "epilepsy")

# Offset model: alcohol exclusion, one list per text source.
ALCOHOL_DIAGNOSIS_TERMS = ("alcohol abuse", "alcohol dependence", "alcohol withdrawal",
                           "alcohol intoxication", "alcoholism")
ALCOHOL_HISTORY_TERMS = ("alcohol abuse", "alcohol dependence", "alcohol withdrawal",
                         "alcoholism")
ALCOHOL_ADMISSION_TERMS = ("overdose, alcohol", "alcohol")

# Offset model: charted score sources, as (label, name) pairs, and categories.
GCS_LABEL_NAME_PAIRS = (("Glasgow coma score", "GCS Total"),
                        ("Score (Glasgow Coma Scale)", "Value"))
GCS_CATEGORIES = ("Scores", "Other Vital Signs and Infusions")
GCS_NUMBER_PATTERN = r"^[-]?[0-9]+[.]?[0-9]*\z"
GCS_NUMBER_REJECT = ("-", ".")
GCS_OFFSET_VALID_OPEN = (2, 16)        # strictly between

# Offset model: charted delirium.
DELIRIUM_WORD = "delirium"
DELIRIUM_POSITIVE_VALUES = ("yes", "y", "true", "1", "present", "positive")
DELIRIUM_POSITIVE_LABEL = "symptoms of delirium present"

# Offset model: text decodes (first matching substring wins).
AGE_CENSORED = {"> 89": 91}
SEX_MALE_DECODE = (("female", 0), ("male", 1))
DISCHARGE_DEATH_DECODE = (("expired", 1), ("alive", 0))

# First-day windows.
FIRST_DAY = "24 HOURS"
FIRST_DAY_OFFSETS = (0, 1440)


# --------------------------------------------------------------------------
# Structures built from the fixed values above.
# --------------------------------------------------------------------------

BRAIN_RULE = CodeRule(
    name="acute_brain_injury",
    by_version={
        10: VersionCodes(prefixes={3: BRAIN_ICD10_PREFIXES}, ranges=BRAIN_ICD10_RANGES),
        9: VersionCodes(prefixes={4: BRAIN_ICD9_PREFIXES4}, ranges=BRAIN_ICD9_RANGES),
    },
    title_terms=BRAIN_TITLE_TERMS,
)

ALCOHOL_RULE = CodeRule(
    name="alcohol_abuse",
    by_version={
        10: VersionCodes(prefixes={3: ALCOHOL_ICD10_PREFIXES}),
        9: VersionCodes(prefixes={3: ALCOHOL_ICD9_PREFIXES, 4: ALCOHOL_ICD9_PREFIXES4}),
    },
    title_terms=ALCOHOL_TITLE_TERMS,
)


def statin_terms() -> tuple[Term, ...]:
    """Prescription terms in priority order (one row per term)."""
    return tuple(Term(g, c, t) for g, c, terms in STATIN_TERMS_PRIORITY for t in terms)


def admission_statin_terms() -> tuple[Term, ...]:
    return tuple(Term(g, c, t) for g, c, t in ADMISSION_STATIN_TERMS)


def statin_classes() -> dict[str, str]:
    return {g: c for g, c, _ in STATIN_TERMS_PRIORITY}
