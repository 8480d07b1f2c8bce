"""Codes, phrases and term dictionaries turned into Column predicates.

Rules are data (see :mod:`wardline.functions.dictionaries`); these functions
generate the equivalent built-in expressions, so matching runs JVM-side.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardline.functions.dictionaries import CodeRule, Term


def alternation(terms: Iterable[str]) -> str:
    """One regex matching any of ``terms`` anywhere, ``.`` also across newlines."""
    return "(?s)(" + "|".join(terms) + ")"


def matches_any(text: Column, terms: Iterable[str]) -> Column:
    """Partial regex match of any alternative (NULL text -> NULL)."""
    return text.rlike(alternation(terms))


def contains_any(text: Column, terms: Iterable[str]) -> Column:
    """``text LIKE '%t%'`` for any literal term ``t`` (NULL text -> NULL)."""
    out = None
    for t in terms:
        out = text.contains(t) if out is None else (out | text.contains(t))
    return out


def normalise_code(code: Column) -> Column:
    """Upper-case and drop dots: ``i63.9`` -> ``I639``."""
    return F.replace(F.upper(code), F.lit("."), F.lit(""))


def code_rule(rule: CodeRule, code_clean: Column, version: Column,
              title: Column | None = None) -> Column:
    """True when a (normalised code, version[, lower-cased title]) satisfies ``rule``."""
    per_version = []
    for ver, codes in rule.by_version.items():
        hits = []
        for length, prefixes in sorted(codes.prefixes.items()):
            hits.append(F.substring(code_clean, 1, length).isin(*prefixes))
        for lo, hi in codes.ranges:
            hits.append(F.substring(code_clean, 1, len(lo)).between(lo, hi))
        any_hit = hits[0]
        for h in hits[1:]:
            any_hit = any_hit | h
        per_version.append((version == ver) & any_hit)
    cond = per_version[0]
    for p in per_version[1:]:
        cond = cond | p
    if title is not None and rule.title_terms:
        cond = cond | matches_any(title, rule.title_terms)
    return cond


def phrase_flag(text: Column, include: Sequence[str], exclude: Sequence[str] = ()) -> Column:
    """Text names an include term and no exclusion phrase.

    Callers pass ``lower(coalesce(text, ''))`` where the study does, so a
    missing text is a plain ``False`` and the negation cannot turn NULL.
    """
    cond = contains_any(text, include)
    if exclude:
        cond = cond & ~matches_any(text, exclude)
    return cond


def list_code_flag(codes: Column, whole: Sequence[str] = (), prefix: Sequence[str] = ()) -> Column:
    """A code is an element of a comma/space separated list (``whole``) or starts one.

    Boundaries are explicit: start, ``,`` or space before; end (``\\z``), ``,``
    or space after for whole codes.
    """
    parts = []
    if whole:
        alts = "|".join(re.escape(w) for w in whole)
        parts.append(codes.rlike(r"(^|,| )(" + alts + r")(\z|,| )"))
    if prefix:
        alts = "|".join(re.escape(p) for p in prefix)
        parts.append(codes.rlike(r"(^|,| )(" + alts + ")"))
    out = parts[0]
    for p in parts[1:]:
        out = out | p
    return out


def classify_terms(text: Column, priority: Sequence[tuple[str, str, Sequence[str]]]) -> Column:
    """Generic name of the first group whose terms occur in ``lower(text)``, else NULL."""
    low = F.lower(text)
    out = None
    for generic, _cls, terms in priority:
        cond = contains_any(low, terms)
        out = F.when(cond, F.lit(generic)) if out is None else out.when(cond, F.lit(generic))
    return out


def terms_frame(spark, terms: Sequence[Term]):
    """A term dictionary as a small DataFrame ``(generic_name, statin_type, match_term)``."""
    from wardline.sizes import note_rows
    rows = [(t.generic, t.drug_class, t.term) for t in terms]
    df = spark.createDataFrame(rows, "generic_name string, statin_type string, match_term string")
    return note_rows(df, len(rows))
