"""Values from text and arithmetic: ages, ordered category decodes, numbers.

All functions return ``Column`` expressions built from built-in functions,
so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardline.functions import dictionaries as dic
from wardline.functions.numbers import number_key


def anchored_age(anchor_age: Column, anchor_year: Column, at: Column) -> Column:
    """Age at ``at``: anchor age plus the years elapsed since the anchor year (int)."""
    return (anchor_age + F.year(at) - anchor_year).cast("int")


def decode_age(text: Column, censored: Mapping[str, int] = dic.AGE_CENSORED) -> Column:
    """Censored labels map to fixed ages, a string of digits to its value, else NULL.

    ``\\z`` anchors at the very end (Java ``$`` would also accept a final
    newline); ``try_cast`` keeps an oversized digit string NULL instead of
    failing the job.
    """
    out = None
    for label, age in censored.items():
        out = F.when(text == label, F.lit(age)) if out is None else out.when(text == label, age)
    digits = text.rlike(r"^[0-9]+\z")
    cast = text.try_cast("int")
    return out.when(digits, cast) if out is not None else F.when(digits, cast)


def decode_by_substring(text: Column, pairs: Iterable[tuple[str, object]]) -> Column:
    """First pair whose substring occurs in ``lower(text)`` wins; no match -> NULL.

    The order of ``pairs`` is the priority: ``female`` must precede ``male``.
    """
    low = F.lower(text)
    out = None
    for sub, val in pairs:
        cond = low.contains(sub)
        out = F.when(cond, F.lit(val)) if out is None else out.when(cond, F.lit(val))
    return out


def is_number(value: Column, pattern: str = dic.GCS_NUMBER_PATTERN,
              reject: Iterable[str] = dic.GCS_NUMBER_REJECT) -> Column:
    """``value`` looks numeric (NULL where it is NULL)."""
    return value.rlike(pattern) & ~value.isin(*reject)


def text_number(value: Column, where: Column, pattern: str = dic.GCS_NUMBER_PATTERN,
                reject: Iterable[str] = dic.GCS_NUMBER_REJECT) -> Column:
    """``value`` as a number key when ``where`` holds and it looks numeric, else NULL.

    The key orders as the number and keeps every digit
    (:mod:`wardline.functions.numbers`).
    """
    return F.when(where & is_number(value, pattern, reject), number_key(value))
