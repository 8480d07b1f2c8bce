"""Unbounded numbers: an order-preserving key for number texts, and back.

The study compares and minimises texts as numbers of any length; Spark's widest
number has 38 digits.  The key of a text is a string whose byte order is the
order of the numbers, so ``min``, ``max``, ``<`` and sorting work on it exactly:

* a sign, ``1`` for zero and above;
* the length of the whole part without leading zeros, ten digits wide, so a
  longer whole part is larger whatever its digits;
* its digits, then those of the fraction without closing zeros.  Two wholes of one
  length align, and a fraction that another one goes on from is the smaller.

Below zero the sign is ``0``, every digit is taken from nine and ``~``, which sorts
after the digits, ends the key: what is further from zero sorts lower.  Equal
numbers have one key (``15``, ``15.0``, ``-0`` and ``0``).  No digit is ever cut.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DIGITS, _FROM_NINE = "0123456789", "9876543210"
_WIDTH = 10                # of the length: a Spark string is shorter than 10**10


def number_key(text: Column) -> Column:
    """The key of ``-?digits[.digits]`` (guard other texts first)."""
    body = F.ltrim(text, F.lit("-"))
    whole = F.ltrim(F.substring_index(body, ".", 1), F.lit("0"))
    dot = F.instr(body, ".")
    part = F.when(dot > 0, F.rtrim(F.substr(body, dot + 1), F.lit("0"))).otherwise(F.lit(""))
    digits = F.concat(F.lpad(F.length(whole).cast("string"), _WIDTH, "0"), whole, part)
    # Nearly all texts are whole numbers of one or two digits.
    short = F.concat(F.lit("1" + "0" * (_WIDTH - 1)), F.length(text).cast("string"), text)
    return (F.when((F.length(text) <= 2) & text.between("1", "9~") & (dot == 0), short)
            .when(text.startswith("-") & ((whole != "") | (part != "")),
                  F.concat(F.lit("0"), F.translate(digits, _DIGITS, _FROM_NINE), F.lit("~")))
            .otherwise(F.concat(F.lit("1"), digits)))


def _parts(key: Column) -> tuple[Column, Column, Column]:
    """Sign, whole and fraction digits of a key."""
    minus = key.startswith("0")
    body = F.substr(key, F.lit(2))
    digits = F.when(minus, F.translate(F.rtrim(body, F.lit("~")), _DIGITS, _FROM_NINE)).otherwise(body)
    size = F.substring(digits, 1, _WIDTH).cast("int")
    return (F.when(minus, F.lit("-")).otherwise(F.lit("")),
            F.when(size == 0, F.lit("0")).otherwise(F.substr(digits, F.lit(_WIDTH + 1), size)),
            F.substr(digits, size + (_WIDTH + 1)))


def number_text(key: Column) -> Column:
    """The number of a key with all its digits: no leading or closing zeros, ``-`` below zero."""
    sign, whole, part = _parts(key)
    return F.concat(sign, whole, F.when(part != "", F.concat(F.lit("."), part)).otherwise(F.lit("")))


def number_decimal(key: Column, scale: int) -> Column:
    """The number of a key as ``decimal(38, scale)``; further fraction digits are left off, not rounded.

    NULL when the whole part has more than ``38 - scale`` digits.
    """
    sign, whole, part = _parts(key)
    return F.concat(sign, whole, F.lit("."), F.substring(part, 1, scale), F.lit("0")).try_cast(f"decimal(38,{scale})")
