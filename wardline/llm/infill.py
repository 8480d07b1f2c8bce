"""Fill-in-middle transformation (operator 11) over a sparse exception index.

A text is cut into prefix, middle and suffix at unit borders and rearranged so
that a left-to-right model learns to fill the middle.  Units are lines
(``[^\\n]*\\n|[^\\n]+``) or code points.  Line borders are byte positions of the
UTF-8 text, code-point cuts are not; the index of a text converts either way.
It records multibyte characters only: where each starts and how many bytes it
has beyond one.  A cut is moved by the excess of the exceptions before it, which
``searchsorted`` finds; ASCII spans need no entry, their cuts are arithmetic.

Choices come from digits of ``sha256("{seed}:{doc_id}")``, so a row gives the
same output wherever and whenever it is processed; copies of a text under other
ids are cut elsewhere.

Edge cases: null text counts as empty; an empty text, or one that holds a marker,
stays as it is (form ``plain``); a text of one unit can have any parts empty; a
null id hashes as the empty string; repeated rows give equal rows; a line of any
length is one unit; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import ship

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SEED = 7
RATE = 100                 # percent of texts that are rearranged
SPM = 50                   # percent of these in the order suffix, prefix, middle


class Exceptions:
    """The multibyte characters of a UTF-8 text: where they start and their excess bytes."""

    def __init__(self, raw: np.ndarray):
        self.byte = np.flatnonzero(raw >= 0xC0)
        lead = raw[self.byte]
        excess = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        self.before = np.concatenate([[0], np.cumsum(excess)])
        self.char = self.byte - self.before[:-1]

    def to_byte(self, chars):
        """Byte position of a code-point cut."""
        return chars + self.before[np.searchsorted(self.char, chars)]

    def to_char(self, places):
        """Code-point position of a byte cut at the border of a character."""
        return places - self.before[np.searchsorted(self.byte, places)]


def _line_borders(raw: np.ndarray) -> np.ndarray:
    ends = np.flatnonzero(raw == 10) + 1
    last = [len(raw)] if len(raw) and (not len(ends) or ends[-1] != len(raw)) else []
    return np.concatenate([[0], ends, last]).astype(np.int64)


def cut(text: bytes, draws: tuple[int, int, int, int], unit: str = "line", rate: int = RATE,
        spm: int = SPM) -> tuple[int, str, tuple | None, tuple | None, bytes]:
    """``(units, form, byte cuts, code-point cuts, output)`` of one text."""
    raw = np.frombuffer(text, np.uint8)
    index = Exceptions(raw)
    if unit == "line":
        borders = _line_borders(raw)
        n = len(borders) - 1
    else:
        n = int(index.to_char(np.int64(len(raw))))
    h1, h2, h3, h4 = draws
    if not text or PREFIX in text or SUFFIX in text or MIDDLE in text or h3 % 100 >= rate:
        return n, "plain", None, None, text
    units = np.sort(np.array([h1 % (n + 1), h2 % (n + 1)], np.int64))
    if unit == "line":
        places = borders[units]
        chars = index.to_char(places)
    else:
        chars = units
        places = index.to_byte(chars)
    a, b = places.tolist()
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < spm:
        form, out = "spm", SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle
    else:
        form, out = "psm", PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle
    return n, form, (a, b), tuple(chars.tolist()), out


def _cut_rows(unit: str, rate: int, spm: int):
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "prefix_bytes", "middle_bytes", "output"]

    def run(batches):
        for pdf in batches:
            rows = []
            for doc_id, text, *draws in zip(*(pdf[c] for c in ("doc_id", "raw", "h1", "h2", "h3", "h4"))):
                n, form, places, chars, out = cut(bytes(text), tuple(draws), unit, rate, spm)
                rows.append((doc_id, n, form, *((chars[0], chars[1] - chars[0], places[0], places[1] - places[0])
                                                if chars else (None,) * 4), out))
            found = pd.DataFrame(rows, columns=names)
            yield found.astype({c: "Int64" for c in names[3:7]})
    return run


def infill(docs: DataFrame, unit: str = "line", rate: int = RATE, spm: int = SPM, seed: int = SEED,
           doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document rearranged: ``doc_id, n, form``, its cuts in code points and bytes, ``output``.

    ``n`` counts units (``unit``: ``line`` or ``char``); the cuts are null in
    form ``plain``.  No row moves to another task.
    """
    if unit not in ("line", "char"):
        raise ValueError(f"unit is line or char, not {unit}")
    ship(docs.sparkSession)
    one = F.col(doc_id).cast("long")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(one.cast("string"), F.lit(""))), 256)
    draws = [F.conv(F.substring("_digest", 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]
    # Ids travel as text: a null would turn the numbers of its batch into floats.
    rows = docs.select(one.cast("string").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("raw"),
                       digest.alias("_digest")).select("doc_id", "raw", *draws)
    cuts = rows.mapInPandas(_cut_rows(unit, rate, spm),
                            "doc_id string, n long, form string, prefix_chars long, middle_chars long, "
                            "prefix_bytes long, middle_bytes long, output binary")
    return cuts.withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("output", F.col("output").cast("string"))


def restored(output: Column, form: Column) -> Column:
    """The text that ``infill`` rearranged.

    A rearranged text holds each marker once: none occurs in the text, and no
    border of two parts can make one, as no end of a marker starts another.
    """
    p, s, m = (x.decode() for x in (PREFIX, SUFFIX, MIDDLE))
    middle = F.substring_index(output, m, -1)
    head = F.substring_index(output, m, 1)
    inner = lambda a, b: F.concat(a, middle, b)
    psm = inner(F.substring_index(F.substring_index(head, s, 1), p, -1), F.substring_index(head, s, -1))
    spm = inner(F.substring_index(head, p, -1), F.substring_index(F.substring_index(head, p, 1), s, -1))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
