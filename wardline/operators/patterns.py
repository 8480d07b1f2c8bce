"""Many patterns over many texts: ``text LIKE '%' || pattern || '%'`` by a rare-gram index.

The study writes its dictionaries out as conditions, which suits a dozen terms.
A dictionary kept as a table can have any number of them, and meets the texts
by equality:

1. A text that matches a pattern holds every run of ordinary characters of it,
   hence every gram (``GRAM`` characters) of these runs.  Grams of the patterns are
   counted over the distinct texts, and each pattern is keyed by the gram that fewest
   texts hold.  A gram that no text holds settles its pattern without a look at a text.
2. Distinct texts meet the patterns on the grams that key some pattern.
   Patterns whose runs are all shorter are keyed by a pair or a single
   character; without ordinary characters (``%``, ``_``) by the empty gram, which all texts have.
3. ``LIKE`` with its wildcards decides, once per distinct text and pattern.

Both joins broadcast the pattern side only while it is small by rows and bytes,
and keep hot keys apart beyond that (:func:`wardline.operators.joins.keyed_join`).
All of it runs on built-in functions.

``%`` and ``_`` are wildcards and a backslash makes the next character ordinary, the
pattern's own last one included (it then escapes the closing ``%``).  A NULL pattern
matches nothing, a NULL text is taken as given by the caller.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.operators.joins import keyed_join, materialize

c = F.col

GRAM = 3
# Stands for a wildcard, and before an escaped character, where runs are told apart.
_WILD, _ESCAPED = "\x00", "\ue000"


def like_anywhere(pattern: Column) -> Column:
    """``'%' || pattern || '%'``, with backslashes only where ``LIKE`` wants them.

    A backslash before another character than ``%``, ``_`` and itself is dropped,
    which leaves that character ordinary.
    """
    return F.regexp_replace(F.concat(F.lit("%"), pattern, F.lit("%")), r"(?s)(\\[%_\\])|\\(.)", "$1$2")


def _grams(text: Column, size: int, of: str = ".") -> Column:
    """All substrings of ``size`` characters, overlapping ones included."""
    return F.regexp_extract_all(text, F.lit(f"(?s)(?=({of}{{{size}}}))"), F.lit(1))


def pattern_grams(pattern: Column) -> Column:
    """The grams that any text matching ``'%' || pattern || '%'`` holds, of the largest size it has.

    A pattern with the private character used here as a mark has the empty gram only.
    """
    marked = F.regexp_replace(F.concat(F.lit("%"), pattern, F.lit("%")), r"(?s)\\(.)", f"{_ESCAPED}$1")
    runs = F.replace(F.regexp_replace(marked, f"(?<!{_ESCAPED})[%_]", _WILD), F.lit(_ESCAPED), F.lit(""))
    none = F.array(F.lit(""))
    found = none
    for size in range(1, GRAM + 1):
        own = _grams(runs, size, f"[^{_WILD}]")
        found = F.when(F.size(own) > 0, F.array_distinct(own)).otherwise(found)
    return F.when(pattern.contains(_ESCAPED), none).otherwise(found)


def _text_grams(texts: DataFrame, sizes: Sequence[int]) -> DataFrame:
    """``_text, _gram``: the distinct grams of each distinct text, of the sizes asked for."""
    parts = [_grams(c("_text"), s) if s else F.array(F.lit("")) for s in sizes]
    return texts.select("_text", F.explode(F.array_distinct(F.flatten(F.array(*parts)))).alias("_gram"))


def rarest_grams(texts: DataFrame, patterns: DataFrame) -> DataFrame:
    """``_pattern, _gram``: each distinct pattern with the gram of it that fewest texts hold.

    Patterns with a gram that no text holds match nothing and are left out.
    ``texts`` has distinct ``_text``, ``patterns`` distinct ``_pattern``.
    """
    grams = patterns.select("_pattern", F.explode(pattern_grams(c("_pattern"))).alias("_gram"))
    wanted = materialize(grams.select("_gram").distinct())
    sizes = [r[0] for r in wanted.select(F.length("_gram")).distinct().collect()]        # GRAM + 1 at most
    held = keyed_join(_text_grams(texts, sorted(sizes) or [0]), wanted, ["_gram"], "_gram", "left_semi")
    counts = held.groupBy("_gram").agg(F.count(F.lit(1)).alias("_n"))
    # A pattern with n grams of which m are held by texts can match when m = n.
    met = grams.join(counts, "_gram").groupBy("_pattern").agg(
        F.min(F.struct("_n", "_gram")).alias("_least"), F.count(F.lit(1)).alias("_held"))
    return (met.join(grams.groupBy("_pattern").agg(F.count(F.lit(1)).alias("_all")), "_pattern")
            .where(c("_held") == c("_all")).select("_pattern", c("_least._gram").alias("_gram")))


def match_texts(texts: DataFrame, patterns: DataFrame) -> DataFrame:
    """``_text, _pattern`` of every match; both sides distinct."""
    texts = materialize(texts)
    keyed = materialize(rarest_grams(texts, patterns))
    sizes = [r[0] for r in keyed.select(F.length("_gram")).distinct().collect()]         # GRAM + 1 at most
    if not sizes:
        return texts.select("_text", F.lit(None).cast("string").alias("_pattern")).where(F.lit(False))
    pairs = keyed_join(_text_grams(texts, sorted(sizes)), keyed, ["_gram", "_pattern"], "_gram", "inner")
    plain = ~c("_pattern").rlike(r"[%_\\]")
    hit = F.when(plain, c("_text").contains(c("_pattern"))).otherwise(F.like(c("_text"), like_anywhere(c("_pattern"))))
    return pairs.where(hit).select("_text", "_pattern")


def match_rows(df: DataFrame, text: Column, terms: DataFrame, *, pattern: str = "match_term",
               carry: Sequence[str] = (), keep: Sequence[str] = ()) -> DataFrame:
    """Distinct (``carry``, ``keep``) of every row of ``df`` whose ``text`` matches a row of ``terms``.

    Each distinct text is matched once; the rows then take its matches by an
    equality join.
    """
    rows = df.select(*carry, text.alias("_text"))
    named = terms.where(c(pattern).isNotNull()).select(*keep, c(pattern).alias("_pattern")).distinct()
    found = match_texts(rows.where(c("_text").isNotNull()).select("_text").distinct(), named.select("_pattern").distinct())
    of_text = materialize(keyed_join(found, named, None, "_pattern", "inner").select("_text", *keep).distinct())
    return keyed_join(rows.distinct(), of_text, None, "_text", "inner").select(*carry, *keep).distinct()


def classify_rows(df: DataFrame, text: str, terms: DataFrame, *, pattern: str = "match_term", priority: str = "priority",
                  generic: str = "generic_name", cls: str = "statin_type",
                  classes: Sequence[str] = ("lipophilic", "hydrophilic"),
                  names: tuple[str, str] = ("statin_type", "statin_class")) -> DataFrame:
    """``df`` with the generic of the matching term of least ``priority`` and the first class that matches.

    The table form of :func:`wardline.operators.exposure.classify_drugs`, over
    ``lower(text)``; rows without a match, NULL texts included, get NULLs.
    ``classes`` are in order of preference.
    """
    low = F.lower(c(text))
    texts = df.select(low.alias("_text")).where(c("_text").isNotNull()).distinct()
    named = terms.where(c(pattern).isNotNull()).select(priority, generic, cls, c(pattern).alias("_pattern")).distinct()
    met = keyed_join(match_texts(texts, named.select("_pattern").distinct()), named, None, "_pattern", "inner")
    rank = F.lit(None).cast("int")
    for i, name in reversed(list(enumerate(classes))):
        rank = F.when(c(cls) == name, F.lit(i)).otherwise(rank)
    best = met.groupBy("_text").agg(F.min(F.struct(priority, generic)).alias("_best"), F.min(rank).alias("_rank"))
    of_text = materialize(best.select("_text", c(f"_best.{generic}").alias(names[0]),
                                      F.get(F.array(*[F.lit(n) for n in classes]), c("_rank")).alias(names[1])))
    return keyed_join(df.withColumn("_text", low), of_text, None, "_text", "left").select(*df.columns, *names)


def flag_rows(df: DataFrame, key: str, text: Column, terms: DataFrame, *, pattern: str = "pattern",
              flag: str = "flag", include: str = "include") -> DataFrame:
    """``key, flag``: distinct flags whose include patterns occur in a text of the key and exclude patterns do not.

    ``terms`` has a pattern, the name of the flag it belongs to and whether it
    includes (true) or excludes; exclusion is by text, as in a guarded phrase.
    """
    rows = df.select(key, text.alias("_text")).where(c("_text").isNotNull())
    named = terms.where(c(pattern).isNotNull()).select(c(flag).alias("flag"), c(include).alias("_in"), c(pattern).alias("_pattern")).distinct()
    found = match_texts(rows.select("_text").distinct(), named.select("_pattern").distinct())
    met = keyed_join(found, named, None, "_pattern", "inner").groupBy("_text", "flag").agg(F.min(c("_in").cast("int")).alias("_ok"))
    of_text = materialize(met.where(c("_ok") == 1).select("_text", "flag"))
    return keyed_join(rows.distinct(), of_text, None, "_text", "inner").select(key, "flag").distinct()
