"""Versioned code rules kept as a table, matched by a prefix index.

A rule row ``(rule, version, low, high, length)`` holds for a normalised code
whose first ``length`` characters lie between ``low`` and ``high`` (both included,
compared as strings); a plain prefix is a range from itself to itself.  A NULL
version holds for every version, a NULL length compares the whole code.

A string range is cut into prefixes: below ``low`` and ``high`` every position that
turns off their path, with each character that occurs in the codes, opens a
prefix all of whose codes are inside; what is left are the prefixes of ``high``
itself, which hold for a code that ends there.  Codes are exploded to their
prefixes, and one equality join on (version, prefix) decides every rule: no code meets a
rule that it does not satisfy.  Distinct codes are matched, rows take their
code's rules by a second join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.functions.dictionaries import CodeRule
from wardline.functions.match import normalise_code
from wardline.operators.joins import keyed_join, materialize
from wardline.operators.patterns import match_rows

c = F.col

RULE_SCHEMA = "rule string, version int, low string, high string, length int"
_WHOLE = 2 ** 31 - 1


def rules_frame(spark, rules: Sequence[CodeRule]) -> DataFrame:
    """The code part of rule constants as a rule table."""
    rows = [(r.name, version, low, high, len(low)) for r in rules for version, codes in r.by_version.items()
            for low, high in [(p, p) for ps in codes.prefixes.values() for p in ps] + list(codes.ranges)]
    return spark.createDataFrame(rows, RULE_SCHEMA)


def titles_frame(spark, rules: Sequence[CodeRule]) -> DataFrame:
    """The title part of rule constants as a pattern table (``%`` for any text within a term)."""
    return spark.createDataFrame([(r.name, t.replace(".*", "%")) for r in rules for t in r.title_terms],
                                 "rule string, pattern string")


def rule_keys(rules: DataFrame, alphabet: Sequence[str]) -> DataFrame:
    """``rule, version, key, whole``: prefixes whose codes satisfy a rule, or, ``whole``, single codes."""
    letters = F.array(*[F.lit(ch) for ch in sorted(alphabet)]).cast("array<string>")
    # Positions of a bound, none for an empty one.
    places = lambda b: F.when(F.length(b) > 0, F.sequence(F.lit(1), F.length(b))).otherwise(F.array().cast("array<int>"))
    turns = lambda b, keep: F.flatten(F.transform(places(b), lambda i: F.transform(
        F.filter(letters, lambda ch: keep(ch, F.substr(b, i, F.lit(1)))), lambda ch: F.concat(F.substr(b, F.lit(1), i - 1), ch))))
    low, high = c("low"), c("high")
    above = F.filter(turns(low, lambda ch, at: ch > at), lambda q: (q < high) & ~high.startswith(q))
    below = F.filter(turns(high, lambda ch, at: ch < at), lambda q: q >= low)
    inside = F.when((low < high) & ~high.startswith(low), F.array(low)).otherwise(F.array().cast("array<string>"))
    ends = F.filter(F.transform(F.sequence(F.lit(0), F.length(high)), lambda i: F.substr(high, F.lit(1), i)), lambda q: q >= low)
    entry = lambda keys, whole: F.transform(keys, lambda q: F.struct(
        q.alias("key"), (F.lit(whole) & (F.length(q) < c("length"))).alias("whole")))
    cut = F.concat(entry(F.concat(above, inside, below), False), entry(ends, True))
    return (rules.where(low.isNotNull() & high.isNotNull() & (low <= high))
            .withColumn("length", F.coalesce(c("length"), F.lit(_WHOLE)))
            .select("rule", "version", "length", F.explode(cut).alias("_k"))
            .where(F.length(c("_k.key")) <= c("length"))
            .select("rule", "version", c("_k.key").alias("key"), c("_k.whole").alias("whole")).distinct())


def matched_codes(codes: DataFrame, rules: DataFrame) -> DataFrame:
    """``code, version, rule`` of distinct normalised codes (``code, version``) and the rules they satisfy."""
    codes = materialize(codes.where(c("code").isNotNull()).distinct())
    # Distinct characters: bounded by the character set.
    alphabet = [r[0] for r in codes.select(F.explode(F.array_distinct(F.split("code", ""))).alias("ch")).distinct().collect() if r[0]]
    keys = materialize(rule_keys(rules, alphabet))
    longest = keys.agg(F.coalesce(F.max(F.length("key")), F.lit(0))).first()[0]
    size = F.length("code")
    prefixes = codes.select("code", "version", F.explode(F.transform(
        F.sequence(F.lit(0), F.least(size, F.lit(longest))),
        lambda i: F.struct(F.substr(c("code"), F.lit(1), i).alias("key"), (i == size).alias("ends")))).alias("_p")).select(
        "code", "version", "_p.key", "_p.ends")
    found = []
    for part, on in ((keys.where(c("version").isNotNull()), ["version", "key"]), (keys.where(c("version").isNull()).drop("version"), ["key"])):
        met = keyed_join(prefixes, part, None, on, "inner").where(~c("whole") | c("ends"))
        found.append(met.select("code", "version", "rule"))
    return found[0].unionByName(found[1]).distinct()


def rule_hits(dx: DataFrame, rules: DataFrame, *, dictionary: DataFrame | None = None, titles: DataFrame | None = None,
              key: str = "hadm_id") -> DataFrame:
    """``key, rule``: distinct rules that some diagnosis row of the key satisfies.

    By its code and version, or, with ``dictionary`` and ``titles``, by its code's
    lower-cased dictionary title holding a pattern, whatever the version.
    """
    raw = materialize(dx.select("icd_code", "icd_version").distinct())
    named = raw.select("icd_code", "icd_version", normalise_code(c("icd_code")).alias("code"), c("icd_version").alias("version"))
    by_code = keyed_join(named, materialize(matched_codes(named.select("code", "version"), rules)), None, ["code", "version"], "inner").select(
        "icd_code", "icd_version", "rule")
    if titles is not None and dictionary is not None:
        by_code = by_code.unionByName(match_rows(dictionary, F.lower(F.coalesce(c("long_title"), F.lit(""))), titles,
                                                 pattern="pattern", carry=("icd_code", "icd_version"), keep=("rule",)))
    of_code = materialize(by_code.distinct())
    return keyed_join(dx.select(key, "icd_code", "icd_version"), of_code, None, ["icd_code", "icd_version"], "inner").select(key, "rule").distinct()
