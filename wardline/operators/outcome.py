"""First-day outcome components.

Every operator comes in two layers:

* a *roll-up* that returns one row per stay **that has data** (the child
  table aggregated down to the stay key), used by the cohort pipelines so
  that each child is joined to the base exactly once;
* a *stage* that left-joins the roll-up to the base and fills defaults,
  which is the per-base stage table of the study.

Event rows are filtered (pushed to the scan where possible) and joined to
the narrow base key table (:mod:`wardline.operators.intervals`) before any
aggregation.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.functions import dictionaries as dic
from wardline.functions.decode import is_number
from wardline.functions.numbers import number_decimal, number_key, number_text
from wardline.functions.windows import flag, in_offset_window
from wardline.operators.intervals import window_join
from wardline.operators.joins import restrict

c = F.col


# ------------------------------------------------ U18: first-day minimum, timestamps

def window_min_rollup(base: DataFrame, events: DataFrame, *, key: str = "stay_id",
                      time: str = "charttime", value: str = "gcs",
                      start: str = "icu_intime", end: str | None = "icu_outtime",
                      length: str = dic.FIRST_DAY, valid: tuple[int, int] = dic.GCS_VALID_RANGE,
                      low_below: int = dic.GCS_LOW_BELOW,
                      names: tuple[str, str] = ("gcs_min_firstday", "first_low_gcs_time"),
                      ) -> DataFrame:
    """Per stay with a valid value in ``[start, least(end, start + length))``.

    Returns ``key, <min value>, <first time the value is below low_below>``.
    """
    lo, hi = valid
    ev = events.where(c(value).isNotNull() & c(value).between(lo, hi)).select(key, time, value)
    joined = window_join(ev, base, key=key, time=time, start=start, end=end, length=length)
    return joined.groupBy(key).agg(
        F.min(value).alias(names[0]),
        F.min(F.when(c(value) < low_below, c(time))).alias(names[1]),
    )


def window_min(base: DataFrame, events: DataFrame, *, key: str = "stay_id",
               low_below: int = dic.GCS_LOW_BELOW,
               names: tuple[str, str, str] = ("gcs_min_firstday", "first_low_gcs_time",
                                              "sae_by_gcs_firstday"), **kw) -> DataFrame:
    """Stage table: every base stay, NULL minimum when no valid value, flag 0."""
    agg = window_min_rollup(base, events, key=key, low_below=low_below, names=names[:2], **kw)
    return base.select(key).join(agg, key, "left").select(
        key, names[0], names[1],
        flag(c(names[0]) < low_below, "smallint").alias(names[2]))


# ------------------------------------------------ U20: first-day minimum, offsets

def offset_min(events: DataFrame, *, key: str = "patientunitstayid",
               offset: str = "nursingchartoffset", value: str = "nursingchartvalue",
               label: str = "nursingchartcelltypevallabel",
               name: str = "nursingchartcelltypevalname",
               category: str = "nursingchartcelltypecat",
               pairs: Sequence[tuple[str, str]] = dic.GCS_LABEL_NAME_PAIRS,
               categories: Sequence[str] = dic.GCS_CATEGORIES,
               window: tuple[int, int] = dic.FIRST_DAY_OFFSETS,
               valid_open: tuple[int, int] = dic.GCS_OFFSET_VALID_OPEN,
               low_below: int = dic.GCS_LOW_BELOW,
               restrict_to: DataFrame | None = None, as_text: bool = False) -> DataFrame:
    """Per stay: minimum score per offset first, then validity, then the first day.

    Rows whose text is not a number of a listed (label, name) pair add only
    NULLs to their offset's minimum, so they are dropped before the shuffle;
    the validity range is applied to the per-offset minimum, never to single
    rows (values {1, 14} at one offset remove that offset).  Only stays with
    a valid value appear.  ``restrict_to`` (a key table) semi-joins the
    events first when the caller needs only those stays.

    Scores are compared as number keys, with all their digits; ``as_text``
    delivers the minimum as text with all of them, in place of the widest
    decimal that holds the valid range.
    """
    ev = events.where(c(category).isin(*categories) & in_offset_window(c(offset), *window)
                      & _pairs(label, name, pairs) & is_number(c(value)))
    if restrict_to is not None:
        ev = restrict(ev, restrict_to, key)
    per_offset = (ev.groupBy(key, offset).agg(F.min(number_key(c(value))).alias("_score"))
                    .where(_valid(valid_open)))
    return per_offset.groupBy(key).agg(*_score_outcomes(offset, low_below, valid_open, as_text))


def _pairs(label: str, name: str, pairs: Sequence[tuple[str, str]]):
    cond = F.lit(False)
    for lab, nam in pairs:
        cond = cond | ((c(label) == lab) & (c(name) == nam))
    return cond


def _key(value: float) -> Column:
    return number_key(F.lit(f"{Decimal(str(value)):f}"))


def _valid(valid_open: tuple[float, float]) -> Column:
    lo, hi = valid_open
    return (c("_score") > _key(lo)) & (c("_score") < _key(hi))


def score_scale(valid_open: tuple[float, float]) -> int:
    """Fraction digits of the widest decimal that holds every whole part of the valid range."""
    return 38 - max(len(str(abs(int(bound)))) for bound in valid_open)


def _score_outcomes(offset: str, low_below: float, valid_open: tuple[float, float], as_text: bool = False) -> list:
    """Outcome columns of valid per-offset minima ``_score`` (NULL where an offset has none)."""
    least, low = F.min("_score"), _key(low_below)
    number = number_text(least) if as_text else number_decimal(least, score_scale(valid_open))
    return [number.alias("gcs_min_firstday"),
            F.min(F.when(c("_score").isNotNull(), c(offset))).alias("first_gcs_offset"),
            F.min(F.when(c("_score") < low, c(offset))).alias("first_low_gcs_offset_firstday"),
            flag(least < low, "smallint").alias("sae_by_gcs_firstday")]


def offset_outcomes(events: DataFrame, *, key: str = "patientunitstayid",
                    offset: str = "nursingchartoffset", value: str = "nursingchartvalue",
                    label: str = "nursingchartcelltypevallabel",
                    name: str = "nursingchartcelltypevalname",
                    category: str = "nursingchartcelltypecat",
                    pairs: Sequence[tuple[str, str]] = dic.GCS_LABEL_NAME_PAIRS,
                    categories: Sequence[str] = dic.GCS_CATEGORIES,
                    window: tuple[int, int] = dic.FIRST_DAY_OFFSETS,
                    valid_open: tuple[int, int] = dic.GCS_OFFSET_VALID_OPEN,
                    low_below: int = dic.GCS_LOW_BELOW) -> DataFrame:
    """U20 and U23 from one scan: per stay with a score or a charted condition, all outcome columns.

    Score rows and condition rows are kept by one filter and aggregated by
    (stay, offset), then by stay; what a stay lacks is NULL (the score flag 0).
    """
    scored = F.coalesce(c(category).isin(*categories) & _pairs(label, name, pairs) & is_number(c(value)), F.lit(False))
    charted = F.coalesce(_charted(label, name, value), F.lit(False))
    rows = (events.where(in_offset_window(c(offset), *window) & (scored | charted))
            .select(key, offset, F.when(scored, number_key(c(value))).alias("_score"), flag(charted).alias("_charted")))
    per_offset = rows.groupBy(key, offset).agg(F.min("_score").alias("_score"),
                                               F.max("_charted").alias("_charted"))
    valid = F.when(_valid(valid_open), c("_score"))
    first = F.min(F.when(c("_charted") == 1, c(offset)))
    return per_offset.withColumn("_score", valid).groupBy(key).agg(
        *_score_outcomes(offset, low_below, valid_open), first.alias("first_delirium_offset"),
        F.when(first.isNotNull(), F.lit(1)).cast("smallint").alias("delirium_firstday"))


# ------------------------------------------------ U21/U22: feature co-occurrence rule

def _feature_bits(itemid, item_map: Mapping[int, Sequence[int]]):
    return [F.when(itemid.isin(*ids), 1).otherwise(0).alias(f"feat{n}")
            for n, ids in sorted(item_map.items())]


def _feature_events(base: DataFrame, events: DataFrame, *, key: str, time: str,
                    item_map: Mapping[int, Sequence[int]], start: str, end: str | None,
                    length: str, excluded_value: str,
                    positive: Sequence[float] | None = None) -> DataFrame:
    all_items = [i for ids in item_map.values() for i in ids]
    ev = (events
          .where(c("itemid").isin(*all_items)
                 & ~c("value").ilike(excluded_value)     # NULL text drops the row
                 & (c("valuenum").isNotNull() if positive is None
                    else c("valuenum").isin(*positive)))
          .select(key, time, "itemid", "valuenum"))
    return window_join(ev, base, key=key, time=time, start=start, end=end, length=length)


def feature_rows(base: DataFrame, events: DataFrame, *, key: str = "stay_id",
                 time: str = "charttime",
                 item_map: Mapping[int, Sequence[int]] = dic.CAM_FEATURE_ITEMS,
                 start: str = "icu_intime", end: str | None = "icu_outtime",
                 length: str = dic.FIRST_DAY,
                 excluded_value: str = dic.CAM_EXCLUDED_VALUE,
                 positive: Sequence[float] | None = None) -> DataFrame:
    """Stage table: distinct charted feature rows in the first-day window, with bits.

    Any charted number counts, also 0; ``positive`` names the values that do instead.
    """
    ev = _feature_events(base, events, key=key, time=time, item_map=item_map, start=start,
                         end=end, length=length, excluded_value=excluded_value, positive=positive)
    return ev.select(key, time, "itemid", "valuenum",
                     *_feature_bits(c("itemid"), item_map)).distinct()


def _rule_positive(feats: Sequence[str], positive_sets: Sequence[Sequence[int]]):
    cond = None
    for req in positive_sets:
        total = None
        for n in req:
            total = c(f"feat{n}") if total is None else total + c(f"feat{n}")
        one = total >= len(req)
        cond = one if cond is None else (cond | one)
    return cond


def rule_positive_rollup(features: DataFrame, *, key: str = "stay_id", time: str = "charttime",
                         item_map: Mapping[int, Sequence[int]] = dic.CAM_FEATURE_ITEMS,
                         positive_sets: Sequence[Sequence[int]] = dic.CAM_POSITIVE_SETS,
                         has_bits: bool = True) -> DataFrame:
    """Per stay with a positive instant: the first positive time.

    Bits are or-ed per (stay, instant); an instant is positive when every
    feature of one required set is present.  Duplicate feature rows do not
    change a maximum, so no ``distinct`` is needed on this path.
    """
    if not has_bits:
        features = features.select(key, time, *_feature_bits(c("itemid"), item_map))
    feats = [f"feat{n}" for n in sorted(item_map)]
    instants = features.groupBy(key, time).agg(
        *[F.coalesce(F.max(f), F.lit(0)).alias(f) for f in feats])
    positive = instants.where(_rule_positive(feats, positive_sets))
    return positive.groupBy(key).agg(F.min(time).alias("first_delirium_time"))


def rule_status(base: DataFrame, features: DataFrame, *, key: str = "stay_id", **kw) -> DataFrame:
    """Stage table: every base stay, first positive time (or NULL) and a 0/1 flag."""
    pos = rule_positive_rollup(features, key=key, **kw)
    return base.select(key).join(pos, key, "left").select(
        key, "first_delirium_time",
        flag(c("first_delirium_time").isNotNull(), "smallint").alias("delirium_positive_firstday"))


def cam_positive_rollup(base: DataFrame, events: DataFrame, *, key: str = "stay_id",
                        time: str = "charttime",
                        item_map: Mapping[int, Sequence[int]] = dic.CAM_FEATURE_ITEMS,
                        positive_sets: Sequence[Sequence[int]] = dic.CAM_POSITIVE_SETS,
                        start: str = "icu_intime", end: str | None = "icu_outtime",
                        length: str = dic.FIRST_DAY,
                        excluded_value: str = dic.CAM_EXCLUDED_VALUE,
                        positive: Sequence[float] | None = None) -> DataFrame:
    """Pipeline path of U21+U22: window-filtered feature events straight to positives."""
    ev = _feature_events(base, events, key=key, time=time, item_map=item_map, start=start,
                         end=end, length=length, excluded_value=excluded_value, positive=positive)
    return rule_positive_rollup(ev, key=key, time=time, item_map=item_map,
                                positive_sets=positive_sets, has_bits=False)


# ------------------------------------------------ U23: charted condition, first offset

def _charted(label: str, name: str, value: str, word: str = dic.DELIRIUM_WORD,
             positive_values: Sequence[str] = dic.DELIRIUM_POSITIVE_VALUES,
             positive_label: str = dic.DELIRIUM_POSITIVE_LABEL):
    low = {k: F.lower(F.coalesce(c(k), F.lit(""))) for k in (label, name, value)}
    mentions = low[label].contains(word) | low[name].contains(word) | low[value].contains(word)
    return mentions & (low[value].isin(*positive_values) | (low[label] == positive_label))


def charted_first(events: DataFrame, *, key: str = "patientunitstayid",
                  offset: str = "nursingchartoffset", value: str = "nursingchartvalue",
                  label: str = "nursingchartcelltypevallabel",
                  name: str = "nursingchartcelltypevalname",
                  word: str = dic.DELIRIUM_WORD,
                  positive_values: Sequence[str] = dic.DELIRIUM_POSITIVE_VALUES,
                  positive_label: str = dic.DELIRIUM_POSITIVE_LABEL,
                  window: tuple[int, int] = dic.FIRST_DAY_OFFSETS,
                  restrict_to: DataFrame | None = None) -> DataFrame:
    """Per stay with a positive charted condition in the window: first offset, flag 1.

    The word may sit in label, name or value; positive means a positive
    value word, or the one label that states presence (its value is then
    ignored).
    """
    ev = events.where(in_offset_window(c(offset), *window)
                      & _charted(label, name, value, word, positive_values, positive_label))
    if restrict_to is not None:
        ev = restrict(ev, restrict_to, key)
    return ev.groupBy(key).agg(
        F.min(offset).alias("first_delirium_offset"),
        F.lit(1).cast("smallint").alias("delirium_firstday"))
