"""Column expressions (``Column -> Column``) shared by the operators.

All of these compile to built-in Catalyst expressions: no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from promoflow import settings as S


def blank(c: Column) -> Column:
    """True when a string is NULL or empty (a required non-empty text is missing)."""
    return F.coalesce(F.length(c), F.lit(0)) == 0


def those_said(*texts: Column) -> Column:
    """The texts that are not NULL, in order, as an array.  They hold no comma and are not
    empty; they are joined and cut, as a filter over an array of them would keep the conditions
    they stand under out of generated code."""
    said = F.concat_ws(",", *texts)
    return F.when(said == "", F.array().cast("array<string>")).otherwise(F.split(said, ","))


def parse_ts(c: Column, fmt: str = S.TIMESTAMP_FORMAT) -> Column:
    """Wall-clock timestamp from text; NULL when it does not parse."""
    return F.try_to_timestamp(c, F.lit(fmt)).cast("timestamp_ntz")


def date_and_time(date: Column, time: Column) -> Column:
    """``date + ' ' + time`` (X5); NULL if either part is NULL."""
    return F.concat(date, F.lit(" "), time)


def event_time_text(c: Column) -> Column:
    """First 19 characters with ``T`` replaced by a space."""
    return F.replace(F.substring(c, 1, 19), F.lit("T"), F.lit(" "))


def zone_or_default(c: Column, default: str = S.DEFAULT_TIME_ZONE) -> Column:
    """Empty zone falls back to the default zone."""
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(default))


def time_or_default(c: Column, default: str) -> Column:
    """Keep a time of day that matches the pattern, else the default."""
    return F.when(F.coalesce(c.rlike(S.TIME_OF_DAY_PATTERN), F.lit(False)), c).otherwise(F.lit(default))


def zone_region(c: Column) -> Column:
    """Zone abbreviation to a region id (NULL when unknown)."""
    m = F.create_map(*[x for k, v in S.ZONE_REGIONS.items() for x in (F.lit(k), F.lit(v))])
    return m[c]


def source_from_labels(labels: Column) -> Column:
    """Offer source from the labels: tetris, then tio, else the default source."""
    return (F.when(F.array_contains(labels, S.LABEL_TETRIS), F.lit(S.SOURCE_TETRIS))
            .when(F.array_contains(labels, S.LABEL_TIO), F.lit(S.SOURCE_TIO))
            .otherwise(F.lit(S.SOURCE_BROADREACH)))


def any_label_in(labels: Column, values) -> Column:
    """Overlap of the labels with a fixed list; an absent label list counts as empty (F8)."""
    return F.coalesce(F.arrays_overlap(labels, F.array(*[F.lit(v) for v in values])), F.lit(False))


def first_element(arr: Column) -> Column:
    """First element or NULL; never fails on an empty array (O3)."""
    return F.get(arr, 0)


def joined_text(arr: Column) -> Column:
    """Array to comma text, NULL kept as NULL (X2 with the guard of P5)."""
    return F.when(arr.isNotNull(), F.concat_ws(",", arr))


def joined_text_or_empty(arr: Column) -> Column:
    return F.when(arr.isNotNull(), F.concat_ws(",", arr)).otherwise(F.lit(""))


def flatten_lists(arr_of_arr: Column) -> Column:
    """Flatten, skipping NULL inner arrays."""
    return F.flatten(F.filter(arr_of_arr, lambda a: a.isNotNull()))


def long_array(arr: Column) -> Column:
    """Text array to BIGINT array; bad elements become NULL."""
    return F.transform(arr, lambda x: x.try_cast("bigint"))
