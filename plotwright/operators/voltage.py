"""Voltage levels of a page from its texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import VOLTAGE_OF_DIGIT
from ..functions.text import bare_upper, let, stripped

# Fixed patterns: a feeder's name, whose first digit names the level, and headings of a bay or side in two languages.
FEEDER = r"(?i)^(?:BB|C|TC|T)([1-9])\d{1,2}$"
HEADING = r"(?i)\bPHIA(?:\s+SO\s*DO)?\b.*?(\d{2,3})\s*K\s*V|\bSO\s*DO\b.*?\bPHIA\b.*?(\d{2,3})\s*K\s*V"
HEADING_EN = r"(?i)\b(\d{2,3})\s*K\s*V\b\s*(?:SIDE|BAY)\b"


def feeder_level(text: Column) -> Column:
    levels = F.create_map(*[F.lit(x) for pair in VOLTAGE_OF_DIGIT.items() for x in pair])
    return F.try_element_at(levels, F.regexp_extract(stripped(text), FEEDER, 1))


def heading_level(text: Column) -> Column:

    def number(t: Column) -> Column:
        return F.when(t.rlike(HEADING), F.concat(F.regexp_extract(t, HEADING, 1), F.regexp_extract(t, HEADING, 2))).when(t.rlike(HEADING_EN), F.regexp_extract(t, HEADING_EN, 1))

    return let(let(bare_upper(text), number).cast("int"), lambda kv: F.when(kv.isin(*VOLTAGE_OF_DIGIT.values()), kv))


def voltage_levels(texts: DataFrame, page: str = "page_id", text: str = "text") -> DataFrame:
    """(page, voltage_level): sorted levels that feeders name; only on pages without one, those that headings name.

    Both are collected as sets of at most nine levels in one partial aggregate, so a page of any size is one small row.
    """
    found = texts.groupBy(page).agg(
        F.array_sort(F.collect_set(feeder_level(F.col(text)))).alias("feeders"),
        F.array_sort(F.collect_set(heading_level(F.col(text)))).alias("headings"),
    )
    return found.select(page, _first("feeders", "headings").alias("voltage_level"))


def _first(feeders: Column | str, headings: Column | str) -> Column:
    return F.when(F.size(feeders) > 0, feeders if isinstance(feeders, Column) else F.col(feeders)).otherwise(headings if isinstance(headings, Column) else F.col(headings))


def levels_within(texts: Column) -> Column:
    """:func:`voltage_levels` of an array with a page's texts."""
    levels = lambda rule: F.array_sort(F.array_distinct(F.array_compact(F.transform(texts, rule))))
    return _first(levels(feeder_level), levels(heading_level))
