"""Text and time helpers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def tokens(text: Column) -> Column:
    """Split on every single space; an empty line gives one empty token."""
    return F.split(text, " ")


def distinct_tokens(text: Column) -> Column:
    return F.array_distinct(tokens(text))


def time_text(ts: Column) -> Column:
    return F.date_format(ts, TIME_FORMAT)


def year_of(text: Column) -> Column:
    """Year of a timestamp text, null when the text is no timestamp."""
    return F.year(text.try_cast("timestamp"))


def tag_list(tags: Column, mode: str = "every") -> Column:
    """Tags of ``<a><b>``: each one, or (``glued``) the brackets dropped and the rest split on spaces."""
    if mode == "every":
        return F.regexp_extract_all(tags, F.lit("<([^>]+)>"), 1)
    if mode == "glued":
        return F.split(F.regexp_replace(tags, "[<>]", ""), " ")
    raise ValueError(f"unknown tag mode {mode!r}")


def millis_between(first: Column, second: Column) -> Column:
    return F.unix_millis(second) - F.unix_millis(first)


def whole_minutes(first: Column, second: Column) -> Column:
    """Whole minutes from the first to the second time, cut toward zero."""
    return (millis_between(first, second) / F.lit(60000)).cast("bigint")
