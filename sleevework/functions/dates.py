"""Partial dates: ``struct<year int, month int, day int>`` with optional month and day.

Ranges are checked, the calendar is not: 31 February is a valid partial date, so nothing here is
ever cast to DATE.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sleevework.functions.core import digits, let
from sleevework.functions.text import strip

PARTIAL_DATE = "struct<year:int,month:int,day:int>"

# The accepted date shapes and the month names.
ISO_SHAPE = r"^(\d{4})(?:-(\d{2})(?:-(\d{2}))?)?$"
FRAGMENT_SHAPE = r"#(\d{4})(\d{2})?(\d{2})?$"
QUERY_SHAPE = r"year=(\d{4})(?:&month=(\d{1,2}))?(?:&day=(\d{1,2}))?"
TEXT_SHAPE = r"^([A-Za-z]{3})[a-z]*(?:\s+(\d{1,2}),)?\s+(\d{4})$"
YEAR_SHAPE = r"^(\d{4})$"
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")


def is_valid_date(year: Column, month: Column, day: Column) -> Column:
    month_ok = month.isNull() | month.between(1, 12)
    day_ok = day.isNull() | (day.between(1, 31) & month.isNotNull())
    return year.isNotNull() & month_ok & day_ok


def make_date(year: Column, month: Column, day: Column) -> Column:
    """The struct if the parts are valid, else NULL."""
    parts = F.struct(year.alias("year"), month.alias("month"), day.alias("day"))
    return let(parts, lambda p: F.when(is_valid_date(p["year"], p["month"], p["day"]), p))


def _from_groups(value: Column, shape: str) -> Column:
    year, month, day = (digits(F.regexp_extract(value, shape, i), "int") for i in (1, 2, 3))
    return make_date(year, month, day)


def parse_partial_date(value: Column) -> Column:
    """Strict ``YYYY``, ``YYYY-MM`` or ``YYYY-MM-DD``."""
    return let(strip(value), lambda text: _from_groups(text, ISO_SHAPE))


def parse_text_date(value: Column) -> Column:
    """``Mon DD, YYYY``, ``Month YYYY`` or ``YYYY``."""

    def read(text: Column) -> Column:
        # position of the name in the list, 0 for an unknown name
        month = F.array_position(F.expr(f"array{MONTHS}"), F.lower(F.regexp_extract(text, TEXT_SHAPE, 1))).cast("int")
        year, day = (digits(F.regexp_extract(text, TEXT_SHAPE, i), "int") for i in (3, 2))
        named = make_date(year, month, day)
        return F.when(text.rlike(YEAR_SHAPE), _from_groups(text, f"{YEAR_SHAPE}()()")).otherwise(named)

    return let(strip(value), read)


def partial_date(value: Column) -> Column:
    """A calendar link or date text. A link-shaped match that is invalid ends in NULL."""
    def read(text: Column) -> Column:
        return (
            F.when(text.rlike(FRAGMENT_SHAPE), _from_groups(text, FRAGMENT_SHAPE))
            .when(text.rlike(QUERY_SHAPE), _from_groups(text, QUERY_SHAPE))
            .otherwise(F.coalesce(parse_partial_date(text), parse_text_date(text)))
        )

    return let(value, read)


def release_date(href: Column, text: Column) -> Column:
    return F.coalesce(partial_date(href), partial_date(text))


def precision(date: Column) -> Column:
    return let(date, lambda d: F.when(d["day"].isNotNull(), "day").when(d["month"].isNotNull(), "month").when(d["year"].isNotNull(), "year"))


def iso(date: Column) -> Column:
    """Zero-padded text, as long as the date is precise."""

    def show(d: Column) -> Column:
        parts = [F.lpad(d[p].cast("string"), width, "0") for p, width in (("year", 4), ("month", 2), ("day", 2))]
        return F.when(d.isNotNull(), F.concat_ws("-", *parts))

    return let(date, show)
