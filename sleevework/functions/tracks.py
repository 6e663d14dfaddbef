"""Track ranges and name lists written in prose."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sleevework.functions.core import let
from sleevework.functions.text import strip

# A track token with optional ~ end, the widest range believed, and name separators.
TRACK_TOKEN = r"(?i)M?-?0*(\d+)(?:\s*~\s*M?-?0*(\d+))?"
WIDEST_RANGE = 500
NAME_SEPARATOR = r"(?iU)\s*(?:,|;|&|/|\band\b)\s*"
MAY_SEPARATE = "(?i)[,;&/]|and"  # found wherever a separator is
TRAILING_PAREN = r"(?U)\s*\([^)]*\)\s*$"
STANDALONE_BY = r"(?iU)\bby\b"
NAME_EDGE = " ,;&/"


def _tokens(raw: Column) -> Column:
    """``array<struct<token, start, last, reason>>``; the reason, if any, why a token names no tracks."""

    def judge(token: Column, first: Column, end: Column, widest: Column) -> Column:
        start, last = first.try_cast("bigint"), F.when(end != "", end).otherwise(first).try_cast("bigint")

        def reason(x: Column) -> Column:
            return (
                F.when(x["start"].isNull() | x["last"].isNull(), "beyond 64 bits")
                .when(x["start"] > x["last"], "backwards")
                .when(F.coalesce(F.try_subtract(x["last"], x["start"]) > widest, F.lit(True)), "too wide")
            )

        return let(F.struct(start.alias("start"), last.alias("last")), lambda x: F.struct(token.alias("token"), x["start"].alias("start"), x["last"].alias("last"), reason(x).alias("reason")))

    def read(x: Column) -> Column:
        parts = [F.regexp_extract_all(x["raw"], F.lit(TRACK_TOKEN), i) for i in range(3)]
        return F.transform(F.arrays_zip(*[p.alias(n) for n, p in zip(("token", "first", "end"), parts)]), lambda t: judge(t["token"], t["first"], t["end"], x["widest"]))

    return let(raw, read)


def _token_list(text: Column, widest: int | Column) -> Column:
    width = F.lit(widest).cast("bigint") if isinstance(widest, int) else widest.cast("bigint")
    return _tokens(F.struct(text.alias("raw"), width.alias("widest")))


def parse_track_set(text: Column, widest: int | Column = WIDEST_RANGE) -> Column:
    """``1,4,5``, ``1~3``, ``M-01`` and mixtures -> distinct numbers in order of appearance.

    Ranges that run backwards or span more than ``widest``, and numbers beyond 64 bits, are left out;
    ``track_set_rejects`` lists them.
    """

    def numbers(found: Column) -> Column:
        kept = F.filter(found, lambda t: t["reason"].isNull())
        return F.array_distinct(F.flatten(F.transform(kept, lambda t: F.sequence(t["start"], t["last"]))))

    has_digit = text.rlike("[0-9]")
    return F.when(has_digit, numbers(_token_list(text, widest))).otherwise(F.array().cast("array<bigint>"))


def track_set_rejects(text: Column, widest: int | Column = WIDEST_RANGE) -> Column:
    """``array<struct<token, reason>>``: what ``parse_track_set`` leaves out, as written, and why."""
    left_out = F.filter(_token_list(text, widest), lambda t: t["reason"].isNotNull())
    return F.transform(left_out, lambda t: F.struct(t["token"].alias("token"), t["reason"].alias("reason")))


def split_names(text: Column) -> Column:
    """Names in a list; entries without a word character or with a "by" clause are no names."""

    def tidy(part: Column) -> Column:
        bare = let(F.btrim(part, F.lit(NAME_EDGE)), lambda p: F.when(p.contains("("), F.regexp_replace(p, TRAILING_PAREN, "")).otherwise(p))
        return strip(bare)

    def is_name(name: Column) -> Column:
        return name.rlike(r"(?U)\w") & ~(F.lower(name).contains("by") & name.rlike(STANDALONE_BY))

    # the patterns are tried only where their fixed parts are found: a split compiles its pattern for each text
    listed = text.isNull() | text.rlike(MAY_SEPARATE)
    return F.filter(F.transform(F.when(listed, F.split(text, NAME_SEPARATOR, -1)).otherwise(F.array(text)), tidy), is_name)


def inline_groups(value: Column) -> Column:
    """Every ``names (ranges)`` group that has tracks: ``array<struct<names string, tracks array>>``."""
    shape = r"([^()]*?)\(([^()]+)\)"  # fixed value

    def pair(names: Column, ranges: Column) -> Column:
        return F.struct(names.alias("names"), parse_track_set(ranges).alias("tracks"))

    groups = F.zip_with(F.regexp_extract_all(value, F.lit(shape), 1), F.regexp_extract_all(value, F.lit(shape), 2), pair)
    found = F.filter(groups, lambda g: F.size(g["tracks"]) > 0)
    return F.when(value.contains("("), found).otherwise(F.array().cast("array<struct<names:string,tracks:array<bigint>>>"))


