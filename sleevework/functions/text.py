"""Whitespace, case and script helpers on string columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sleevework.functions.core import blank_to_null, let

# The characters counted as whitespace, and the line ends.
SPACE = "[\\s\\x1c-\\x1f\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]"
SPACE_CHARS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
LINE_END = "\\r\\n|[\\n\\r\\x0b\\x0c\\x1c\\x1d\\x1e\\x85\\u2028\\u2029]"

OTHER_LINE_END = "[\\r\\x0b\\x0c\\x1c\\x1d\\x1e\\x85\\u2028\\u2029]"  # all but the line feed
COLLAPSED = r"\A[!-~]++(?: [!-~]++)*+\z"  # plain words with single spaces between them

# Japanese/CJK script for page text (with full-width forms) and for notes (without).
PAGE_CJK = "[\\u3040-\\u30ff\\u3400-\\u4dbf\\u4e00-\\u9fff\\uff00-\\uffef]"
NOTES_CJK = "[\\u3040-\\u30ff\\u3400-\\u4dbf\\u4e00-\\u9fff]"


def strip(value: Column) -> Column:
    return F.btrim(value, F.lit(SPACE_CHARS))


def is_blank(value: Column) -> Column:
    return ~value.rlike("[^" + SPACE[1:])


def collapse(value: Column) -> Column:
    """Runs of whitespace become one space; none at either end."""
    # single spaces are left alone, so ordinary prose is scanned without being rewritten
    collapsed = lambda v: F.trim(F.regexp_replace(v, f" {SPACE}+|[{SPACE}&&[^ ]]{SPACE}*", " "))
    return let(value, lambda v: F.when(v.rlike(COLLAPSED), v).otherwise(collapsed(v)))


def _foldings() -> tuple[str, str, dict[str, str]]:
    """(characters that fold to one other, those others in the same order, characters that fold to several)."""
    folded = [(c, c.casefold()) for c in map(chr, range(0x20000)) if c.casefold() != c]
    single = [(c, f) for c, f in folded if len(f) == 1]
    return "".join(c for c, _ in single), "".join(f for _, f in single), {c: f for c, f in folded if len(f) > 1}


_SINGLE, _FOLDED, _SEVERAL = _foldings()
_SEVERAL_CLASS = "[" + "".join(f"\\u{ord(c):04x}" for c in _SEVERAL) + "]"


def casefold(value: Column) -> Column:
    """The full case folding of Unicode: one look at each character, and a second only where one becomes several.

    ASCII text, told by its number of bytes, is lower-cased.
    """

    def fold(text: Column) -> Column:
        def expand(single: Column) -> Column:
            several = F.expr("map(" + ", ".join(f"'{c}', '{f}'" for c, f in _SEVERAL.items()) + ")")
            pieces = F.split(single, f"(?<={_SEVERAL_CLASS})|(?={_SEVERAL_CLASS})", -1)
            whole = F.array_join(F.transform(pieces, lambda p: F.coalesce(several[p], p)), "")
            return F.when(single.rlike(_SEVERAL_CLASS), whole).otherwise(single)

        return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(let(F.translate(text, _SINGLE, _FOLDED), expand))

    return let(value, fold)


def normalize_value(value: Column) -> Column:
    """Comparison form of a field: collapsed, casefolded, blank as NULL."""
    return blank_to_null(casefold(collapse(value)))


def has_cjk(value: Column) -> Column:
    return value.rlike(PAGE_CJK)


def name_key(value: Column) -> Column:
    """Language label for a name found on a page."""
    return F.when(has_cjk(value), F.lit("Japanese")).otherwise(F.lit("English"))


def notes_name_key(value: Column) -> Column:
    """Language label for a name found in freeform notes (narrower script class)."""
    return F.when(value.rlike(NOTES_CJK), F.lit("Japanese")).otherwise(F.lit("English"))


def lines(value: Column) -> Column:
    """Split text into lines; a final line end does not open an empty line."""
    # a text of line feeds alone, as most are, is split at that one character, without a pattern
    parts = F.when(value.rlike(OTHER_LINE_END), F.split(value, LINE_END, -1)).otherwise(F.split(value, "\n", -1))
    ends_open = F.substring(value, -1, 1).rlike(LINE_END) | (value == "")
    return let(F.struct(parts.alias("parts"), ends_open.alias("ends_open")), lambda x: F.when(x["ends_open"], F.slice(x["parts"], F.lit(1), F.size(x["parts"]) - 1)).otherwise(x["parts"]))


def percent(part: Column, whole: Column) -> Column:
    """Whole percent as text, ties to even; ``n/a`` when nothing was counted."""
    ratio = F.lit(100.0) * part / F.nullif(whole.cast("double"), F.lit(0.0))
    return F.when(whole == 0, F.lit("n/a")).otherwise(F.concat(F.bround(ratio, 0).cast("bigint").cast("string"), F.lit("%")))
