"""Tolerant reading of third-party JSON held as VARIANT: a wrong type is NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sleevework.functions.text import strip

# Fixed value: languages tried, in order, when a name is a language mapping.
NAME_LANGUAGES = ("English", "Romaji", "en", "ja-latn", "ja")


def is_kind(value: Column, kind: str) -> Column:
    """True when the VARIANT is a ``STRING``, ``ARRAY`` or ``OBJECT``; false for NULL."""
    return F.coalesce(F.schema_of_variant(value).startswith(kind), F.lit(False))


def as_text(value: Column) -> Column:
    """A non-blank JSON string, else NULL. Numbers and booleans are not text."""
    text = F.when(is_kind(value, "STRING"), F.try_variant_get(value, "$", "string"))
    return F.when(strip(text) != "", text)


def name_text(value: Column) -> Column:
    """A name given as a string or as a language mapping."""
    mapping = F.when(is_kind(value, "OBJECT"), F.try_variant_get(value, "$", "map<string,variant>"))
    preferred = [as_text(mapping[language]) for language in NAME_LANGUAGES]
    any_text = F.get(F.filter(F.transform(F.map_values(mapping), as_text), lambda t: t.isNotNull()), F.lit(0))
    return F.coalesce(as_text(value), *preferred, any_text)


def content_text(value: Column) -> Column:
    """Chat content: a string as it is, a list as its ``text`` parts joined, anything else empty."""
    parts = F.when(is_kind(value, "ARRAY"), F.try_variant_get(value, "$", "array<variant>"))
    texts = F.transform(parts, lambda p: F.try_variant_get(p, "$.text", "string"))
    return F.coalesce(
        F.when(is_kind(value, "STRING"), F.try_variant_get(value, "$", "string")),
        F.array_join(F.filter(texts, lambda t: t.isNotNull()), ""),
        F.lit(""),
    )
