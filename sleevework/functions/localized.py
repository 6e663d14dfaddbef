"""Multi-language text as ``map<string,string>`` keyed by language label."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sleevework.functions.core import let
from sleevework.functions.text import has_cjk

# Language attribute -> label, and the default order of preference.
LANG_LABELS = {"en": "English", "ja": "Japanese", "ja-Latn": "Romaji"}
PREFERENCE = ("English", "Romaji")


def placeholder_rule(english: Column, japanese: Column, romaji: Column) -> Column:
    """Keep English if non-empty, Japanese only in real script, Romaji only if it adds something."""
    def kept(t: Column) -> Column:
        # insertion order is English, Japanese, Romaji
        return F.create_map(
            F.lit("English"), F.when(t["en"] != "", t["en"]),
            F.lit("Japanese"), F.when(has_cjk(t["ja"]), t["ja"]),
            F.lit("Romaji"), F.when((t["romaji"] != "") & (t["romaji"] != t["en"]), t["romaji"]),
        )

    # each text is worked out once, however often the rule looks at it
    texts = F.struct(F.coalesce(english, F.lit("")).alias("en"), japanese.alias("ja"), romaji.alias("romaji"))
    return F.map_filter(let(texts, kept), lambda _k, v: v.isNotNull())


def default_text(texts: Column) -> Column:
    """English, else Romaji, else the first entry, else NULL. A present empty text still wins."""
    return prefer(texts)


def prefer(texts: Column, *languages: str) -> Column:
    """First requested language that is present, else the default."""
    chosen = None
    for language in (*languages, *PREFERENCE):
        test = F.map_contains_key(texts, language)
        chosen = (F.when if chosen is None else chosen.when)(test, texts[language])
    return chosen.otherwise(F.get(F.map_values(texts), F.lit(0)))


def to_text(texts: Column) -> Column:
    return F.coalesce(default_text(texts), F.lit(""))
