"""Controlled credit-role vocabulary."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sleevework.functions.core import let
from sleevework.functions.text import casefold, strip

# A label that must be equal, then substrings in order of precedence.
EXACT_ROLES = {"music": "composer"}
ROLE_KEYWORDS = {
    "coordinator": "other",
    "manager": "other",
    "supervisor": "other",
    "production assistant": "other",
    "compos": "composer",
    "orchestrat": "arranger",
    "arrang": "arranger",
    "lyric": "lyricist",
    "words": "lyricist",
    "written by": "lyricist",
    "mastering": "mastering",
    "mastered": "mastering",
    "mixing": "mixing",
    "mixed": "mixing",
    "produc": "producer",
    "recording": "engineer",
    "recorded": "engineer",
    "engineer": "engineer",
    "pro tools": "engineer",
    "conduct": "conductor",
    "illustrat": "artwork",
    "jacket": "artwork",
    "art direction": "artwork",
    "artwork": "artwork",
    "direct": "director",
    "vocal": "vocalist",
    "chorus": "vocalist",
    "guitar": "performer",
    "bass": "performer",
    "violin": "performer",
    "viola": "performer",
    "cello": "performer",
    "piano": "performer",
    "keyboard": "performer",
    "drum": "performer",
    "percussion": "performer",
    "flute": "performer",
    "shakuhachi": "performer",
    "shinobue": "performer",
    "bouzouki": "performer",
    "synthesizer": "performer",
    "perform": "performer",
}
FALLBACK_ROLE = "other"
ROLES = (
    "composer", "arranger", "performer", "vocalist", "lyricist", "producer", "engineer",
    "mixing", "mastering", "director", "conductor", "artwork", "other",
)
# Substrings that mark a notes line as a credit.
LINE_KEYWORDS = (
    "compos", "arrang", "perform", "vocal", "lyric", "words", "music", "written", "sound", "mix",
    "master", "produc", "conduct", "guitar", "piano", "bass", "drum", "program",
)


def _role_of(folded: Column) -> Column:
    tests = [(folded == text, role) for text, role in EXACT_ROLES.items()]
    tests += [(folded.contains(word), role) for word, role in ROLE_KEYWORDS.items()]
    chain = reduce(lambda c, t: c.when(t[0], F.lit(t[1])), tests[1:], F.when(tests[0][0], F.lit(tests[0][1])))
    return chain.otherwise(F.lit(FALLBACK_ROLE))


def normalize_role(label: Column) -> Column:
    """The role of a freeform label: the equal label, else the first keyword it contains."""
    return _role_of(strip(casefold(label)))


def normalize_role_once(label: Column) -> Column:
    """The same for use inside array lambdas, as a search through a constant list of rules."""
    rules = F.expr("array(" + ", ".join(f"struct('{w}' as word, '{r}' as role)" for w, r in ROLE_KEYWORDS.items()) + ")")
    exact = F.expr("map(" + ", ".join(f"'{t}', '{r}'" for t, r in EXACT_ROLES.items()) + ")")

    def find(folded: Column) -> Column:
        hit = F.get(F.filter(rules, lambda rule: folded.contains(rule["word"])), F.lit(0))["role"]
        return F.coalesce(exact[folded], hit, F.lit(FALLBACK_ROLE))

    return let(strip(casefold(label)), find)


def role_rules(spark: SparkSession) -> DataFrame:
    """The keywords as a table: a fixed 43-row dimension, safe to broadcast."""
    rows = [(0, text, True, role) for text, role in EXACT_ROLES.items()]
    rows += [(i, word, False, role) for i, (word, role) in enumerate(ROLE_KEYWORDS.items(), 1)]
    values = ", ".join(f"({p}, '{w}', {str(e).lower()}, '{r}')" for p, w, e, r in rows)
    return spark.sql(f"select * from values {values} as rules(priority, keyword, exact, role)")


def normalize_role_by_table(labels: DataFrame, label: str, rules: DataFrame) -> DataFrame:
    """The same mapping driven by a rule table, for vocabularies kept as data.

    Works on distinct labels, so the substring join never sees a repeated label. A null label gets the fallback
    role. The optimizer decides by the size of ``rules`` whether to broadcast it.
    """
    distinct = labels.select(label).distinct().withColumn("_folded", strip(casefold(F.col(label))))
    hit = F.when(F.col("exact"), F.col("_folded") == F.col("keyword")).otherwise(F.col("_folded").contains(F.col("keyword")))
    best = F.min_by("role", "priority")
    mapped = distinct.join(rules, hit, "left").groupBy(label).agg(F.coalesce(best, F.lit(FALLBACK_ROLE)).alias("role"))
    return labels.join(mapped, label, "left").withColumn("role", F.coalesce("role", F.lit(FALLBACK_ROLE)))


def has_role_keyword(phrase: Column) -> Column:
    return casefold(phrase).rlike("|".join(LINE_KEYWORDS))
