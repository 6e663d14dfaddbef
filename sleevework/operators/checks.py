"""Dataset integrity: every check returns the offending rows, so an empty result means sound."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def min_rows(entries: DataFrame, floors: Mapping[str, int], section: str = "section") -> DataFrame:
    """(section, n, floor) of sections with too few rows, also of those without any."""
    pairs = [F.struct(F.lit(name).alias(section), F.lit(floor).cast("bigint").alias("floor")) for name, floor in floors.items()]
    wanted = entries.sparkSession.range(1).select(F.inline(F.array(*pairs)))
    # both sides hold one row per section at this point
    counts = entries.groupBy(section).agg(F.count(F.lit(1)).alias("n"))
    joined = wanted.join(counts, section, "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return joined.where(F.col("n") < F.col("floor")).select(section, "n", "floor")


def well_formed(entries: DataFrame, required: Sequence[str], rules: Mapping[str, Column]) -> DataFrame:
    """Entries with ``problems``: required columns that are NULL or blank and rules that fail."""
    found = [F.when(F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == "", F.lit(f"no {c}")) for c in required]
    found += [F.when(~F.coalesce(test, F.lit(False)), F.lit(name)) for name, test in rules.items()]
    problems = F.array_join(F.array_compact(F.array(*found)), ", ")
    return entries.withColumn("problems", problems).where("problems <> ''")


def unique_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys..., n) of keys that occur more than once."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def orphans(stored: Sequence[DataFrame], listed: DataFrame, key: str = "key") -> DataFrame:
    """Keys stored by any of the sides but not listed."""
    sides = stored[0].select(key)
    for more in stored[1:]:
        sides = sides.unionByName(more.select(key))
    return sides.distinct().join(listed.select(key).distinct(), key, "left_anti")


def completeness(listed: DataFrame, stored: DataFrame, size: Column, key: str = "key") -> DataFrame:
    """(key, problem) of listed keys stored nowhere or only as empty bodies."""
    best = stored.groupBy(key).agg(F.max(F.coalesce(size, F.lit(0))).alias("size"))
    joined = listed.select(key).distinct().join(best, key, "left")
    problem = F.when(F.col("size").isNull(), "missing").when(F.col("size") <= 0, "empty")
    return joined.select(key, problem.alias("problem")).where("problem is not null")


def set_difference(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys..., side) of keys that only one side has; empty when the key sets are equal."""
    both = left.select(*keys, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(right.select(*keys, F.lit(0).alias("l"), F.lit(1).alias("r")))
    seen = both.groupBy(*keys).agg(F.max("l").alias("l"), F.max("r").alias("r")).where("l <> r")
    return seen.select(*keys, F.when(F.col("l") == 1, "left").otherwise("right").alias("side"))


def foreign_key(rows: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys..., n) of keys used in ``rows`` that ``known`` does not have, and how often.

    Uses are counted before the join, so a key used by a third of all rows is a single row there.
    """
    used = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return used.join(known.select(*keys).distinct(), list(keys), "left_anti")
