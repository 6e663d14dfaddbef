"""Crawl bookkeeping: targets, what is left to fetch, and what the fetch log says."""

from __future__ import annotations

import math

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sleevework.functions.web import quote_plus
from sleevework.sources.manifest import SECTIONS

# Response outcomes.
OUTCOMES = ("ok", "not_found", "challenge", "rate_limited", "transient", "error")


def request_path(kind: Column, entry: Column, search: Column) -> Column:
    """``/album/271`` and the like; searches carry their encoded query."""
    return F.when(kind == "search", F.concat(F.lit("/search?q="), quote_plus(search))).otherwise(F.concat(F.lit("/"), kind, F.lit("/"), entry))


def build_targets(entries: DataFrame) -> DataFrame:
    """Manifest entries (section, id, slug, query) to crawl targets (key, path, out)."""
    kinds = F.create_map(*[F.lit(x) for pair in SECTIONS.items() for x in pair])
    kind = kinds[F.col("section")]
    entry = F.when(kind == "search", F.col("slug")).otherwise(F.col("id").cast("string"))
    rows = entries.where(F.col("section").isin(*SECTIONS))
    return rows.select(
        F.concat(kind, F.lit("/"), entry).alias("key"),
        request_path(kind, entry, F.col("query")).alias("path"),
        F.concat("section", F.lit("/"), entry, F.lit(".html")).alias("out"),
    )


def select_targets(targets: DataFrame, wanted: DataFrame) -> DataFrame:
    """The targets whose key is wanted."""
    return targets.join(wanted.select("key").distinct(), "key", "left_semi")


def unknown_targets(targets: DataFrame, wanted: DataFrame) -> DataFrame:
    """Wanted keys that are no target, sorted."""
    return wanted.select("key").distinct().join(targets.select("key").distinct(), "key", "left_anti").orderBy("key")


def skip_existing(targets: DataFrame, captured: DataFrame, *, overwrite: bool = False) -> DataFrame:
    """Targets still to fetch."""
    return targets if overwrite else targets.join(captured.select("key").distinct(), "key", "left_anti")


def capture_counts(targets: DataFrame, captured: DataFrame) -> DataFrame:
    """(captured, skipped, targets) of a run that fetches what is missing."""
    seen = captured.select("key").distinct().withColumn("seen", F.lit(True))
    marked = targets.join(seen, "key", "left")
    return marked.agg(
        F.count_if(F.col("seen").isNull()).alias("captured"), F.count_if("seen").alias("skipped"), F.count(F.lit(1)).alias("targets")
    )


def latest_pages(pages: DataFrame, key: str = "key", at: str = "captured_at") -> DataFrame:
    """The newest capture of each page; tasks drop older ones before the shuffle."""
    newest = Window.partitionBy(key).orderBy(F.desc(at), F.xxhash64("html"))
    return pages.withColumn("_n", F.row_number().over(newest)).where("_n = 1").drop("_n")


def _store(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def stored_pages(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest capture of every stored page; None while nothing is stored."""
    store = _store(spark, path)
    return None if store is None else latest_pages(store)


def stored_keys(spark: SparkSession, path: str) -> DataFrame | None:
    """The keys of the stored pages, without reading a body; None while nothing is stored."""
    store = _store(spark, path)
    return None if store is None else store.select("key")


def sink_pages(pages: DataFrame, path: str, *, overwrite: bool = False) -> None:
    """Add captured pages (key, kind, captured_at, html) to a store partitioned by kind.

    Bodies are kept byte for byte and files are only ever added, so a failed run leaves the store as
    it was. A page that is stored already is skipped, or with ``overwrite`` superseded by the newer
    capture when the store is read.
    """
    stored = None if overwrite else stored_keys(pages.sparkSession, path)
    rows = pages if stored is None else skip_existing(pages, stored)
    rows.write.partitionBy("kind").mode("append").parquet(path)


def retry_outcome(log: DataFrame, max_retries: int) -> DataFrame:
    """(request_id, outcome, attempts) from (request_id, attempt, outcome), attempts numbered from 1.

    Only transient failures are retried, at most ``max_retries`` times; the first other outcome is
    final. Attempt and outcome travel as one number, so the whole is a hash aggregate.
    """
    width = len(OUTCOMES) + 1
    code = F.array_position(F.array(*map(F.lit, OUTCOMES)), F.col("outcome"))
    final = F.when(F.col("outcome") != "transient", F.col("attempt") * width + code)
    made = log.where(F.col("attempt") <= max_retries + 1).groupBy("request_id").agg(F.min(final).alias("final"), F.max("attempt").alias("last"))
    outcome = F.coalesce(F.get(F.array(*map(F.lit, OUTCOMES)), (F.col("final") % width - 1).cast("int")), F.lit("transient"))
    attempts = F.coalesce(F.expr(f"final div {width}"), F.col("last").cast("bigint"))
    return made.select("request_id", outcome.alias("outcome"), attempts.alias("attempts"))


def throttle_wait(log: DataFrame, min_interval: float, tie: str = "event_id") -> DataFrame:
    """The log with ``wait``: seconds each request should have been held back for its host.

    Only a predecessor less than the interval away matters, so time is cut into slots of at least
    that length and a slot needs no more than the last request of the slot before. Partitions are
    (host, slot): a crawl of a single host is spread over its slots instead of sitting in one task.
    """
    if min_interval <= 0:
        return log.withColumn("wait", F.lit(0.0))
    slot_us = max(1, math.ceil(min_interval * 1_000_000))
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    rows = log.withColumns({"_us": us, "_slot": us - F.pmod(us, F.lit(slot_us))}).withColumn("_carry", F.lit(False))
    carried = rows.groupBy("host", "_slot").agg(F.max("_us").alias("_us")).select("host", "_us", (F.col("_slot") + slot_us).alias("_slot"), F.lit(True).alias("_carry"))
    both = rows.unionByName(carried, allowMissingColumns=True)
    before = F.lag("_us").over(Window.partitionBy("host", "_slot").orderBy("_us", F.desc("_carry"), tie))
    wait = F.greatest(F.lit(0.0), F.lit(float(min_interval)) - (F.col("_us") - before) / F.lit(1e6))
    waited = both.withColumn("wait", F.coalesce(F.round(wait, 6), F.lit(0.0))).where(~F.col("_carry"))
    return waited.drop("_us", "_slot", "_carry")


def captured_only(entries: DataFrame) -> DataFrame:
    return entries.where(F.col("status") == "captured")


def ordered_ids(entries: DataFrame, id_column: str = "id") -> DataFrame:
    """Sorted by the number an id spells, not by its text."""
    return entries.orderBy(F.col(id_column).cast("bigint"))
