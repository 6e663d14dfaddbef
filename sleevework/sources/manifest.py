"""The crawl manifest: a JSON document that lists what to capture, section by section."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_ENTRY = (
    "array<struct<id:bigint,slug:string,kind:string,query:string,source_url:string,captured_date:string,status:string,"
    "diversity:array<string>,golden_scope:string,golden_note:string>>"
)
# Sections in their order, with the page kind each one lists.
SECTIONS = {"albums": "album", "search": "search", "artists": "artist", "products": "product", "organizations": "org", "events": "event"}
SCHEMA = "source string, purpose string, note string, " + ", ".join(f"{s} {_ENTRY}" for s in SECTIONS)


def manifest_entries(texts: DataFrame, value: str = "value") -> DataFrame:
    """(section, id, slug, kind, query, source_url, captured_date, status, diversity), one row per entry."""
    def labelled(section: str) -> Column:
        entries = F.coalesce(F.col(f"m.{section}"), F.array())
        return F.transform(entries, lambda e: F.struct(F.lit(section).alias("section"), e.alias("e")))

    doc = texts.select(F.from_json(value, SCHEMA, {"mode": "FAILFAST"}).alias("m"))  # a broken manifest is no empty crawl
    rows = doc.select(F.explode(F.concat(*map(labelled, SECTIONS))).alias("r"))
    return rows.select("r.section", *[f"r.e.{c}" for c in ("id", "slug", "kind", "query", "source_url", "captured_date", "status", "diversity")])


def scan_manifest(spark: SparkSession, path: str) -> DataFrame:
    return manifest_entries(spark.read.text(path, wholetext=True))
