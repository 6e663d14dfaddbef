"""Reading inputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def scan_pages(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, url, html) of captured pages kept as parquet."""
    return spark.read.parquet(path).select("page_id", "url", "html")


def page_key(name: Column) -> Column:
    """A stable 64-bit page id made of a name, the same wherever and whenever the name is read."""
    return F.xxhash64(F.lit("page"), name)


def scan_html_folder(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, url, html) of a folder of ``.html`` files, one whole document per row, as ``scan_pages`` gives them.

    The page id is a key of the file name without its ending; ``shared_keys`` finds files that share one.
    """
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.html").text(path, wholetext=True)
    name = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.html$", 1)
    return files.select(page_key(name).alias("page_id"), F.col("_metadata.file_path").alias("url"), F.col("value").alias("html"))


def shared_keys(pages: DataFrame) -> DataFrame:
    """(page_id, pages, first_url, last_url) of keys that several urls have: equal names in two folders, or a collision."""
    found = pages.groupBy("page_id").agg(F.count("*").alias("pages"), F.min("url").alias("first_url"), F.max("url").alias("last_url"))
    return found.where("first_url <> last_url")
