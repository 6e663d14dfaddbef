"""Page extraction on a stream of captured pages.

The page and value operators only look at single rows, so they run on a stream as they are and keep
no state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sleevework.functions.localized import default_text
from sleevework.functions.text import normalize_value
from sleevework.operators.pages import route_pages

PAGE_SCHEMA = "page_id bigint, url string, html string"


def page_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Pages of a folder of parquet files, new files as they arrive."""
    reader = spark.readStream.schema(PAGE_SCHEMA)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def routed_stream(pages: DataFrame) -> DataFrame:
    """(page_id, kind, entity_id, name, reason): kind, id and comparable name, or why it is a reject."""
    name = normalize_value(default_text(F.col("names")))
    return route_pages(pages).select("page_id", "kind", "entity_id", name.alias("name"), "reason")


def write_available(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append everything that is there now; a restart goes on where the last run stopped."""
    return rows.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
