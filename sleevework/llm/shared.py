"""Helpers of the corpus operators: durable intermediate tables, gapless ranks and components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Words are runs of characters other than blank, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; only a local session without it gets a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and spark.sparkContext.master.startswith("local") and not spark.sparkContext.master.startswith("local-cluster"):
        folder = tempfile.mkdtemp(prefix="sleevework-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return folder


def saved(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read back: lineage ends here and lost executors cost nothing."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/sleevework/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_of(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def ranked(df: DataFrame, keys: list[str], order: list[str], name: str = "rank") -> DataFrame:
    """``df`` with the 0-based place of each row among the rows of its keys, in the order of the columns ``order``.

    The rows are range-partitioned by keys and order together, so that a key with any share of the rows spreads
    over many tasks; ranks within a part are shifted by the counts of the parts before it. Rows that agree in
    all the columns get places of their own in no particular order.
    """
    cols = [*keys, *order]
    parts = saved(df.repartitionByRange(*cols).withColumn("part_", F.spark_partition_id()), "ranges")
    counts = parts.groupBy(*keys, "part_").agg(F.count("*").alias("count_"))
    before = Window.partitionBy(*keys).orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select(*[F.col(k).alias(f"{k}_key_") for k in keys], F.col("part_").alias("part_key_"), F.coalesce(F.sum("count_").over(before), F.lit(0)).alias("shift_"))
    within = F.row_number().over(Window.partitionBy(*keys, "part_").orderBy(*order))
    own = parts.withColumn("within_", within - 1)
    same = [F.col(k).eqNullSafe(F.col(f"{k}_key_")) for k in keys]
    joined = own.join(shifts, [F.col("part_") == F.col("part_key_"), *same])
    return joined.select(*df.columns, (F.col("shift_") + F.col("within_")).cast("long").alias(name))


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, root): the smallest node that each end of an edge (a, b) reaches, by large-star and small-star steps.

    Every step moves each edge to a smaller end, until all edges lead to the root of their component; a hub with
    many edges is counted by partial minima before the shuffle, and its join can be split.
    """
    now = saved(edges.select("a", "b").where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(), label)
    seen = None
    while True:
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(now.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        small_least = large.groupBy(F.col("hi").alias("u")).agg(F.min("lo").alias("m"))
        linked = large.withColumnRenamed("hi", "u").join(small_least, "u")
        small = linked.select(F.explode(F.array(F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")), F.struct(F.col("u").alias("hi"), F.col("m").alias("lo")))).alias("e"))
        now = saved(small.select("e.*").where("hi <> lo").distinct(), label)
        state = now.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if state == seen:
            return now.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(now.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())
        seen = state
