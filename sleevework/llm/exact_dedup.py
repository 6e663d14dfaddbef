"""Exact deduplication: 128-bit content hash, best row by order, byte comparison inside the groups.

Built-in column functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sleevework.llm.shared import saved, text_of

#: The characters that two equal texts may differ in.
BLANKS = r"[\x20\x09-\x0D]+"


def normalised(column: str = "text") -> Column:
    return F.regexp_replace(text_of(column), BLANKS, "")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row per row of ``docs``.

    Texts are equal when they agree without blanks; a null text counts as empty, and all empty texts are one
    group. The row with the most code points in its original text stays, then the smallest id (null last). Rows
    that repeat both id and length of the row that stays are all marked kept. An empty table gives no rows;
    other columns are not read.

    Rows meet by the MD5 of the normalised text. Every member of a group of two or more is compared byte by byte
    with the text of the group's best row; members that differ (a collision) are grouped by the text itself.
    A group that holds a large share of the rows is reduced by partial aggregates. What these give is saved before
    rows meet it again, so both sides of a join are read from storage and a hot side of it can be split.
    """
    full = docs.select(F.col(id_col).alias("id"), F.char_length(text_of(text_col)).alias("n"), normalised(text_col).alias("bare"))
    full = full.select("id", "n", "bare", F.md5("bare").alias("h"), F.sha2("bare", 256).alias("sha"))
    best = F.min(F.struct((-F.col("n")).alias("n"), F.col("id").isNull().alias("void"), "id")).alias("best")
    narrow = saved(full.select("id", "n", "h", "sha"), "dedup-rows")
    groups = saved(narrow.groupBy("h").agg(F.count("*").alias("size"), best), "dedup-groups")

    several = groups.where("size > 1")
    members = saved(full.join(several.drop("size"), "h"), "dedup-members")
    is_best = F.col("id").eqNullSafe(F.col("best.id")) & (F.col("n") == -F.col("best.n"))
    models = saved(members.where(is_best).groupBy("h").agg(F.min("bare").alias("model")), "dedup-models")
    differs = F.when(F.col("bare") != F.col("model"), F.col("bare")).alias("variant")
    compared = saved(members.join(models, "h").select("h", "id", "n", "sha", differs), "dedup-compared")
    decided = saved(compared.groupBy("h", "variant").agg(F.count("*").alias("size"), best), "dedup-decided")

    decided = decided.withColumnsRenamed({"h": "h_", "variant": "variant_"})
    same = (F.col("h") == F.col("h_")) & F.col("variant").eqNullSafe(F.col("variant_"))
    singles = narrow.join(groups.where("size = 1").select("h", "size", "best"), "h")
    cols = ["id", "n", "sha", "size", "best"]
    rows = singles.select(cols).unionByName(compared.join(decided, same).select(cols))
    return rows.select(
        F.col("id").alias("doc_id"),
        F.col("best.id").alias("keep_id"),
        F.col("size").cast("long").alias("group_size"),
        is_best.alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; of rows that repeat id and text one stays."""
    kept = exact_groups(docs, id_col, text_col).where("kept").select(F.col("doc_id").alias("kept_id_"), F.col("text_sha256").alias("kept_print_")).distinct()
    print_of = "bare_sha256_" + "_" * max(len(c) for c in docs.columns)  # no column of the caller's
    marked = docs.withColumn(print_of, F.sha2(normalised(text_col), 256))
    stay = marked.join(kept, F.col(id_col).eqNullSafe(F.col("kept_id_")) & (F.col(print_of) == F.col("kept_print_")), "left_semi")
    return stay.dropDuplicates([id_col, print_of]).drop(print_of)
