"""Mixing sources to target weights: exact length counts, a subset-sum fit of the budget, seeded choice by length."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sleevework.llm.shared import WORD, ranked, saved, text_of

WEIGHTS = (5, 2, 1)  # by place of the source, repeating
SHARE = 1.5  # of all sizes, what the mix has in all
MOST = 2.0  # times its own size, what a source may give
#: Longest lengths that are left to the exact fit, and most words that it works on.
SPARE_LENGTHS = 2
EXACT_SPAN = 200_000


def fit_budget(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length to take so that their lengths add up to ``budget`` as closely as can be found.

    Every length gives its part of the budget, short of a few documents: the parts are rounded so that, from the
    shortest length on, the documents taken are never one off their exact number. A bounded-knapsack dynamic
    programme over the counts that remain then finds the largest reachable sum up to the rest. The sum never exceeds
    the budget. Only where single documents are longer than ``EXACT_SPAN`` words is the rest brought below it first.
    """
    take = np.zeros(len(lengths), np.int64)
    if budget <= 0 or not len(lengths):
        return take
    total = int((lengths * counts).sum())
    if budget >= total:
        return counts.astype(np.int64)
    order = np.argsort(-lengths)
    longest = int(lengths.max())
    share = max(0, budget - min(SPARE_LENGTHS * longest, EXACT_SPAN // 2)) / total
    exact = np.cumsum((counts * share)[order[::-1]])
    take[order[::-1]] = np.diff(np.floor(exact + 1e-9).astype(np.int64), prepend=0)
    take = np.minimum(take, counts)
    rest = budget - int((lengths * take).sum())
    for at in order[::-1]:  # a very long document may have been rounded up; the shortest that makes room goes
        if rest < 0 and take[at] and lengths[at] >= -rest:
            take[at] -= 1
            rest += int(lengths[at])
    for at in order:
        if rest <= EXACT_SPAN:
            break
        n = min(int(counts[at] - take[at]), (rest - EXACT_SPAN // 2) // int(lengths[at]))
        if n > 0:
            take[at] += n
            rest -= n * int(lengths[at])
    mixed_up = np.random.default_rng(len(order)).permutation(len(order))  # no length is preferred for the rest
    spare = [(int(lengths[at]), int(counts[at] - take[at]), int(at)) for at in mixed_up if 0 < lengths[at] <= rest and counts[at] > take[at]]
    reach, full = 1, (1 << (rest + 1)) - 1
    steps: list[tuple[int, int, int]] = []  # what was reachable before each chunk of copies of one length
    for length, n, at in spare:
        chunk = 1
        while n > 0:
            copies = min(chunk, n)
            if length * copies > rest:
                break
            steps.append((reach, copies, at))
            reach |= (reach << (length * copies)) & full
            n -= copies
            chunk *= 2
        if reach >> rest & 1:
            break
    here = (reach & full).bit_length() - 1
    for before, copies, at in reversed(steps):
        if not before >> here & 1:
            here -= copies * int(lengths[at])
            take[at] += copies
    return take


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, target) of (source, source_size): ``share`` of the whole by weight, capped and reshared.

    With the sources in the order of cap per unit of weight, the capped ones come first; the rest share what is
    left by weight. One row per source goes through the ordered window, not one per document.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (place % len(weights) + 1).cast("int"))
    known = sizes.withColumn("w", w).withColumn("cap", F.col("source_size") * most)
    order = Window.orderBy((F.col("cap") / F.col("w")).asc(), F.col("source").asc_nulls_last())
    upto, whole = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    budget = F.sum("source_size").over(whole) * share
    before = F.coalesce(F.sum("cap").over(upto), F.lit(0.0))
    left_w = F.sum("w").over(whole) - F.coalesce(F.sum("w").over(upto), F.lit(0.0))
    rate = (budget - before) / left_w  # what a unit of weight gets if all sources before this one are capped
    level = F.max("rate").over(whole)  # rates rise up to the first source that is not capped, then fall
    free = known.withColumn("rate", rate).withColumn("level", level)
    return free.withColumn("target", F.least(F.col("level") * F.col("w"), F.col("cap"))).select("source", "source_size", "target")


def mix(docs: DataFrame, seed: int = 7, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, repeats), one row per row of ``docs``.

    A document's size is its number of words (null: 0). A null source is a source of its own, the last. Each
    source takes every document as often as its target holds the source in full, and once more those whose
    lengths fit what remains, chosen within each length by a seeded hash of the id. Documents without words are
    repeated as often as the source in full. Reruns agree, except that rows which repeat id and size are
    interchangeable. An empty table gives no rows; extra columns are not read.

    A source meets in one task only as its counts by length, whose number is bounded by the longest document.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), F.regexp_count(text_of(text_col), F.lit(WORD)).cast("long").alias("size"))
    rows = saved(rows.withColumn("draw", F.xxhash64(F.lit(seed), "doc_id", "size")), "mix-rows")
    lengths = saved(rows.groupBy("source", "size").agg(F.count("*").alias("n")), "mix-lengths")
    targets = saved(source_targets(lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights, share, most), "mix-targets")

    def plan(rows: pd.DataFrame) -> pd.DataFrame:
        target, size = float(rows["target"].iloc[0]), int(rows["source_size"].iloc[0])
        rounds = int(target // size) if size else 1
        extra = fit_budget(rows["size"].to_numpy(np.int64), rows["n"].to_numpy(np.int64), int(round(target - rounds * size)) if size else 0)
        return pd.DataFrame({"source": rows["source"], "size": rows["size"], "rounds": rounds, "extra": extra, "source_size": size, "target": target})

    known = lengths.join(targets.withColumnRenamed("source", "source_"), F.col("source").eqNullSafe(F.col("source_"))).drop("source_")
    plans = known.groupBy("source").applyInPandas(plan, "source string, size long, rounds long, extra long, source_size long, target double")
    plans = plans.withColumnsRenamed({"source": "source_", "size": "size_"})
    placed = ranked(rows, ["source", "size"], ["draw", "doc_id"], "place")
    chosen = placed.join(plans, F.col("source").eqNullSafe(F.col("source_")) & (F.col("size") == F.col("size_"))).drop("source_", "size_")
    repeats = F.col("rounds") + (F.col("place") < F.col("extra")).cast("long")
    return chosen.select("doc_id", "source", "size", "source_size", "target", (F.col("size") * repeats).alias("taken"), repeats.alias("repeats"))


def mixed(docs: DataFrame, seed: int = 7, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The rows of ``docs``, all columns, each as often as ``mix`` takes it; rows that repeat an id share its repeats.

    Rows of one id, source and size are counted together, so that a repeated row is taken as often as planned.
    """
    taken = mix(docs, seed, id_col=id_col, text_col=text_col, source_col=source_col, **how)
    own = [F.col(id_col), F.col(source_col).cast("string"), F.regexp_count(text_of(text_col), F.lit(WORD)).cast("long")]
    plan = taken.groupBy(F.col("doc_id").alias("mix_id_"), F.col("source").alias("mix_source_"), F.col("size").alias("mix_size_")).agg(
        F.max("repeats").alias("mix_most_"), F.sum("repeats").alias("mix_sum_"), F.count("*").alias("mix_rows_")
    )
    same = [a.eqNullSafe(F.col(b)) for a, b in zip(own, ("mix_id_", "mix_source_", "mix_size_"))]
    met = docs.join(plan, same)
    times = F.when(F.col("mix_rows_") == 1, F.col("mix_most_")).otherwise(F.round(F.col("mix_sum_") / F.col("mix_rows_")).cast("long"))
    copies = met.where(times > 0).withColumn("mix_copy_", F.explode(F.sequence(F.lit(1).cast("long"), times)))
    return copies.select(*docs.columns)
