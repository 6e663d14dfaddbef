"""Exact top-k search by inner product: global score histograms narrow in on every k-th score."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sleevework.llm.shared import saved

BINS = 1024  # of a histogram; every round divides the width of a query's score range by this
QUERY_BLOCK = 2048
ROW_BLOCK = 8192
LONG_MAX = 2**63 - 1


def integer_vector(column: str, scale: int = 256) -> Column:
    """floor(scale * x) of every component as double; NULL for a vector with a null or non-finite component."""
    x = F.col(column)
    whole = F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("double"))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v.cast("double")) == float("inf")))
    return F.when(x.isNotNull() & ~bad, whole)


def _scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Integer inner products; by floating point where every partial sum is exact, else by whole numbers."""
    if not queries.shape[1]:
        return np.zeros((len(queries), len(rows)), np.int64)
    bound = float(np.abs(queries).max()) * float(np.abs(rows).max()) * queries.shape[1]
    if bound < 2**53:
        return (queries @ rows.T).astype(np.int64)
    exact = queries.astype(object) @ rows.astype(object).T
    return np.array([[int(max(-LONG_MAX, min(LONG_MAX, int(v)))) for v in line] for line in exact], np.int64).reshape(exact.shape)


def _matrix(table: pa.Table) -> np.ndarray:
    flat = table["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(table.num_rows, len(flat) // max(1, table.num_rows))


def top_k(vectors: DataFrame, queries: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that ``queries`` selects, its ``k`` rows of highest score.

    A score is the inner product of the vectors turned into integers. Ties go to the smaller id; a query's own id
    is no candidate; with fewer than ``k`` candidates all are returned. Rows with a null id, or whose vector is
    null or holds a null or non-finite component, take no part; a query meets the vectors of its own length only;
    rows that repeat an id and vector count once, an id with several vectors stands for each of them. Scores
    beyond a long are held at its ends. An empty table gives no rows; extra columns are not read.

    Queries and rows meet as a grid of blocks of bounded size. A first pass over the grid finds every query's
    score range; rounds of histograms then locate the bin of its k-th score until a bin is one score wide; the
    last pass keeps the scores that reach it. Blocks send at most the bins down to their own k-th score, below
    which the global one cannot lie.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), integer_vector(vector_col).alias("v")).where("id is not null and v is not null")
    wanted = vectors.select(F.col(id_col).cast("long").alias("id"), queries.alias("wanted")).where("wanted and id is not null").select("id").distinct()
    rows = saved(rows.distinct().withColumn("dim", F.size("v")), "topk-rows")
    asked = saved(rows.join(wanted, "id"), "topk-queries")
    n_rows, n_asked = rows.count(), asked.count()
    row_blocks, query_blocks = max(1, -(-n_rows // ROW_BLOCK)), max(1, -(-n_asked // QUERY_BLOCK))

    def block(blocks: int) -> Column:
        return F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")

    every_row = F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1)))
    every_query = F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))
    grid_rows = rows.select("id", "v", "dim", block(row_blocks).alias("r"), every_query.alias("q")).groupBy("dim", "r", "q")

    def grid(state: DataFrame, scan, schema: str) -> DataFrame:
        """``scan(ids, state columns, scores, own)`` over every block pair; ``state`` has a row per query vector."""
        sides = state.select("*", block(query_blocks).alias("q"), every_row.alias("r")).groupBy("dim", "r", "q")
        names = [c for c in state.columns if c not in ("id", "v", "dim")]

        def meet(left: pa.Table, right: pa.Table) -> pa.Table:
            out_schema = pa.schema([(n, pa.int64()) for n in [f.split()[0] for f in schema.split(", ")]])
            if not left.num_rows or not right.num_rows:
                return out_schema.empty_table()
            ids, row_ids = left["id"].to_numpy(), right["id"].to_numpy()
            scores = _scores(_matrix(left), _matrix(right))
            cols = scan(ids, {n: left[n].to_numpy() for n in names}, scores, ids[:, None] == row_ids[None, :], row_ids)
            return pa.table([pa.array(c, pa.int64()) for c in cols], schema=out_schema)

        return sides.cogroup(grid_rows).applyInArrow(meet, schema)

    def extent(ids, state, scores, own, row_ids):
        some = ~own.all(axis=1)
        top = np.where(own, -LONG_MAX, scores).max(axis=1)[some]
        low = np.where(own, LONG_MAX, scores).min(axis=1)[some]
        return ids[some], low, top, (~own).sum(axis=1)[some]

    # An id with several vectors asks with each of them; their candidates are ranked together.
    ranges = grid(asked, extent, "id long, low long, top long, n long").groupBy("id").agg(F.min("low").alias("low"), F.max("top").alias("top"), F.sum("n").alias("n"))
    ranges = ranges.withColumn("need", F.least(F.col("n"), F.lit(k)))

    def histogram(ids, state, scores, own, row_ids):
        out = [[], [], []]
        for at in range(len(ids)):
            low, high, width, need, above = (int(state[c][at]) for c in ("low", "high", "width", "need", "above"))
            line = scores[at][~own[at] & (scores[at] >= low) & (scores[at] <= high)]
            bins = (line.astype(np.uint64) - np.uint64(low & (1 << 64) - 1)) // np.uint64(width)  # a span may exceed a signed long
            counts = np.bincount(bins.astype(np.int64), minlength=BINS)
            reach = np.cumsum(counts[::-1])[::-1]  # scores in this bin and above
            bins = np.flatnonzero((counts > 0) & (reach - counts < need - above))
            out[0] += [int(ids[at])] * len(bins)
            out[1] += bins.tolist()
            out[2] += counts[bins].tolist()
        return out

    # State of a query: the k-th score lies in low to high, in bins of ``width``; ``above`` scores are higher. A width of 0: low is it.
    state = saved(ranges.withColumn("width", F.expr(f"cast((cast(top as decimal(38,0)) - low) div {BINS} + 1 as long)")).withColumn("above", F.lit(0).cast("long")), "topk-state").select("id", "low", F.col("top").alias("high"), "width", "need", "above")
    while state.where("width > 0").limit(1).count():
        counted = grid(asked.join(state.where("width > 0"), "id"), histogram, "id long, bin long, n long").groupBy("id", "bin").agg(F.sum("n").alias("n"))
        upto = F.sum("n").over(Window.partitionBy("id").orderBy(F.col("bin").desc()))
        located = counted.withColumn("upto", upto).join(state, "id").where("above + upto >= need and above + upto - n < need")
        low, high, inner = "cast(low + cast(bin as decimal(20,0)) * width as long)", "cast(least(high, low + (cast(bin as decimal(20,0)) + 1) * width - 1) as long)", f"case when width = 1 then 0 else (width - 1) div {BINS} + 1 end"
        finer = located.select("id", F.expr(low).alias("low"), F.expr(high).alias("high"), F.expr(inner).alias("width"), "need", F.expr("above + upto - n").alias("above"))
        state = saved(finer.unionByName(state.where("width = 0")), "topk-state")

    def reached(ids, state, scores, own, row_ids):
        at, to = np.nonzero((scores >= state["low"][:, None]) & ~own)
        order = np.lexsort((row_ids[to], -scores[at, to], at))
        at, to = at[order], to[order]
        first = np.searchsorted(at, at)  # of ties, a block sends no more than could be returned
        best = np.arange(len(at)) - first < k
        at, to = at[best], to[best]
        return ids[at], row_ids[to], scores[at, to]

    found = grid(asked.join(state.select("id", "low"), "id"), reached, "id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select(F.col("id").alias("query_id"), "rank", "vec_id", "score")
