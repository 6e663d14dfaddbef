"""Packing tokenized documents into sequences: length combinations by non-negative least squares."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sleevework.llm.shared import ranked, saved
from sleevework.llm.tokens import before_plain_words, token_pieces

END = 0  # the id after each document


def combinations(size: int) -> np.ndarray:
    """The pairs and triples of lengths that fill a window of ``size`` exactly, as columns of places (0: none)."""
    a = np.arange(1, size // 2 + 1)
    pairs = np.stack([a, size - a, np.zeros_like(a)], 1)
    a, b = np.meshgrid(np.arange(1, size // 3 + 1), np.arange(1, size // 2 + 1), indexing="ij")
    a, b = a.ravel(), b.ravel()
    c = size - a - b
    ok = (a <= b) & (b <= c)
    return np.concatenate([pairs, np.stack([a[ok], b[ok], c[ok]], 1)])


def fill_counts(histogram: np.ndarray, combos: np.ndarray, rounds: int = 200) -> np.ndarray:
    """Non-negative repeat counts of the combinations whose lengths come closest to the histogram in squares.

    Multiplicative steps keep every count at or above zero and lower the squared distance each time.
    """
    used = (combos > 0).sum(1)
    goal = histogram.astype(float)
    goal[0] = 0
    wanted = goal[combos].sum(1)
    counts = np.where((goal[combos] > 0).sum(1) == used, np.minimum.reduce([np.where(combos[:, i] > 0, goal[combos[:, i]], np.inf) for i in range(combos.shape[1])]), 0.0)
    for _ in range(rounds):
        made = np.zeros(len(histogram))
        for i in range(combos.shape[1]):
            made += np.bincount(combos[:, i], counts, len(histogram))
        made[0] = 0
        counts *= wanted / np.maximum(made[combos].sum(1), 1e-9)
    return counts


def plan_windows(histogram: np.ndarray, size: int) -> list[tuple[tuple[int, ...], int]]:
    """[(lengths of a window, how many windows)], using up the histogram of lengths 1 to ``size`` - 1.

    Least-squares counts rounded down, then single windows by the fractions left, then what remains greedily:
    the longest length, topped up by the longest that fit, as often as the counts allow.
    """
    left = histogram.astype(np.int64).copy()
    combos = combinations(size)
    combos = combos[((left[combos] > 0) | (combos == 0)).all(1)]
    plan: list[tuple[tuple[int, ...], int]] = []

    def use(lengths: tuple[int, ...], most: int) -> None:
        kinds = {x: lengths.count(x) for x in lengths}
        n = min([most, *(int(left[x]) // k for x, k in kinds.items())])
        if n > 0:
            plan.append((lengths, n))
            for x, k in kinds.items():
                left[x] -= n * k

    if len(combos):
        counts = fill_counts(left, combos)
        whole, part = np.floor(counts).astype(np.int64), counts - np.floor(counts)
        for at in np.argsort(-counts, kind="stable"):
            if whole[at] < 1:
                break
            use(tuple(int(x) for x in combos[at] if x), int(whole[at]))
        for at in np.argsort(-part, kind="stable"):
            use(tuple(int(x) for x in combos[at] if x), 1)
    while left.any():
        lengths, room, spare = [], size, left.copy()
        while True:
            fits = np.flatnonzero(spare[: room + 1])
            if not len(fits):
                break
            lengths.append(int(fits[-1]))
            spare[fits[-1]] -= 1
            room -= int(fits[-1])
        use(tuple(lengths), 1 << 62)
    return plan


def pack(docs: DataFrame, tokenizer_path: str, size: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset), one row per piece of a document.

    A document is the ids of its whole text (null: empty) and one id that ends it. Every ``size`` ids from its
    start are a sequence of their own; what is left over is packed with the left-overs of other documents, by
    combinations that fill a window exactly as far as the lengths allow. Null and repeated ids and repeated rows
    are documents of their own. An empty table gives no rows; other columns are not read.

    Only the counts by length, of which there are fewer than ``size``, reach the driver, and only the plan made of
    them, bounded by the number of combinations of lengths, is sent out.
    """
    spark = docs.sparkSession
    pieces = saved(token_pieces(docs, tokenizer_path, before_plain_words, size, END, id_col, text_col), "pack-pieces")
    histogram = np.zeros(size + 1, np.int64)
    for row in pieces.where(F.col("length") < size).groupBy("length").agg(F.count("*").alias("n")).collect():
        histogram[row["length"]] = row["n"]
    plan = plan_windows(histogram, size)

    runs: dict[int, list[tuple[int, int, int]]] = {}  # by length: places taken so far, first sequence, offset
    sequences = 0
    for lengths, n in plan:
        offset = 0
        for length in lengths:
            mine = runs.setdefault(length, [])
            mine.append((n + (mine[-1][0] if mine else 0), sequences, offset))
            offset += length
        sequences += n
    table = spark.sparkContext.broadcast({k: np.array(v, np.int64) for k, v in runs.items()})

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("place").to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for kind in np.unique(length):
                mine, run = length == kind, table.value[int(kind)]
                at = np.searchsorted(run[:, 0], rank[mine], "right")
                before = np.where(at > 0, run[at - 1, 0], 0)
                sequence[mine] = run[at, 1] + rank[mine] - before
                offset[mine] = run[at, 2]
            names = [n for n in batch.schema.names if n != "place"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    cols = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    order = ["doc_id", "start", "doc_tokens", "ids_crc32"]
    tails = ranked(pieces.where(F.col("length") < size), ["length"], order, "place")
    packed = tails.mapInArrow(place, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
    whole = ranked(pieces.where(F.col("length") == size), [], order, "place")
    return packed.unionByName(whole.select(*cols, (F.col("place") + sequences).alias("sequence_id"), F.lit(0).cast("long").alias("offset")))
