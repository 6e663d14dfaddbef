"""Best-fit packing of tokenized documents into sequences, online, with a bounded number of open bins."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sleevework.llm.shared import saved
from sleevework.llm.tokens import after_blanks, token_pieces

OPEN_BINS = 64
TASK_SEQUENCES = 1500  # that a task fills, about


class OpenBins:
    """At most ``most`` open bins of ``size`` places each, in a bitset whose bits are amounts of free space.

    The bin of least sufficient space is the lowest bit at or above the length that is wanted, and the fullest
    bin the lowest bit of all, so both are found by a shift and a mask, however many bins are open.
    """

    def __init__(self, size: int, most: int) -> None:
        self.size, self.most = size, most
        self.bits, self.open, self.made = 0, 0, 0
        self.by_space: list[list[int]] = [[] for _ in range(size + 1)]

    def _take(self, space: int) -> int:
        bins = self.by_space[space]
        found = bins.pop()
        if not bins:
            self.bits ^= 1 << space
        self.open -= 1
        return found

    def _put(self, found: int, space: int) -> None:
        if space:
            self.by_space[space].append(found)
            self.bits |= 1 << space
            self.open += 1

    def place(self, length: int) -> tuple[int, int]:
        """(number of the bin that takes the item, its offset there)."""
        fits = self.bits >> length
        if fits:
            space = length + (fits & -fits).bit_length() - 1
            found = self._take(space)
        else:
            if self.open >= self.most and length < self.size:  # the fullest closes first
                self._take((self.bits & -self.bits).bit_length() - 1)
            space, found = self.size, self.made
            self.made += 1
        self._put(found, space - length)
        return found, self.size - space


def best_fit(docs: DataFrame, tokenizer_path: str, size: int = 4096, end: int = 1, open_bins: int = OPEN_BINS, id_col: str = "doc_id", text_col: str = "text", cuts=after_blanks) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, doc_tokens, sequence_id, offset), one row per piece of a document.

    A document is the ids of its whole text (null: empty) and the id ``end``. Only one of more than ``size`` ids is
    cut, into pieces of ``size`` ids and a last one that may be shorter. Null and repeated ids and repeated rows
    are documents of their own. An empty table gives no rows; other columns are not read.

    1. The texts are tokenized once, and the pieces, as numbers only, saved in the shared folder.
    2. They are dealt in turn, so that no key can gather in a task, to as many tasks as there are
       ``TASK_SEQUENCES`` sequences to fill. A task reads its pieces as they come and keeps only its open bins:
       each piece goes into the fullest open bin that has room for it; with ``open_bins`` of them open and none
       that has room, the fullest is closed and a new one opened. What a task leaves open at its end is less than
       ``open_bins`` bins. A sequence id carries the number of the task above bit 32.
    """
    pieces = saved(token_pieces(docs, tokenizer_path, cuts, size, end, id_col, text_col), "bestfit-pieces")
    total = pieces.agg(F.sum("length")).first()[0] or 0
    tasks = max(1, -(-int(total) // (size * TASK_SEQUENCES)))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, task = OpenBins(size, open_bins), TaskContext.get().partitionId() << 32
        for batch in batches:
            placed = np.array([bins.place(n) for n in batch.column("length").to_pylist()], np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(placed[:, 0] + task), pa.array(placed[:, 1])], [*batch.schema.names, "sequence_id", "offset"])

    numbered = pieces.select("doc_id", F.expr(f"cast(start div {size} as int)").alias("piece"), "start", "length", "ids_crc32", "doc_tokens")
    return numbered.repartition(tasks).mapInArrow(pack, "doc_id long, piece int, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
