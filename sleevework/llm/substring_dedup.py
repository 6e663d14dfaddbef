"""Substring deduplication: a count-min sketch finds windows that may repeat, exact grouping decides them."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sleevework.llm.buckets import bucketed, from_gaps, gaps, ids_in_order, unpack
from sleevework.llm.wordcodes import Words, find_words, pieces_coded, run_codes, starts_inside

BUCKET_BYTES = 8 << 20
PART_CELLS = 1 << 24  # cells of the sketch that one part merges
CELLS_PER_WINDOW = 4  # width of a sketch row for each window of the input
DEPTH = 2  # rows of the sketch
BYTES_PER_WORD = 5


class _Bucket:
    """The windows of a bucket: codes of 128 bits, and for each the document and the word it starts with."""

    def __init__(self, table: pa.Table, window: int) -> None:
        self.table, self.ids = ids_in_order(table)
        self.words: Words = find_words(self.table["text"])
        w, first = self.words, self.words.first
        one, two = pieces_coded(w.data, w.starts, w.ends, (1, 2))
        self.at = np.flatnonzero(starts_inside(first, window))  # number of the first word, over the whole bucket
        self.one, self.two = run_codes(one, window, 1)[self.at], run_codes(two, window, 2)[self.at]
        # Rows that share an id count their words on, so that (id, start) names one window.
        begins = np.flatnonzero(np.concatenate([[True], self.ids[1:] != self.ids[:-1]])) if len(self.ids) else np.zeros(0, np.int64)
        origin = np.repeat(first[begins], np.diff(np.append(begins, len(self.ids)))) if len(begins) else np.zeros(0, np.int64)
        doc = np.searchsorted(first, self.at, "right") - 1
        self.doc, self.start = self.ids[doc] if len(doc) else np.zeros(0, np.int64), self.at - (origin[doc] if len(doc) else 0)

    def earlier_here(self) -> np.ndarray:
        """Whether the same window starts earlier in this bucket; the windows are in order of document and start."""
        order = np.lexsort((self.two, self.one))  # stable: equal windows stay in order
        same = (self.one[order][1:] == self.one[order][:-1]) & (self.two[order][1:] == self.two[order][:-1])
        out = np.zeros(len(order), bool)
        out[order[1:][same]] = True
        return out


def _cells(one: np.ndarray, two: np.ndarray, row: int, parts: int) -> np.ndarray:
    return (one + np.uint64(row) * (two | np.uint64(1))) % np.uint64(parts * PART_CELLS)


def repeated_words(docs: DataFrame, window: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text, kept_sha256), one row per row of ``docs``.

    A word goes if a window of ``window`` consecutive words of its document covers it whose word sequence also
    starts earlier: in a document of smaller id, or further up in the same one. All windows are judged on the
    input. Words are runs of non-blank characters, unchanged; what stays is joined by single blanks. A null text
    has no words; documents shorter than a window lose nothing. A null id sorts first; rows that share an id are
    parts of one document in the order of their texts, and windows do not reach from one into the next. An empty
    table gives no rows; other columns are not read.

    Pass 1: every bucket sends the cells of its windows, ``DEPTH`` rows of a sketch whose width grows with the
    input; the parts add up all buckets and answer with the cells that hold two or more. The merged counts are
    never below the true ones, so every repeated window is among those the answers name. Pass 2: the windows
    whose cells all hold two or more go out by their 128-bit codes, each once per bucket, and meet exactly; the
    answers name the windows that are not first.
    """
    rows, total = bucketed(docs, BUCKET_BYTES, id_col, text_col)
    parts = max(1, -(-total * CELLS_PER_WINDOW // (BYTES_PER_WORD * PART_CELLS)))
    answer_parts = max(1, total // (BYTES_PER_WORD << 20))

    def send_cells(table: pa.Table) -> pa.Table:
        own, out = _Bucket(table, window), []
        bucket = table["bucket"][0].as_py()
        for row in range(DEPTH):
            cells = np.sort(_cells(own.one, own.two, row, parts))
            twice = np.concatenate([[False, False], cells[2:] == cells[:-2]])[: len(cells)]  # two of a kind are enough
            cells = cells[~twice]
            borders = np.searchsorted(cells, np.arange(parts + 1, dtype=np.uint64) * np.uint64(PART_CELLS))
            for part in range(parts):
                mine = cells[borders[part] : borders[part + 1]] - np.uint64(part * PART_CELLS)
                if len(mine):
                    out.append((row * parts + part, bucket, gaps(mine)))
        return pa.table([pa.array([o[i] for o in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.binary()))], ["part", "bucket", "cells"])

    def merge_cells(table: pa.Table) -> pa.Table:
        counts = np.zeros(PART_CELLS, np.uint8)  # 2 stands for two or more
        sent = table["cells"].to_pylist()
        for packed in sent:
            cells = from_gaps(packed)
            again = np.concatenate([[False], cells[1:] == cells[:-1]])[: len(cells)]
            counts[cells[~again]] = np.minimum(counts[cells[~again]] + 1, 2)
            counts[cells[again]] = 2
        answers = [gaps(np.unique(cells[counts[cells] > 1])) for cells in map(from_gaps, sent)]
        return pa.table([table["part"], table["bucket"], pa.array(answers, pa.binary())], ["part", "bucket", "cells"])

    def may_repeat(own: _Bucket, cells: pa.Table) -> np.ndarray:
        may = np.ones(len(own.at), bool)
        for row in range(DEPTH):
            told = [from_gaps(c).astype(np.uint64) + np.uint64((p - row * parts) * PART_CELLS) for p, c in zip(cells["part"].to_pylist(), cells["cells"].to_pylist()) if p // parts == row]
            full = np.sort(np.concatenate(told)) if told else np.zeros(0, np.uint64)
            mine = _cells(own.one, own.two, row, parts)
            place = np.minimum(np.searchsorted(full, mine), max(len(full) - 1, 0))
            may &= full[place] == mine if len(full) else False
        return may

    def send_windows(table: pa.Table, cells: pa.Table) -> pa.Table:
        schema = pa.schema([("part", pa.int64()), ("bucket", pa.int64()), ("one", pa.binary()), ("two", pa.binary()), ("doc", pa.binary()), ("start", pa.binary()), ("at", pa.binary())])
        if not table.num_rows or not cells.num_rows:
            return schema.empty_table()
        own = _Bucket(table, window)
        send = np.flatnonzero(may_repeat(own, cells) & ~own.earlier_here())
        part = (own.one[send] >> np.uint64(20)) % np.uint64(answer_parts)
        order = np.argsort(part, kind="stable")
        send, part = send[order], part[order]
        borders = np.searchsorted(part, np.arange(answer_parts + 1, dtype=np.uint64))
        out, bucket = [], table["bucket"][0].as_py()
        for p in range(answer_parts):
            mine = send[borders[p] : borders[p + 1]]
            if len(mine):
                out.append((p, bucket, own.one[mine].tobytes(), own.two[mine].tobytes(), own.doc[mine].tobytes(), own.start[mine].astype(np.int64).tobytes(), mine.astype(np.uint32).tobytes()))
        return pa.table([pa.array([o[i] for o in out], f.type) for i, f in enumerate(schema)], schema=schema)

    def find_later(table: pa.Table) -> pa.Table:
        one, two, doc, start = (unpack(table, c, k) for c, k in (("one", "u8"), ("two", "u8"), ("doc", "i8"), ("start", "i8")))
        sizes = [len(x) for x in one]
        o, t, d, s = (np.concatenate(x) for x in (one, two, doc, start))
        order = np.lexsort((s, d, t, o))
        later = np.zeros(len(order), bool)
        later[order[1:]] = (o[order][1:] == o[order][:-1]) & (t[order][1:] == t[order][:-1])
        answers, upto = [], 0
        for n, at in zip(sizes, unpack(table, "at", "u4")):
            answers.append(at[later[upto : upto + n]].tobytes())
            upto += n
        return pa.table([table["bucket"], pa.array(answers, pa.binary())], ["bucket", "later"])

    def strip(table: pa.Table, answers: pa.Table) -> pa.Table:
        schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string()), ("kept_sha256", pa.string())])
        if not table.num_rows:
            return schema.empty_table()
        own = _Bucket(table, window)
        later = own.earlier_here()
        for at in unpack(answers, "later", "u4"):
            later[at] = True
        w = own.words
        cover = np.zeros(len(w.starts) + 1, np.int64)
        np.add.at(cover, own.at[later], 1)
        np.add.at(cover, own.at[later] + window, -1)
        gone = np.cumsum(cover)[:-1] > 0
        raw, out = w.data.tobytes(), []
        for n, doc in enumerate(own.table["doc_id"].to_pylist()):
            low, high = int(w.first[n]), int(w.first[n + 1])
            stay = low + np.flatnonzero(~gone[low:high])
            text = b" ".join([raw[s:e] for s, e in zip(w.starts[stay].tolist(), w.ends[stay].tolist())])
            out.append((doc, high - low, high - low - len(stay), text.decode("utf-8", "replace"), hashlib.sha256(text).hexdigest()))
        return pa.table([pa.array([o[i] for o in out], f.type) for i, f in enumerate(schema)], schema=schema)

    sent = rows.groupBy("bucket").applyInArrow(send_cells, "part long, bucket long, cells binary")
    cells = sent.groupBy("part").applyInArrow(merge_cells, "part long, bucket long, cells binary")
    windows = rows.groupBy("bucket").cogroup(cells.groupBy("bucket")).applyInArrow(send_windows, "part long, bucket long, one binary, two binary, doc binary, start binary, at binary")
    later = windows.groupBy("part").applyInArrow(find_later, "bucket long, later binary")
    return rows.groupBy("bucket").cogroup(later.groupBy("bucket")).applyInArrow(strip, "doc_id long, n_words long, n_removed long, kept_text string, kept_sha256 string")
