"""Token ids of whole columns of texts: each different piece of a batch goes through the tokenizer once."""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sleevework.llm.shared import text_of
from sleevework.llm.wordcodes import BLANK, column_bytes

BATCH_BYTES = 4 << 20
PIECES = 1 << 20  # that are looked up at a time
CACHE_PIECES = 600_000
CACHE_BYTES = 24 << 20  # of the pieces with their places, and of their ids
AT_ONCE = 512  # pieces in one call of the tokenizer

BLANKS = " \t\n\v\f\r"

Cuts = Callable[[np.ndarray], np.ndarray]


_LETTER = np.isin(np.arange(256), [*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)])
_MARK = np.isin(np.arange(256), [c for c in range(0x21, 0x7F) if not chr(c).isalpha() and chr(c) != "|"])


def behind_letters(data: np.ndarray) -> np.ndarray:
    """Between an ASCII letter and a digit or mark: letters are matched as a run, which ends there.

    Not before a bar, which stands inside the names of special tokens.
    """
    return np.flatnonzero(_LETTER[data[:-1]] & _MARK[data[1:]]) + 1


def before_plain_words(data: np.ndarray) -> np.ndarray:
    """Blanks between two characters of which neither is white space, and behind letters: a byte-level tokenizer always cuts there.

    Only ASCII characters and the two-byte characters from U+00C0 are recognised; elsewhere pieces stay longer.
    """
    if len(data) < 3:
        return np.zeros(0, np.int64)
    before, here, after = data[:-2], data[1:-1], data[2:]
    lead = np.concatenate([[0], data[:-3]])
    plain = lambda x: (x > 0x20) & (x < 0x7F)
    ends_word = plain(before) | ((before >= 0x80) & (before < 0xC0) & (lead >= 0xC3) & (lead <= 0xDF))
    blanks = np.flatnonzero((here == 0x20) & ends_word & (plain(after) | ((after >= 0xC3) & (after <= 0xDF)))) + 1
    return np.concatenate([blanks, behind_letters(data)])


def after_blanks(data: np.ndarray) -> np.ndarray:
    """Where words begin, and behind letters: a tokenizer that drops white space always cuts there."""
    blank = BLANK[data]
    return np.concatenate([np.flatnonzero(blank[:-1] & ~blank[1:]) + 1, behind_letters(data)])


@cache
def _tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@cache
def _word_ends(path: str) -> np.ndarray:
    """Which ids end a word; empty for a tokenizer that does not mark the ends of words."""
    suffix = getattr(_tokenizer(path).model, "end_of_word_suffix", None)
    if not suffix:
        return np.zeros(0, bool)
    vocabulary = _tokenizer(path).get_vocab()
    out = np.zeros(max(vocabulary.values()) + 1, bool)
    out[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
    return out


class Tokens:
    """A tokenizer and the ids of pieces met before, in flat arrays that are bounded in number and bytes."""

    def __init__(self, path: str, cuts: Cuts) -> None:
        self.path, self.cuts = path, cuts
        self._known = pa.array([], pa.large_binary())
        self._ids, self._ends = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _encode_new(self, pieces: list[bytes]) -> tuple[list[int], np.ndarray, np.ndarray]:
        """(order in which the pieces were encoded, ids on end, how many of each)."""
        tokenizer, ends_word = _tokenizer(self.path), _word_ends(self.path)
        texts = [p.decode("utf-8", "replace") for p in pieces]
        words = [n for n, t in enumerate(texts) if t.rstrip(BLANKS).isalpha()] if len(ends_word) else []
        order, ids, sizes = [], array("I"), array("q")
        left = set(range(len(texts)))
        for low in range(0, len(words), AT_ONCE):
            some = words[low : low + AT_ONCE]
            found = np.array(tokenizer.encode_batch_fast([" ".join(texts[n] for n in some)], add_special_tokens=False)[0].ids)
            stops = np.flatnonzero(ends_word[found]) + 1
            if len(stops) == len(some):  # each is one word to the tokenizer too
                order += some
                ids.extend(found.tolist())
                sizes.extend(np.diff(stops, prepend=0).tolist())
                left.difference_update(some)
        rest = sorted(left)
        for low in range(0, len(rest), AT_ONCE):
            for found in tokenizer.encode_batch_fast([texts[n] for n in rest[low : low + AT_ONCE]], add_special_tokens=False):
                ids.extend(found.ids)
                sizes.append(len(found))
        return order + rest, np.array(ids, np.uint32), np.array(sizes, np.int64)

    def _look_up(self, pieces: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, where those of each piece start, where they end); the pieces are distinct.

        New pieces are kept. Beyond the bounds only those of this call are, or none if they exceed the bounds alone.
        """
        place = pc.fill_null(pc.index_in(pieces, value_set=self._known), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        missing = np.flatnonzero(place < 0)
        order, ids, sizes = self._encode_new(pieces.take(pa.array(missing)).to_pylist())
        missing = missing[order]
        place[missing] = len(self._known) + np.arange(len(missing))
        self._known = pa.concat_arrays([self._known, pieces.take(pa.array(missing))])
        self._ids = np.concatenate([self._ids, ids])
        self._ends = np.concatenate([self._ends, np.cumsum(sizes) + self._ends[-1]])
        all_ids, starts, stops = self._ids, self._ends[place], self._ends[place + 1]
        if len(self._known) > CACHE_PIECES or self._known.nbytes > CACHE_BYTES or self._ids.nbytes > CACHE_BYTES:
            few = len(pieces) <= CACHE_PIECES and pieces.nbytes <= CACHE_BYTES and 4 * int((stops - starts).sum()) <= CACHE_BYTES
            self._known = pieces if few else pieces.slice(0, 0)
            self._ends = np.concatenate([[0], np.cumsum(stops - starts)]) if few else np.zeros(1, np.int64)
            self._ids = all_ids[np.repeat(starts - self._ends[:-1], stops - starts) + np.arange(self._ends[-1])] if few else all_ids[:0]
        return all_ids, starts, stops

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts on end, where the ids of each text start and end).

        Pieces are told apart by their bytes, and the tokenizer sees each different one.
        """
        data, base = column_bytes(column)
        edges = np.zeros(len(data) + 1, bool)
        edges[base] = True
        edges[self.cuts(data)] = True
        borders = np.flatnonzero(edges)
        first = np.searchsorted(borders, base)
        del edges
        raw = pa.py_buffer(np.ascontiguousarray(data))
        out, lengths = [], [np.zeros(1, np.int64)]
        for low in range(0, len(borders) - 1, PIECES):
            part = borders[low : low + PIECES + 1]
            pieces = pa.Array.from_buffers(pa.large_binary(), len(part) - 1, [None, pa.py_buffer(np.ascontiguousarray(part)), raw])
            coded = pieces.dictionary_encode()
            ids, start, end = self._look_up(coded.dictionary)
            at = coded.indices.to_numpy()
            sizes = (end - start)[at]
            upto = np.cumsum(sizes)
            total = int(upto[-1]) if len(upto) else 0
            out.append(ids[np.repeat(start[at] - upto + sizes, sizes) + np.arange(total)])
            lengths.append(sizes)
        ends = np.cumsum(np.concatenate(lengths))
        return (np.concatenate(out) if out else np.zeros(0, np.uint32)), ends[first]


@cache
def _of_worker(path: str, cuts: Cuts) -> Tokens:
    """The tasks of a worker share what it knows."""
    return Tokens(path, cuts)


def token_pieces(docs: DataFrame, path: str, cuts: Cuts, size: int, end: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): each document, with the id ``end`` behind it, cut every ``size`` ids."""
    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _of_worker(path, cuts)
        for batch in batches:
            step = max(1, int(batch.num_rows * BATCH_BYTES / max(1, batch.nbytes)))
            for low in range(0, batch.num_rows, step):
                part = batch.slice(low, step)
                ids, borders = tokens.encode(part.column("text"))
                rows: list[tuple] = []
                for n, doc in enumerate(part.column("doc_id").to_pylist()):
                    own = np.append(ids[borders[n] : borders[n + 1]], np.uint32(end)).astype("<u4")
                    rows += [(doc, at, min(size, len(own) - at), zlib.crc32(own[at : at + size].tobytes()), len(own)) for at in range(0, len(own), size)]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return read.mapInArrow(cut, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")
