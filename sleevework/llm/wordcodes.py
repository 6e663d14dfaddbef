"""Whole columns of texts as arrays: word borders, 64-bit codes of words, and codes of runs of words."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from xxhash import xxh3_64_intdigest

BLANK = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
PIECES = 1 << 18  # that are told apart at a time
_LOW_BYTES = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)
_SIZE_MARKS = np.array([*[n << 56 for n in range(8)], 0], np.uint64)  # in the byte that pieces of up to seven leave free
_FACTOR = np.uint64(0x9FB21C651E98DF25)


@cache
def _letters(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Every bit of the input moves about half of the bits of the output."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    data: np.ndarray  # bytes of all texts
    starts: np.ndarray  # of each word in ``data``
    ends: np.ndarray
    first: np.ndarray  # of each document, the number of its first word; one more at the end
    base: np.ndarray  # of each document, its first byte; one more at the end


def column_bytes(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column without nulls, and where each value starts; one more place at the end."""
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(whole, pa.ChunkedArray):
        whole = pa.concat_arrays(whole.chunks) if whole.num_chunks else pa.array([], pa.large_binary())
    whole = whole.cast(pa.large_binary())
    if not len(whole):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = whole.buffers()
    places = np.frombuffer(offsets, np.int64)[whole.offset : whole.offset + len(whole) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[places[0] : places[-1]], places - places[0]


def find_words(column: pa.ChunkedArray | pa.Array) -> Words:
    data, base = column_bytes(column)
    blank = BLANK[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[base] = True
    inside = ~blank
    starts = np.flatnonzero(inside & (np.concatenate([[True], blank[:-1]])[: len(data)] | edge[:-1]))
    ends = np.flatnonzero(inside & (np.concatenate([blank[1:], [True]])[: len(data)] | edge[1:])) + 1
    return Words(data, starts, ends, np.searchsorted(starts, base), base)


def pieces_coded(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seeds: tuple[int, ...]) -> list[np.ndarray]:
    """For each seed a 64-bit hash of the bytes of each piece; pieces are in order and do not overlap. Each different piece is hashed once."""
    out = [np.zeros(len(starts), np.uint64) for _ in seeds]
    for low in range(0, len(starts), PIECES):
        some = slice(low, low + PIECES)
        begins, stops = starts[some] - starts[low], ends[some] - starts[low]
        turns = np.zeros(int(stops[-1]) + 1, np.int8)
        turns[begins] += 1
        turns[stops] -= 1
        letters = data[starts[low] : ends[some][-1]][np.cumsum(turns[:-1], dtype=np.int8) > 0]  # without what is between the pieces
        borders = np.concatenate([[0], np.cumsum(stops - begins)])
        parts = pa.Array.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(borders.astype(np.int64)), pa.py_buffer(letters)]).dictionary_encode()
        distinct, at = parts.dictionary.to_pylist(), parts.indices.to_numpy()
        for codes, seed in zip(out, seeds):
            codes[some] = np.fromiter((xxh3_64_intdigest(x, seed) for x in distinct), np.uint64, len(distinct))[at]
    return out


def piece_codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 1) -> np.ndarray:
    return pieces_coded(data, starts, ends, (seed,))[0]


def short_piece_codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Codes of pieces most of which are short: up to 15 bytes are read as two numbers and mixed, longer pieces are hashed.

    No two pieces of up to seven bytes share a code.
    """
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    eights = np.ndarray(len(data) + 9, "<u8", padded, strides=(1,))  # the eight bytes from each place on
    length = ends - starts
    codes = mix((eights[starts] & _LOW_BYTES[np.minimum(length, 8)]) ^ _SIZE_MARKS[np.minimum(length, 8)])
    some = np.flatnonzero((length > 7) & (length < 16))
    rest = length[some] - 8
    codes[some] = mix(codes[some] * _FACTOR + ((eights[starts[some] + 8] & _LOW_BYTES[rest]) ^ _SIZE_MARKS[rest]))
    far = np.flatnonzero(length > 15)
    if len(far):
        codes[far] = piece_codes(data, starts[far], ends[far])
    return codes


def run_codes(words: np.ndarray, length: int, seed: int = 1) -> np.ndarray:
    """A code of every ``length`` consecutive words, whatever document they are in."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    factor = _letters(seed + 100)[0] | np.uint64(1)
    total = np.full(n, np.uint64(length))
    for at in range(length):
        total = total * factor + words[at : at + n]
    return mix(total)


def starts_inside(first: np.ndarray, length: int) -> np.ndarray:
    """Which starts of runs of ``length`` words end in the document they begin in; for ``run_codes``."""
    n = int(first[-1]) - length + 1
    ok = np.ones(max(n, 0), bool)
    if n > 0:
        for back in range(1, length):  # a run may not start in the last words of a document
            at = first[1:-1] - back
            own = at >= first[:-2]
            ok[at[own & (at < n)]] = False
    return ok
