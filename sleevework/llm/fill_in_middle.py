"""Fill-in-the-middle texts: a span of each text moved behind what surrounds it, by array operations on whole batches."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sleevework.llm.shared import text_of
from sleevework.llm.wordcodes import column_bytes

BATCH_BYTES = 4 << 20  # of texts that are rearranged together; a longer text is alone
STEP_BYTES = 1 << 19  # of text that is held as single units at a time


class Marks(NamedTuple):
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"


def _check(marks: Marks) -> None:
    """An output can be taken apart only if no mark can begin inside another one."""
    for a in marks:
        for b in marks:
            inside = a != b and a in b
            if not a or inside or any(a[-n:] == b[:n] for n in range(1, min(len(a), len(b)))):
                raise ValueError(f"marks must not overlap: {marks}")
    if len(set(marks)) < 3:
        raise ValueError(f"marks must differ: {marks}")


def _draws(id_col: str, seed: int) -> list[Column]:
    """Four numbers below 2**32 from a hash of the seed and the id; a null id counts as no digits."""
    digest = F.sha2(F.encode(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), "UTF-8"), 256)
    return [F.conv(F.substring(digest, 8 * n + 1, 8), 16, 10).cast("long") for n in range(4)]


def _segments(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(the texts in segments of at most ``STEP_BYTES``, number of each one's text, code points of that text before it)."""
    data, base = column_bytes(texts)
    cuts = [base]
    for n in np.flatnonzero(np.diff(base) > STEP_BYTES):
        for at in range(int(base[n]) + STEP_BYTES, int(base[n + 1]), STEP_BYTES):
            while data[at] & 0xC0 == 0x80:  # inside a character
                at -= 1
            cuts.append(np.array([at]))
    borders = np.sort(np.concatenate(cuts), kind="stable")
    segments = pa.Array.from_buffers(pa.large_string(), len(borders) - 1, [None, pa.py_buffer(borders.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
    owner = np.searchsorted(base[1:], borders[:-1], "right") if len(texts) else np.zeros(0, np.int64)
    sizes = pc.utf8_length(segments).to_numpy(zero_copy_only=False)
    upto = np.cumsum(sizes) - sizes
    first = np.searchsorted(owner, owner)
    return segments, owner, upto - upto[first]


def _units(segments: pa.Array) -> pa.LargeListArray:
    """Each text as the list of its code points; the lists share the bytes of the texts."""
    data, base = column_bytes(segments)
    starts = np.flatnonzero((data & 0xC0) != 0x80)
    offsets = pa.py_buffer(np.append(starts, len(data)).astype(np.int64))
    flat = pa.Array.from_buffers(pa.large_string(), len(starts), [None, offsets, pa.py_buffer(np.ascontiguousarray(data))])
    return pa.LargeListArray.from_arrays(pa.array(np.searchsorted(starts, base)), flat)


def _rejoined(flat: pa.Array, parent: np.ndarray, n: int) -> pa.Array:
    """The units joined to one text for each of ``n`` parents, which are in order."""
    lists = pa.LargeListArray.from_arrays(pa.array(np.searchsorted(parent, np.arange(n + 1))), flat)
    return pc.binary_join(lists, pa.scalar("", pa.large_string()))


def _spans(texts: pa.Array, low: np.ndarray, high: np.ndarray) -> list[pa.Array]:
    """(what is before place ``low``, from there to ``high``, from there on) of each text.

    Units are numbered within their text, given a role by that number, filtered by role and joined again.
    """
    segments, owner, before = _segments(texts)
    sizes = np.diff(column_bytes(segments)[1])
    pieces: list[list[pa.Array]] = [[], [], []]
    at = 0
    while at < len(segments):
        to = at + max(1, int(np.searchsorted(np.cumsum(sizes[at:]), STEP_BYTES, "right")))
        lists = _units(segments.slice(at, to - at))
        flat, parent = pc.list_flatten(lists), pc.list_parent_indices(lists)
        starts = lists.offsets.to_numpy()[:-1]
        segment = parent.to_numpy()
        ordinal = pc.add(pc.subtract(pa.array(np.arange(len(flat))), pc.take(pa.array(starts), parent)), pc.take(pa.array(before[at:to]), parent))
        mine = owner[at:to]
        role = pc.add(*(pc.cast(pc.greater_equal(ordinal, pc.take(pa.array(place[mine]), parent)), pa.int8()) for place in (low, high)))
        for r, out in enumerate(pieces):
            wanted = pc.equal(role, pa.scalar(r, pa.int8()))
            out.append(_rejoined(pc.filter(flat, wanted), segment[wanted.to_numpy(zero_copy_only=False)], to - at))
        at = to
    return [_rejoined(pa.concat_arrays(p), owner, len(texts)) for p in pieces]


def fill_in_middle(docs: DataFrame, seed: int = 1, percent: int = 90, suffix_first_percent: int = 20, marks: Marks = Marks(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output), one row per row of ``docs``.

    A text of n code points (null: empty) is cut at two places that hash draws of the seed and the id name; about
    ``percent`` of the texts are rearranged, the others, empty ones and those that contain a mark stay ``plain``.
    Of the rearranged, about ``suffix_first_percent`` are ``spm`` (suffix, prefix, middle), the others ``psm`` (prefix,
    suffix, middle), each part behind its mark. The counts are null for plain texts. Rows of one id, null
    included, share their draws; repeated rows give repeated rows; an empty table gives none; other columns are
    not read.

    No row meets another one, so nothing is shuffled and any split of the table gives the same rows. Within a
    task texts are held as single code points for ``STEP_BYTES`` at a time; a longer text passes in segments.
    """
    _check(marks)
    h1, h2, h3, h4 = _draws(id_col, seed)
    text = F.col("text")
    marked = text.contains(marks[0]) | text.contains(marks[1]) | text.contains(marks[2])
    form = F.when((F.col("n") == 0) | marked | (h3 % 100 >= percent), "plain").when(h4 % 100 < suffix_first_percent, "spm").otherwise("psm")
    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    read = read.withColumn("n", F.char_length("text").cast("long"))
    a, b = (F.pmod(h, F.col("n") + 1) for h in (h1, h2))
    drawn = read.select("doc_id", "text", "n", form.alias("form"), F.least(a, b).alias("low"), F.greatest(a, b).alias("high"))

    def outputs(batch: pa.RecordBatch) -> pa.RecordBatch:
        spans = [batch.column(c).to_numpy() for c in ("low", "high")]
        prefix, middle, suffix = _spans(batch.column("text"), *spans)
        mark = {name: pa.scalar(m, pa.large_string()) for name, m in zip(Marks._fields, marks)}
        join = lambda *parts: pc.binary_join_element_wise(*parts, pa.scalar("", pa.large_string()))
        psm = join(mark["prefix"], prefix, mark["suffix"], suffix, mark["middle"], middle)
        spm = join(mark["suffix"], suffix, mark["prefix"], prefix, mark["middle"], middle)
        chosen = pc.if_else(pc.equal(batch.column("form"), "spm"), spm, psm)
        counts = [batch.column("low"), pc.subtract(batch.column("high"), batch.column("low"))]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n"), batch.column("form"), *counts, chosen.cast(pa.string())], names)

    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]

    def rearrange(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            step = max(1, int(whole.num_rows * BATCH_BYTES / max(1, whole.nbytes)))
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                plain = pc.equal(batch.column("form"), "plain")
                same = batch.filter(plain)
                none = pa.nulls(same.num_rows, pa.int64())
                yield pa.RecordBatch.from_arrays([same.column("doc_id"), same.column("n"), same.column("form"), none, none, same.column("text")], names)
                yield outputs(batch.filter(pc.invert(plain)))

    return drawn.mapInArrow(rearrange, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(form: Column, output: Column, marks: Marks = Marks()) -> Column:
    """The text that an output was made of: each mark occurs once, so what is between two of them is a part of it."""
    p, s, m = marks
    between = lambda a, b: F.substring_index(F.substring_index(output, a, -1), b, 1)
    middle = F.substring_index(output, m, -1)
    psm = F.concat(between(p, s), middle, between(s, m))
    spm = F.concat(between(p, m), middle, between(s, p))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
