"""Documents in buckets of bounded size, and arrays that buckets exchange with the parts of a key space.

Work that needs facts about the whole corpus goes in three steps: every bucket sends each part one row with
the keys it has there, every part merges what all buckets sent and answers each bucket with one row, and the
bucket meets its documents again together with the answers. Nothing passes through the driver, and a key that
is in every document is sent once by each bucket.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sleevework.llm.shared import text_of


def bucketed(docs: DataFrame, bucket_bytes: int, id_col: str = "doc_id", text_col: str = "text", *more: Column, by_text: bool = False) -> tuple[DataFrame, int]:
    """((doc_id, text, more columns, bucket), bytes of all texts). A bucket holds about ``bucket_bytes``; all rows of an id share one.

    With ``by_text`` rows are dealt by id and text together, so only equal rows have to share a bucket. A null text
    becomes an empty one.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"), *more)
    total = int(rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0)
    buckets = max(1, -(-total // bucket_bytes))
    key = [F.coalesce("doc_id", F.lit(-1).cast("long")), *([F.col("text")] if by_text else [])]
    bucket: Column = F.pmod(F.xxhash64(*key), F.lit(buckets))
    return rows.withColumn("bucket", bucket), total


def ids_in_order(table: pa.Table) -> tuple[pa.Table, np.ndarray]:
    """(documents in order, their ids with the least long for null, which sorts first)."""
    void = pa.scalar(-(2**63), pa.int64())
    filled = table.append_column("order", table["doc_id"].fill_null(void) if table.num_rows else table["doc_id"])
    filled = filled.sort_by([("order", "ascending"), ("text", "ascending")])
    return filled, filled["order"].to_numpy()


def unpack(table: pa.Table, column: str, kind: str) -> list[np.ndarray]:
    return [np.frombuffer(x, kind) for x in table[column].to_pylist()]


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending distinct 64-bit numbers in about 2 + log2(span / count) bits each: low bits as they are, high bits in unary."""
    if not len(values):
        return b""
    rest, n = values - values[0], len(values)
    low = max(0, (int(rest[-1]) // n).bit_length() - 1)
    high = (rest >> np.uint64(low)).astype(np.int64)
    marks = np.zeros(int(high[-1]) + n, bool)
    marks[high + np.arange(n)] = True
    wide = -(-low // 8)
    bits = np.unpackbits(rest.astype(">u8").view(np.uint8).reshape(n, 8)[:, 8 - wide :], axis=1)[:, 8 * wide - low :]
    head = np.array([n, low, values[0], len(marks)], np.uint64)
    return head.tobytes() + np.packbits(marks).tobytes() + np.packbits(bits).tobytes()


def unpack_sorted(packed: bytes) -> np.ndarray:
    if not packed:
        return np.zeros(0, np.uint64)
    head = np.frombuffer(packed, np.uint64, 4)
    n, low, marked = int(head[0]), int(head[1]), int(head[3])
    raw, wide, to = np.frombuffer(packed, np.uint8)[32:], -(-low // 8), -(-marked // 8)
    high = np.flatnonzero(np.unpackbits(raw[:to], count=marked)) - np.arange(n)
    bits = np.zeros((n, 8 * wide), np.uint8)
    bits[:, 8 * wide - low :] = np.unpackbits(raw[to:], count=n * low).reshape(n, low)
    rest = np.zeros((n, 8), np.uint8)
    rest[:, 8 - wide :] = np.packbits(bits, axis=1)
    return (high.astype(np.uint64) << np.uint64(low)) + rest.view(">u8").ravel().astype(np.uint64) + head[2]


def pack_counts(counts: np.ndarray) -> bytes:
    """Whole numbers in a byte each; 255 stands for those from 255 on, which follow in eight."""
    return np.minimum(counts, 255).astype(np.uint8).tobytes() + counts[counts >= 255].astype("<i8").tobytes()


def unpack_counts(packed: bytes, n: int) -> np.ndarray:
    counts = np.frombuffer(packed, np.uint8, n).astype(np.int64)
    counts[counts == 255] = np.frombuffer(packed[n:], "<i8")
    return counts


def gaps(sorted_places: np.ndarray) -> bytes:
    """Ascending whole numbers below 2**32 as 16-bit steps; 65535 means that many on without a number."""
    steps = np.diff(sorted_places.astype(np.int64), prepend=0)
    far = steps // 65535
    out = np.full(len(steps) + int(far.sum()), 65535, np.uint16)
    out[np.cumsum(far + 1) - 1] = steps % 65535
    return out.tobytes()


def from_gaps(packed: bytes) -> np.ndarray:
    steps = np.frombuffer(packed, np.uint16).astype(np.int64)
    return np.cumsum(steps)[steps != 65535]
