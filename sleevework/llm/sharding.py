"""Shards of near-equal size: best-fit-decreasing bin packing of indivisible groups of equal texts."""

from __future__ import annotations

import random
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sleevework.llm.shared import ranked, saved, text_of

OVERHEAD = 16  # bytes a row takes besides its text


@dataclass
class _Node:
    key: tuple[int, int]
    weight: float
    left: _Node | None = None
    right: _Node | None = None


class OpenBins:
    """A balanced search tree (a treap) of (remaining capacity, bin); finds the tightest bin that still fits."""

    def __init__(self) -> None:
        self._root: _Node | None = None
        self._random = random.Random(0)

    def _split(self, node: _Node | None, key: tuple[int, int]) -> tuple[_Node | None, _Node | None]:
        """The keys below ``key``, and the rest."""
        if node is None:
            return None, None
        if node.key < key:
            node.right, rest = self._split(node.right, key)
            return node, rest
        less, node.left = self._split(node.left, key)
        return less, node

    def _merge(self, a: _Node | None, b: _Node | None) -> _Node | None:
        if a is None or b is None:
            return a or b
        if a.weight < b.weight:
            a.right = self._merge(a.right, b)
            return a
        b.left = self._merge(a, b.left)
        return b

    def add(self, remaining: int, number: int) -> None:
        less, rest = self._split(self._root, (remaining, number))
        self._root = self._merge(self._merge(less, _Node((remaining, number), self._random.random())), rest)

    def take(self, need: int) -> tuple[int, int] | None:
        """Remove and return the bin with the least remaining capacity that is at least ``need``."""
        node, found = self._root, None
        while node is not None:
            if node.key >= (need, -1):
                found, node = node.key, node.left
            else:
                node = node.right
        if found is not None:
            less, rest = self._split(self._root, found)
            _, more = self._split(rest, (found[0], found[1] + 1))
            self._root = self._merge(less, more)
        return found


def best_fit_decreasing(classes: list[tuple[int, int]], capacity: int, bins: int | None = None) -> list[tuple[int, int, int]] | None:
    """Pack classes (size, number of items of that size): runs (class, items, bin), or None if ``bins`` do not do.

    Items of one size are interchangeable, so a whole run enters the tightest bin at once: after the first item
    the bin is only tighter and still the best fit for the next one.
    """
    open_bins, used, runs = OpenBins(), 0, []
    for at in sorted(range(len(classes)), key=lambda i: -classes[i][0]):
        size, left = classes[at]
        while left:
            got = open_bins.take(size)
            if got is None:
                if bins is not None and used == bins:
                    return None
                got, used = (max(capacity, size), used), used + 1
            n = min(left, got[0] // size)
            runs.append((at, n, got[1]))
            left -= n
            if got[0] > n * size:
                open_bins.add(got[0] - n * size, got[1])
    return runs


def near_equal(classes: list[tuple[int, int]], bins: int) -> list[tuple[int, int, int]]:
    """The packing of the least capacity found for which best fit decreasing needs no more than ``bins`` bins.

    An item of no less than an even share of what is left to pack takes a bin of its own first, so that one huge
    item does not raise the capacity of all the others.
    """
    order = sorted(range(len(classes)), key=lambda i: -classes[i][0])
    rest, runs, used, first = sum(s * n for s, n in classes), [], 0, 0
    taken = 0  # items of the class at ``first`` that have bins of their own
    while first < len(order) and classes[order[first]][0] * (bins - used) >= rest:
        runs.append((order[first], 1, used))
        rest, used, taken = rest - classes[order[first]][0], used + 1, taken + 1
        if taken == classes[order[first]][1]:
            first, taken = first + 1, 0
    if first == len(order):
        return runs
    left = [(classes[at][0], classes[at][1] - (taken if at == order[first] else 0)) for at in order[first:]]
    low = max(-(-rest // (bins - used)), left[0][0])
    high, best = low, None
    while best is None:
        best = best_fit_decreasing(left, high, bins - used)
        high = high if best is not None else high + max(1, high // 64)
    while low < high:
        middle = (low + high) // 2
        packed = best_fit_decreasing(left, middle, bins - used)
        low, high, best = (low, middle, packed) if packed is not None else (middle + 1, high, best)
    return runs + [(order[first + at], n, used + number) for at, n, number in best]


def shard(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text", lots: int = 1000) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard), one row per row of ``docs``; the law is ``bytes``.

    A row's size is the UTF-8 bytes of its text and 16; a null text has none, and null and empty texts are one
    group. Rows of equal text form a group that stays in one shard. A group larger than an even share of all bytes
    has a shard of its own, and the others share the remaining shards evenly. Groups enter shards by best fit
    decreasing under the least capacity that needs no more than ``shards`` bins. An empty table gives
    no rows; other columns are not read; null and repeated ids are rows of their own.

    Groups below 1/(``shards`` * ``lots``) of all bytes, a thousandth of a shard by default, enter together with others
    in as many lots drawn by the hash of their text. So there are at most 2 * ``shards`` * ``lots`` items to pack at any
    size of the input: only counts of them by their bytes reach the driver, and which item goes where is a small table.
    """
    spark = docs.sparkSession
    text = text_of(text_col)
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.sha2(text, 256).alias("print"),
    )
    rows = saved(rows, "shard-rows")
    groups = rows.groupBy("print", "size").agg(F.count("*").alias("n")).select("print", (F.col("size") * F.col("n")).alias("bytes"))
    groups = saved(groups, "shard-groups")
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    small = F.col("bytes") * F.lit(shards * lots).cast("decimal(20,0)") < F.lit(total)
    lot = F.concat(F.lit("lot "), F.pmod(F.xxhash64("print"), F.lit(shards * lots)))
    groups = groups.withColumn("item", F.when(small, lot).otherwise(F.col("print")))
    items = groups.groupBy("item").agg(F.sum("bytes").alias("bytes"))
    placed = saved(ranked(items, ["bytes"], ["item"], "place"), "shard-items")

    classes = [(r["bytes"], r["n"]) for r in placed.groupBy("bytes").agg(F.count("*").alias("n")).collect()]
    ends: dict[int, list[tuple[int, int]]] = {}
    for at, n, number in near_equal(classes, shards):
        runs = ends.setdefault(classes[at][0], [])
        runs.append((n + (runs[-1][0] if runs else 0), number))
    plan = spark.createDataFrame(list(ends.items()), "bytes_ long, runs array<struct<upto:long,shard:int>>")
    homes = placed.join(plan, F.col("bytes") == F.col("bytes_")).select("item", F.expr("filter(runs, r -> r.upto > place)[0].shard").alias("shard"))
    # saved, so that the join reads both sides from storage and a text with many rows can be split
    homes = saved(groups.join(homes, "item").select("print", "shard"), "shard-homes")
    slotted = ranked(rows.join(homes, "print").drop("print"), ["shard"], ["doc_id", "text_crc32"], "slot")
    return slotted.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
