"""Near-duplicate classes: bottom-k sketches of word shingles, inverted lists, estimates, exact Jaccard."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sleevework.llm.shared import components, saved, text_of
from sleevework.llm.wordcodes import LOWER, find_words, mix, piece_codes, run_codes

SHINGLE = 5
KEEP = 64  # retained values of a sketch
PERCENT = 85
#: The wide sketches of step 3 have so many values: the whole set, and so an exact answer, for sets up to that size.
WIDE = 256
LOSS = 1e-6  # chance at most that the sketches of a pair at the threshold share less than ``least_shared``
LOSS_WIDE = 1e-9  # the same for wide sketches, which only save exact comparisons
BATCH_BYTES = 8 << 20
COLUMNS = 4096  # values that are compared at a time
BLOCK = 512  # members of a list that are compared in one task


def least_shared(percent: int, kept: int, loss: float = LOSS) -> int:
    """The percentage of its own retained values that a linked document shares at least, in sketches of ``kept``.

    For a pair at the threshold the number of shared values of two full sketches is at least a binomial
    (kept, percent / 100) draw; it falls short of the returned share with a chance of ``loss`` at most.
    """
    p, below, falls_short = percent / 100, 0.0, []
    for shared in range(kept + 1):  # falls_short[n]: the chance of fewer than n shared values
        falls_short.append(below)
        below += math.comb(kept, shared) * p**shared * (1 - p) ** (kept - shared)
    return max(share for share in range(percent + 1) if falls_short[_of(share, kept)] <= loss)


def _of(share: int, n):
    """So many percent of ``n``, rounded up; in whole numbers, which agree between Python, numpy and SQL."""
    return (share * n + 99) // 100


def _shingles(texts: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingle codes of each text."""
    w = find_words(texts)
    words = piece_codes(LOWER[w.data], w.starts, w.ends)
    runs = run_codes(words, SHINGLE)
    for low, high in zip(w.first[:-1].tolist(), w.first[1:].tolist()):
        if high - low >= SHINGLE:
            yield np.unique(runs[low : high - SHINGLE + 1])
        elif high > low:
            yield run_codes(words[low:high], high - low, 1000 + high - low)
        else:
            yield np.zeros(0, np.uint64)


def _print(codes: np.ndarray) -> tuple[int, int]:
    """128 bits for a set."""
    one = mix(codes ^ np.uint64(0x243F6A8885A308D3)).sum(dtype=np.uint64)
    two = mix(codes + np.uint64(0x13198A2E03707344)).sum(dtype=np.uint64)
    return int(one.astype(np.int64)), int(two.astype(np.int64))


def _in_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        step = max(1, int(batch.num_rows * BATCH_BYTES / max(1, batch.nbytes)))
        for low in range(0, batch.num_rows, step):
            yield batch.slice(low, step)


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, one, two, sketch): size and 128-bit print of each shingle set, and its smallest hashes."""
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _in_parts(batches):
            rows = []
            for codes in _shingles(part.column("text")):
                rows.append((len(codes), *_print(codes), np.sort(mix(codes))[:KEEP].tobytes()))
            cols = [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.binary()))]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *cols], ["doc_id", "n", "one", "two", "sketch"])

    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return read.mapInArrow(sketch, "doc_id long, n long, one long, two long, sketch binary")


def _postings(classes: DataFrame, share: int) -> DataFrame:
    """(cid, k, shared, first, weight): the retained values that a class shares with any other, the rarest first.

    A linked class shares one of the first ``first`` of them: with values that nobody else retains ahead of all,
    two sketches that share ``share`` percent of the ``k`` values of either meet within the first 100 - ``share``.
    """
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [np.frombuffer(x, np.int64) for x in batch.column("sketch").to_pylist()]
            sizes = [len(v) for v in values]
            if sum(sizes):
                cid = np.repeat(batch.column("cid").to_numpy(), sizes)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(values)), pa.array(cid), pa.array(np.repeat(sizes, sizes).astype(np.int64))], ["value", "cid", "k"])

    spread_out = classes.select("cid", "sketch").mapInArrow(spread, "value long, cid long, k long")
    often = spread_out.groupBy("value").agg(F.count("*").alias("n")).where("n > 1")
    held = spread_out.join(often, "value").groupBy("cid").agg(F.array_sort(F.collect_list(F.struct("n", "value"))).alias("held"), F.max("k").alias("k"))
    first = F.greatest(F.lit(0), F.expr(f"k - ({share} * k + 99) div 100 + 1 - (k - size(held))")).cast("int")
    held = held.select("cid", "k", F.transform("held", lambda h: h["value"]).alias("shared"), first.alias("first"), F.aggregate("held", F.lit(0).cast("long"), lambda s, h: s + h["n"]).alias("weight")).where("first > 0")
    return held


def _overlap(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """How many values each of ``x`` has in common with each of ``y``."""
    vx, vy = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (x, y))
    kinds, codes = np.unique(np.concatenate([vx, vy]), return_inverse=True)
    both = np.isin(kinds, vx, assume_unique=False) & np.isin(kinds, vy)
    column = np.cumsum(both) - 1
    sides = []
    for values, part in ((x, codes[: len(vx)]), (y, codes[len(vx) :])):
        row = np.repeat(np.arange(len(values)), [len(v) for v in values])
        use = both[part]
        sides.append((row[use], column[part[use]]))
    out = np.zeros((len(x), len(y)), np.float32)
    for low in range(0, int(both.sum()), COLUMNS):
        held = []
        for values, (row, at) in zip((x, y), sides):
            use = (at >= low) & (at < low + COLUMNS)
            held.append(np.zeros((len(values), COLUMNS), np.float32))
            held[-1][row[use], at[use] - low] = 1
        out += held[0] @ held[1].T
    return out


def _arrays(table: pa.Table, name: str) -> list[np.ndarray]:
    return [np.array(v, np.int64) for v in table[name].to_pylist()]


def _candidates(x: pa.Table, y: pa.Table, percent: int, share: int) -> np.ndarray:
    """Which pairs of members of one list may be linked and meet in no list before this one.

    Lists are in the order of the shared values, the rarest first; what stands before this list's value in either
    member's order are the lists it was in before.
    """
    value = x["value"][0].as_py()
    sx, sy = _arrays(x, "shared"), _arrays(y, "shared")
    before = _overlap(*([v[: int(np.flatnonzero(v == value)[0])] for v in side] for side in (sx, sy)))
    need = _of(share, np.minimum.outer(x["k"].to_numpy(), y["k"].to_numpy()))
    nx, ny = x["n"].to_numpy(), y["n"].to_numpy()
    sizes = 100 * np.minimum.outer(nx, ny) >= percent * np.maximum.outer(nx, ny)
    apart = x["comp"].to_numpy()[:, None] != y["comp"].to_numpy()[None, :]
    once = ~y["outside"].to_numpy()[None, :] | (x["cid"].to_numpy()[:, None] < y["cid"].to_numpy()[None, :])
    return (before == 0) & sizes & apart & once & (_overlap(sx, sy) >= need)


def _verified(pairs: DataFrame, classes: DataFrame, sets: DataFrame, percent: int, share: int) -> DataFrame:
    """(a, b) of the pairs of classes that are linked: sizes, then the union of the sketches, then the full sets."""
    side = classes.select("cid", "n", "sketch")
    both = pairs.join(side.toDF("a", "na", "sa"), "a").join(side.toDF("b", "nb", "sb"), "b")
    both = both.where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))

    def estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("sa").to_pylist(), batch.column("sb").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                union = np.union1d(x, y)[: max(len(x), len(y))]  # the bottom of the union
                common = np.intersect1d(x, y, assume_unique=True)
                keep.append(bool(len(union)) and int((common <= union[-1]).sum()) >= _of(share, len(union)))
            chosen = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(chosen), batch.column("b").filter(chosen)], ["a", "b"])

    likely = both.select("a", "b", "sa", "sb").mapInArrow(estimate, "a long, b long")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("xa").to_pylist(), batch.column("xb").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            chosen = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(chosen), batch.column("b").filter(chosen)], ["a", "b"])

    full = likely.join(sets.toDF("a", "xa"), "a").join(sets.toDF("b", "xb"), "b")
    return full.select("a", "b", "xa", "xb").mapInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of ``docs``.

    A document's set has its distinct shingles of five words, A-Z in lower case; a shorter document is one shingle;
    one without words (or null) is linked with nothing. Two sets are linked if 100 |x and y| >= ``percent`` |x or y|.
    ``component_id`` is the smallest id that can be reached, ``kept`` marks its row. Rows that share an id share
    a component. Rows with a null id are linked with nothing, have a null component and are kept. An empty table
    gives no rows; other columns are not read.

    1. Documents with equal sets become one class; copies are never compared again.
    2. Classes that share a rare retained value meet in the list of that value. In every list all members are
       held against one centre, the class whose values are the most frequent; verified links give components.
    3. Lists that still hold several components compare, in blocks of bounded size, the members outside the
       list's main component with all others: first by their shared values, which only marks the members that
       have a candidate, then the marked ones by wide sketches. Only pairs that these confirm leave a block, to
       be estimated and verified as in 2. Members of one component need no comparison.

    Linked pairs are lost only if their sketches share less than ``least_shared`` of the values, see there.
    """
    share, share_wide = least_shared(percent, KEEP), least_shared(percent, WIDE, LOSS_WIDE)
    drawn = saved(sketches(docs, id_col, text_col), "near-sketches")
    worded = drawn.where("n > 0 and doc_id is not null")
    sets_seen = saved(worded.groupBy("n", "one", "two").agg(F.min("doc_id").alias("least")), "near-classes")
    # The row of the smallest id carries the sketch; rows that repeat it are the same. The name of a class is not
    # its smallest id, since rows that share an id may have several sets.
    own = worded.join(sets_seen, ["n", "one", "two"]).where("doc_id = least").select("n", "one", "two", "least", "sketch").distinct()
    classes = saved(own.withColumn("cid", F.xxhash64("n", "one", "two")), "near-own")

    postings = saved(_postings(classes, share), "near-postings")
    lists = postings.select("cid", "weight", F.explode(F.slice("shared", F.lit(1), F.col("first"))).alias("value"))
    sizes = lists.groupBy("value").agg(F.count("*").alias("size"), F.max(F.struct("weight", "cid"))["cid"].alias("centre")).where("size > 1")
    shared = saved(lists.join(sizes, "value").select("value", "cid", "centre"), "near-lists")

    involved = shared.select("cid").distinct().join(classes.select("cid", "n", "one", "two", "least"), "cid")
    texts = docs.select(F.col(id_col).cast("long").alias("least"), text_of(text_col).alias("text")).join(involved, "least")

    def full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _in_parts(batches):
            prints = zip(*(part.column(c).to_pylist() for c in ("n", "one", "two")))
            found = [codes if (len(codes), *_print(codes)) == known else None for codes, known in zip(_shingles(part.column("text")), prints)]
            full = pa.array([None if c is None else c.tobytes() for c in found], pa.binary())
            wide = pa.array([None if c is None else np.sort(mix(c))[:WIDE].astype(np.uint32).tobytes() for c in found], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column("cid"), full, wide], ["cid", "codes", "wide"])

    sets = texts.select("cid", "n", "one", "two", "text").mapInArrow(full_sets, "cid long, codes binary, wide binary").where("codes is not null")
    stored = saved(sets.dropDuplicates(["cid"]), "near-sets")
    sets = stored.select("cid", "codes")

    spokes = shared.where("cid <> centre").select(F.least("cid", "centre").alias("a"), F.greatest("cid", "centre").alias("b")).distinct()
    links = saved(_verified(spokes, classes, sets, percent, share), "near-links")
    met = components(links, "near-met").withColumnsRenamed({"node": "cid", "root": "comp"})

    members = saved(shared.join(met, "cid", "left").select("value", "cid", F.coalesce("comp", "cid").alias("comp")), "near-members")
    by_comp = members.groupBy("value", "comp").agg(F.count("*").alias("in_comp"))
    main = by_comp.groupBy("value").agg(F.max(F.struct("in_comp", "comp")).alias("main"), F.count("*").alias("comps"), F.sum("in_comp").alias("size")).where("comps > 1")
    main = main.select("value", "size", F.col("main.comp").alias("main"), (F.col("size") - F.col("main.in_comp")).alias("rest"))
    facts = postings.select("cid", "k", "shared").join(classes.select("cid", "n"), "cid")
    open_lists = saved(members.join(main, "value").withColumn("outside", F.col("comp") != F.col("main")).drop("main"), "near-open")
    rest_blocks, all_blocks = F.expr(f"cast((rest - 1) div {BLOCK} as int)"), F.expr(f"cast((size - 1) div {BLOCK} as int)")
    place = F.xxhash64("cid")
    cols = ["value", "cid", "comp", "outside"]
    left = open_lists.where("outside").select(*cols, F.pmod(place, rest_blocks + 1).cast("int").alias("i"), F.explode(F.sequence(F.lit(0), all_blocks)).alias("j"))
    right = open_lists.select(*cols, F.explode(F.sequence(F.lit(0), rest_blocks)).alias("i"), F.pmod(place, all_blocks + 1).cast("int").alias("j"))
    key = ["value", "i", "j"]

    def grid(side: DataFrame, *more: DataFrame):
        for facts_ in (facts, *more):
            side = side.join(facts_, "cid")
        return side.toDF(*side.columns).groupBy(*key)

    def flag(x: pa.Table, y: pa.Table) -> pa.Table:
        """The members that have a candidate in this block; one row for each, whatever the number of pairs."""
        schema = pa.schema([("value", pa.int64()), ("i", pa.int32()), ("j", pa.int32()), ("cid", pa.int64()), ("comp", pa.int64()), ("outside", pa.bool_()), ("is_left", pa.bool_())])
        if not x.num_rows or not y.num_rows:
            return schema.empty_table()
        pairs = _candidates(x, y, percent, share)
        parts = []
        for side, some, is_left in ((x, pairs.any(axis=1), True), (y, pairs.any(axis=0), False)):
            chosen = side.filter(pa.array(some)).select(["value", "i", "j", "cid", "comp", "outside"])
            parts.append(chosen.append_column("is_left", pa.array([is_left] * chosen.num_rows, pa.bool_())).cast(schema))
        return pa.concat_tables(parts)

    def estimate(x: pa.Table, y: pa.Table) -> pa.Table:
        """The candidates of a block whose wide sketches agree, all of which are verified afterwards.

        Sketches keep half of each code. Codes of one set that agree in that half count once, so a set's count of
        such is added to what it may have in common.
        """
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        if not x.num_rows or not y.num_rows:
            return schema.empty_table()
        wide = [[np.frombuffer(v, np.uint32).astype(np.int64) for v in t["wide"].to_pylist()] for t in (x, y)]
        twice = [np.array([len(v) - len(np.unique(v)) for v in side]) for side in wide]
        common, nx, ny = _overlap(*[[np.unique(v) for v in side] for side in wide]) + np.add.outer(*twice), x["n"].to_numpy(), y["n"].to_numpy()
        exact = 100 * common >= percent * (nx[:, None] + ny[None, :] - common)
        likely = common >= _of(share_wide, np.minimum(np.minimum.outer(nx, ny), WIDE))
        at, to = np.nonzero(_candidates(x, y, percent, share) & np.where(np.maximum.outer(nx, ny) <= WIDE, exact, likely))
        a, b = x["cid"].to_numpy()[at], y["cid"].to_numpy()[to]
        return pa.table([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], schema=schema)

    flagged = grid(left).cogroup(grid(right)).applyInArrow(flag, "value long, i int, j int, cid long, comp long, outside boolean, is_left boolean")
    flagged = saved(flagged, "near-flagged")
    wide = stored.select("cid", "wide")
    sides = [flagged.where(F.col("is_left") == x).drop("is_left") for x in (True, False)]
    likely = grid(sides[0], wide).cogroup(grid(sides[1], wide)).applyInArrow(estimate, "a long, b long").distinct()
    more = saved(_verified(likely, classes, sets, percent, share), "near-links")

    ids = saved(drawn.join(classes.select("n", "one", "two", "cid", "least"), ["n", "one", "two"], "left").select("doc_id", "n", F.when(F.col("doc_id").isNotNull(), F.col("cid")).alias("cid")), "near-ids")
    several = ids.where("cid is not null").groupBy("doc_id").agg(F.min("cid").alias("b"), F.max("cid").alias("most")).where("b <> most").select("doc_id", "b")
    same_id = ids.join(several, "doc_id").where("cid is not null").select(F.col("cid").alias("a"), "b")
    roots = components(links.unionByName(more).unionByName(same_id), "near-roots").withColumnsRenamed({"node": "cid"})
    grouped = classes.select("cid", "least").join(roots, "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    smallest = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    known = grouped.join(smallest, "root").select("cid", "component_id")
    out = ids.join(known, "cid", "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), (F.col("doc_id").isNull() | (F.col("doc_id") == component)).alias("kept"))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` of which one stands for each component, with all their columns."""
    gone = near_duplicates(docs, id_col, text_col, percent).where("not kept").select(F.col("doc_id").alias("gone_id_")).distinct()
    return docs.join(gone, F.col(id_col) == F.col("gone_id_"), "left_anti")
