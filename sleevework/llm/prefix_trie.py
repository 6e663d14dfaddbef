"""The trie of the common beginnings of conversations: double arrays per prefix shard, shared upper nodes merged."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sleevework.llm.shared import WORD, ranked, saved, text_of

LEVELS = 256  # turns of a conversation that one layer of tries holds
SHARD_TURNS = 1 << 18  # turns of a shard, about; prefixes with more are told apart by longer prefixes
FREE, TOP = -2, -1  # in CHECK: no node, the start of a layer
CODE = ["c1", "c2"]
LOW = 0xFFFFFFFF


class DoubleArray:
    """States over dense labels: the child of ``s`` by ``label`` is cell BASE[s] + label, if CHECK there is ``s``."""

    TRIES = 32  # free cells that the least label of a family is tried on before the family goes behind all cells

    def __init__(self, tops: int) -> None:
        self.base = np.zeros(tops, np.int64)
        self.check = np.full(tops, TOP, np.int64)

    def _grow(self, cells: int) -> None:
        more = cells - len(self.check)
        if more > 0:
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
            self.check = np.concatenate([self.check, np.full(more, FREE, np.int64)])

    def add(self, states: np.ndarray, labels: np.ndarray) -> None:
        """Give each state its children. Pairs are distinct and in order; a state is given all its children at once."""
        parents, first, count = np.unique(states, return_index=True, return_counts=True)
        for parent, at, n in zip(parents[count > 1], first[count > 1], count[count > 1]):
            mine = labels[at : at + n]
            steps = mine - mine[0]
            self._grow(len(self.check) + 1)
            free = np.flatnonzero(self.check == FREE)[: self.TRIES] if n < 1000 else np.zeros(0, np.int64)
            spot = len(self.check)
            for cell in free.tolist():
                inside = cell + steps
                if (self.check[inside[inside < len(self.check)]] == FREE).all():
                    spot = cell
                    break
            self._grow(spot + int(steps[-1]) + 1)
            self.base[parent] = spot - mine[0]
            self.check[spot + steps] = parent
        single = count == 1
        free = np.flatnonzero(self.check == FREE)[: single.sum()]
        cells = np.concatenate([free, len(self.check) + np.arange(single.sum() - len(free))])
        if len(cells):
            self._grow(int(cells[-1]) + 1)
        self.base[parents[single]] = cells - labels[first[single]]
        self.check[cells] = parents[single]

    def step(self, states: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """The children of states by labels that they have."""
        cells = self.base[states] + labels
        if not (self.check[cells] == states).all():
            raise ValueError("a label without a child")
        return cells


NODE = [(n, pa.int64()) for n in ("depth", *CODE, "p1", "p2", "n_convs", "conv_id", "words", "n_children", "n_leaves", "saved", "parent_conv")]
KIND = [("kind", pa.string()), ("path1", pa.list_(pa.int64())), ("path2", pa.list_(pa.int64()))]
NODE_DDL = ", ".join([*(f"{n} long" for n, _ in NODE), "kind string", "path1 array<long>", "path2 array<long>"])


def _shard_nodes(table: pa.Table, levels: int) -> pa.Table:
    """The nodes of a shard's trie: ``own`` nodes that no other shard has, ``shared`` ones, and ``top`` ones (see ``trie``)."""
    schema = pa.schema([*NODE, *KIND])
    number = lambda c: table[c].combine_chunks().to_numpy(zero_copy_only=False)
    lists = {c: table[c].combine_chunks() for c in ("s1", "s2", "words")}
    flat = {c: x.flatten().to_numpy() for c, x in lists.items()}
    starts = lists["s1"].offsets.to_numpy()[:-1] - lists["s1"].offsets[0].as_py()
    lens = lists["s1"].value_lengths().to_numpy()
    _, labels = np.unique(np.stack([flat["s1"], flat["s2"]], 1), axis=0, return_inverse=True)  # dense turn ids
    labels = labels.ravel()
    tops, top_of = np.unique(np.stack([number("layer"), number("e1"), number("e2")], 1), axis=0, return_inverse=True)
    top_of = top_of.ravel()

    trie, state, by_level = DoubleArray(len(tops)), top_of.copy(), []
    for level in range(int(lens.max())):
        alive = np.flatnonzero(lens > level)
        now, label = state[alive], labels[starts[alive] + level]
        pairs = np.unique(np.stack([now, label], 1), axis=0)
        trie.add(pairs[:, 0], pairs[:, 1])
        state[alive] = trie.step(now, label)
        by_level.append((alive, state[alive]))

    cells = len(trie.check)
    zero = lambda: np.zeros(cells, np.int64)
    n_convs, words, layer, cut, depth, leaves, saved_, kids, own_kids = (zero() for _ in range(9))
    conv = np.full(cells, np.iinfo(np.int64).max)
    code = np.zeros((2, cells), np.uint64)
    layer[: len(tops)], code[0, : len(tops)], code[1, : len(tops)] = tops[:, 0], tops[:, 1].astype(np.uint64), tops[:, 2].astype(np.uint64)
    runs_n, runs_conv, runs_cut = number("n"), number("conv_id"), number("cut")
    nodes = []
    for level, (alive, cell) in enumerate(by_level):
        parent, at = trie.check[cell], starts[alive] + level
        np.add.at(n_convs, cell, runs_n[alive])
        np.minimum.at(conv, cell, runs_conv[alive])
        words[cell], cut[cell], depth[cell], layer[cell] = flat["words"][at], runs_cut[alive], level + 1, layer[parent]
        for i, s in enumerate(("s1", "s2")):
            code[i, cell] = code[i, parent] + flat[s][at].astype(np.uint64)
        nodes.append(np.unique(cell))
    own = depth >= cut
    for cell in reversed(nodes):
        np.add.at(kids, trie.check[cell], 1)
        np.add.at(own_kids, trie.check[cell], own[cell])
        leaves[cell] += own[cell] & (kids[cell] == 0) & (depth[cell] < levels)
        saved_[cell] += np.where(own[cell], (n_convs[cell] - 1) * words[cell], 0)
        np.add.at(leaves, trie.check[cell], leaves[cell])
        np.add.at(saved_, trie.check[cell], saved_[cell])

    top_cells = np.arange(len(tops))
    every = np.concatenate([top_cells, *nodes])
    parent = np.where(depth[every] > 0, trie.check[every], every)
    is_top = depth[every] == 0
    told = own & (depth > 0)
    signed = code.view(np.int64)
    ups: list[np.ndarray] = []  # the cells above and including each one that needs its path
    wants = ~is_top & (~own[every] | (depth[every] == levels))
    for cell in every[wants].tolist():
        up = [cell]
        while trie.check[up[-1]] != TOP:
            up.append(int(trie.check[up[-1]]))
        ups.append(np.array(up[::-1], np.int64))
    sizes = np.zeros(len(every), np.int64)
    sizes[wants] = [len(u) for u in ups]
    joined = np.concatenate(ups) if ups else np.zeros(0, np.int64)
    paths = [pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(signed[i, joined])) for i in (0, 1)]
    hide = lambda values, mask: pa.array(values, mask=mask)
    columns = [
        pa.array(layer[every] * levels + depth[every]), pa.array(signed[0, every]), pa.array(signed[1, every]),
        hide(signed[0, parent], is_top), hide(signed[1, parent], is_top), pa.array(n_convs[every]), hide(conv[every], is_top), pa.array(words[every]),
        pa.array(np.where(own[every] & ~is_top, kids[every], own_kids[every])), pa.array(leaves[every]), pa.array(saved_[every]), hide(conv[parent], is_top | ~told[parent]),
        pa.array(np.where(is_top, "top", np.where(own[every], "own", "shared"))), *paths,
    ]
    return pa.table(columns, schema=schema)


def _code(high: Column, low: Column) -> Column:
    """A sum modulo 2**64 out of the sums of the upper and of the lower halves."""
    return F.shiftleft(F.pmod(high + F.shiftright(low, 32), F.lit(LOW + 1)), 32).bitwiseOR(low.bitwiseAND(F.lit(LOW)))


def _runs(turns: DataFrame, levels: int) -> DataFrame:
    """(conv_id, layer, s1, s2, words: arrays by turn; e1, e2, x1, x2: codes of what is before and up to the end; ends)."""
    spread = turns.select("conv_id", "place", F.expr(f"place div {levels}").alias("layer"), *[F.xxhash64(F.lit(i), "place", "key").alias(f"s{i}") for i in (1, 2)], "words")
    halves = [f(F.col(f"s{i}")).alias(f"{half}{i}") for i in (1, 2) for half, f in (("h", lambda c: F.sum(F.shiftrightunsigned(c, 32))), ("l", lambda c: F.sum(c.bitwiseAND(F.lit(LOW)))))]
    held = spread.groupBy("conv_id", "layer").agg(F.sort_array(F.collect_list(F.struct("place", "s1", "s2", "words"))).alias("steps"), *halves)
    along = Window.partitionBy("conv_id").orderBy("layer")
    before, upto = along.rowsBetween(Window.unboundedPreceding, -1), along.rowsBetween(Window.unboundedPreceding, 0)
    codes = [_code(*(F.coalesce(F.sum(f"{half}{i}").over(w), F.lit(0)) for half in "hl")).alias(f"{name}{i}") for i in (1, 2) for name, w in (("e", before), ("x", upto))]
    return held.select("conv_id", "layer", *[F.col(f"steps.{c}").alias(c) for c in ("s1", "s2", "words")], *codes, F.lead("layer").over(along).isNull().alias("ends"))


def _sharded(runs: DataFrame, levels: int, shard_turns: int) -> DataFrame:
    """Each different run once, with the conversations that have it, its shard, and from which level on it is that shard's own."""
    name = ["layer", "e1", "e2", "x1", "x2"]
    counted = runs.groupBy(*name).agg(F.count("*").alias("n"), F.min("conv_id").alias("conv_id"))
    distinct = saved(counted.join(runs.select("conv_id", "layer", "s1", "s2", "words"), ["conv_id", "layer"]), "trie-runs")
    powers = F.array(*[F.lit(1 << i) for i in range(levels.bit_length() + 1)])
    size = F.size("s1")
    prefixes = F.transform(F.filter(powers, lambda u: u <= 2 * size), lambda u: F.struct(u.alias("cut"), F.xxhash64("layer", "e1", "e2", F.slice("s1", F.lit(1), u), F.slice("s2", F.lit(1), u)).alias("prefix")))
    tried = saved(distinct.select("layer", "x1", "x2", size.alias("size"), F.explode(prefixes).alias("p")).select("layer", "x1", "x2", "size", "p.*"), "trie-prefixes")
    heavy = saved(tried.groupBy("cut", "prefix").agg(F.sum("size").alias("turns")).where(F.col("turns") > shard_turns), "trie-heavy")
    light = tried.join(heavy, ["cut", "prefix"], "left").where(F.col("turns").isNull() | (F.col("cut") > F.col("size")))  # a run beyond its end is alone
    chosen = light.groupBy("layer", "x1", "x2").agg(F.min(F.struct("cut", "prefix")).alias("p"))
    shards = max(1, -(-int(distinct.agg(F.sum(F.size("s1").cast("long"))).first()[0] or 0) // shard_turns))
    return distinct.join(chosen, ["layer", "x1", "x2"]).select(*distinct.columns, F.col("p.cut").cast("long").alias("cut"), F.pmod(F.xxhash64("p.prefix", F.lit(7)), F.lit(shards)).alias("shard"))


def _ends_hashes(ends: DataFrame) -> DataFrame:
    """(c1, c2, ends_sha256): the hash of the ascending ids that end at a node, joined by commas.

    Ids are sorted over all tasks and joined to strings where they lie; one stream per node then hashes the strings.
    """

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            c1, c2, ids = (batch.column(i).to_numpy() for i in range(3))
            starts = np.flatnonzero(np.concatenate([[True], (c1[1:] != c1[:-1]) | (c2[1:] != c2[:-1])]))
            stops = np.append(starts[1:], len(c1))
            text = [",".join(map(str, ids[a:b].tolist())) for a, b in zip(starts, stops)]
            yield pa.RecordBatch.from_arrays([pa.array(c1[starts]), pa.array(c2[starts]), pa.array(ids[starts]), pa.array(text, pa.string())], [*CODE, "least", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, running = None, None
        made = lambda rows: pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.string())], [*CODE, "ends_sha256"])
        for batch in batches:
            done = []
            for c1, c2, ids in zip(*(batch.column(c).to_pylist() for c in (*CODE, "ids"))):
                if (c1, c2) == key:
                    running.update(b",")
                else:
                    if key is not None:
                        done.append((*key, running.hexdigest()))
                    key, running = (c1, c2), hashlib.sha256()
                running.update(ids.encode())
            yield made(done)
        if key is not None:
            yield made([(*key, running.hexdigest())])

    order = [*CODE, "conv_id"]
    joined = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(join, "c1 long, c2 long, least long, ids string")
    return joined.repartition(*CODE).sortWithinPartitions(*CODE, "least").mapInArrow(digest, "c1 long, c2 long, ends_sha256 string")


def _totals(tops: DataFrame, layers: int) -> DataFrame:
    """(c1, c2, leaves, saved) of the starts of layers with all that is in deeper layers, by doubling the way up.

    ``tops`` has (c1, c2, u1, u2: the start of the layer above, leaves, saved).
    """
    now, reach = tops, 1
    while reach <= layers:
        up = now.where(F.col("u1").isNotNull())
        below = up.groupBy(F.col("u1").alias("c1"), F.col("u2").alias("c2")).agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        far = now.select(F.col("c1").alias("u1"), F.col("c2").alias("u2"), F.col("u1").alias("w1"), F.col("u2").alias("w2"))
        joined = now.join(below, CODE, "left").join(far, ["u1", "u2"], "left")
        plus = lambda c: (F.col(c) + F.coalesce(f"more_{c}", F.lit(0))).alias(c)
        now, reach = saved(joined.select(*CODE, F.col("w1").alias("u1"), F.col("w2").alias("u2"), plus("leaves"), plus("saved")), "trie-totals"), 2 * reach
    return now.select(*CODE, "leaves", "saved")


def trie(turns: DataFrame, members: DataFrame, levels: int = LEVELS, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256), one row per node.

    ``turns`` has (conv_id, place: 0 on, without gaps, key: what makes turns equal, words), ``members`` every conv_id
    once, those without turns too. A node is a sequence of first turns of some member; ``conv_id`` is the smallest
    member that begins so, ``n_convs`` how many do, ``n_leaves`` the childless nodes of its subtree, ``saved_tokens``
    the words that the subtree's nodes share: (n_convs - 1) times those of the node's last turn.
    ``ends_sha256`` names the members that end at the node. Without members there are no rows.

    1. Conversations are cut into runs of ``levels`` turns, so no task holds a whole conversation. A code of 128 bits
       of all turns before a run, a sum of hashes by place, tells which runs begin at the same node. Equal runs become one
       with a count, so copies, however many, are one row from here on.
    2. A shard holds the runs that share a prefix; a prefix with more than ``shard_turns`` turns gives way to the
       prefixes twice as long below it. Each shard packs a double array over its dense turn ids and walks it for
       its nodes and, from the deepest on, for the sums of subtrees.
    3. Nodes above the prefix of a shard are shared with other shards. What the shards found there is added up, and each
       adds itself to the shared nodes above it.
    4. Layers are linked through the node where one ends and the next begins: totals go up by doubling, then to
       the nodes of the run above.
    """
    runs = saved(_runs(turns, levels), "trie-all-runs")
    found = saved(
        _sharded(runs, levels, shard_turns).groupBy("shard").applyInArrow(lambda t: _shard_nodes(t, levels), NODE_DDL), "trie-nodes"
    )
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")]
    shared = found.where("kind = 'shared'").groupBy("depth", *CODE, "p1", "p2").agg(*sums, F.min("conv_id").alias("conv_id"), F.max("words").alias("words"), F.max("path1").alias("path1"), F.max("path2").alias("path2"))
    shared = saved(shared, "trie-shared")
    kids = saved(shared.groupBy(F.col("p1").alias("c1"), F.col("p2").alias("c2")).agg(F.count("*").alias("kids")), "trie-kids")
    plus = lambda a, b: F.col(a) + F.coalesce(b, F.lit(0))
    shared = shared.join(kids, CODE, "left").withColumn("n_children", plus("n_children", "kids")).drop("kids")
    worth = [((F.col("n_convs") - 1) * F.col("words")).alias("worth"), ((F.col("n_children") == 0) & (F.col("depth") % levels != 0)).cast("long").alias("leaf")]
    upward = shared.select(*worth, F.explode(F.arrays_zip("path1", "path2")).alias("p"))
    gained = saved(upward.groupBy(F.col("p.path1").alias("c1"), F.col("p.path2").alias("c2")).agg(F.sum("worth").alias("add_saved"), F.sum("leaf").alias("add_leaves")), "trie-gained")
    gain = lambda df: df.join(gained, CODE, "left").withColumn("saved", plus("saved", "add_saved")).withColumn("n_leaves", plus("n_leaves", "add_leaves")).drop("add_saved", "add_leaves")
    shared = gain(shared)
    tops = found.where("kind = 'top'").groupBy("depth", *CODE).agg(*sums[1:]).join(kids, CODE, "left").withColumn("n_children", plus("n_children", "kids")).drop("kids")
    tops = saved(gain(tops), "trie-tops")

    whole = members.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")).first()
    spark = members.sparkSession
    start = spark.createDataFrame([(0, 0, 0, whole["n_convs"], whole["conv_id"])] if whole["n_convs"] else [], "depth long, c1 long, c2 long, n_convs long, conv_id long")
    first = tops.where("depth = 0").select(*CODE, "n_children", "n_leaves", "saved")
    root = start.join(first, CODE, "left").select("depth", *CODE, F.lit(None).cast("long").alias("p1"), F.lit(None).cast("long").alias("p2"), "n_convs", "conv_id", F.coalesce("n_children", F.lit(0)).alias("n_children"), F.coalesce("n_leaves", F.lit(1)).alias("n_leaves"), F.coalesce("saved", F.lit(0)).alias("saved"), F.lit(None).cast("long").alias("parent_conv"))

    columns = ["depth", *CODE, "p1", "p2", "n_convs", "conv_id", "n_children", "n_leaves", "saved", "parent_conv"]
    nodes = found.where("kind = 'own'").select(*columns).unionByName(shared.withColumn("parent_conv", F.lit(None).cast("long")).select(*columns))
    ended = saved(found.where((F.col("depth") % levels == 0) & (F.col("depth") > 0) & (F.col("kind") != "top")).groupBy(*CODE).agg(F.max("path1").alias("path1"), F.max("path2").alias("path2")), "trie-ended")
    layers = found.agg(F.max("depth")).first()[0] or 0
    if layers >= levels:  # some conversation goes on to the end of a layer
        below = tops.where("depth > 0").select(*CODE, "n_children", F.col("n_leaves").alias("leaves"), "saved")
        links = ended.select(*CODE, F.get("path1", F.lit(0)).alias("u1"), F.get("path2", F.lit(0)).alias("u2")).join(below, CODE, "left")
        links = saved(links.withColumn("leaves", F.coalesce("leaves", F.lit(1))).withColumn("saved", F.coalesce("saved", F.lit(0))), "trie-links")
        start_of_all = root.select(*CODE, F.lit(None).cast("long").alias("u1"), F.lit(None).cast("long").alias("u2"), F.col("n_leaves").alias("leaves"), "saved")
        totals = saved(_totals(links.select(*CODE, "u1", "u2", "leaves", "saved").unionByName(start_of_all), layers // levels + 1), "trie-sums")
        passed = ended.join(totals, CODE).select("leaves", "saved", F.explode(F.slice(F.arrays_zip("path1", "path2"), 2, levels)).alias("p"))
        handed = passed.groupBy(F.col("p.path1").alias("c1"), F.col("p.path2").alias("c2")).agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        grown = links.select(*CODE, F.col("n_children").alias("grown"))
        nodes = nodes.join(handed, CODE, "left").join(grown, CODE, "left")
        nodes = nodes.withColumn("n_leaves", plus("n_leaves", "more_leaves")).withColumn("saved", plus("saved", "more_saved")).withColumn("n_children", plus("n_children", "grown")).select(*columns)
        root = root.drop("n_leaves", "saved").join(totals.withColumnRenamed("leaves", "n_leaves"), CODE).select(*columns)
    nodes = saved(nodes.unionByName(root), "trie-all")

    last = runs.where("ends").select("conv_id", F.col("x1").alias("c1"), F.col("x2").alias("c2"))
    silent = members.join(runs.where("layer = 0").select("conv_id"), "conv_id", "left_anti").select("conv_id", F.lit(0).cast("long").alias("c1"), F.lit(0).cast("long").alias("c2"))
    hashes = _ends_hashes(saved(last.unionByName(silent), "trie-ends"))
    above = nodes.where("depth > 0 and parent_conv is null").select(*CODE, "p1", "p2")
    parents = saved(nodes.join(above.select(F.col("p1").alias("c1"), F.col("p2").alias("c2")).distinct(), CODE).select(F.col("c1").alias("p1"), F.col("c2").alias("p2"), F.col("conv_id").alias("above_id")), "trie-parents")
    named = nodes.join(hashes, CODE, "left").join(parents, ["p1", "p2"], "left")
    return named.select(
        "conv_id", "depth", F.coalesce("parent_conv", "above_id").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def rebuilt(conversations: DataFrame, family: int = 20, most: int = 4, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(turns, members) as ``trie`` reads them, of conversations that begin like the first of their family.

    The turns of a conversation are ordered by ``turn``, null first, then by a hash of role and text. Conversation c
    takes its first h = crc32(c) mod ``most`` turns from conversation c - c mod ``family`` (all, if that has fewer; none, if it
    does not exist) and what follows its own first h. Null role or text is empty; rows without a conv_id are left
    out; repeated rows are turns of their own; other columns are not read.
    """
    role, text = text_of(role_col), text_of(text_col)
    key = F.unhex(F.sha2(F.encode(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), "UTF-8"), 256))
    own = conversations.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), key.alias("key"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    placed = saved(ranked(own, ["conv_id"], ["turn", "key"], "place"), "trie-turns")
    taken = F.pmod(F.crc32(F.encode(F.col("conv_id").cast("string"), "UTF-8")), F.lit(most))
    base = F.col("conv_id") - F.col("conv_id") % family
    heads = placed.where((F.col("place") < most - 1) & (base == F.col("conv_id"))).groupBy(F.col("conv_id").alias("base")).agg(F.sort_array(F.collect_list(F.struct("place", "key", "words"))).alias("head"))
    every = placed.groupBy("conv_id").agg(F.count("*").alias("n")).withColumn("base", base)
    head = F.coalesce(F.slice("head", F.lit(1), taken.cast("int")), F.slice(F.col("head"), F.lit(1), F.lit(0)))
    members = saved(every.join(heads, "base", "left").select("conv_id", taken.alias("taken"), head.alias("head")), "trie-members")
    size = F.when(F.col("head").isNull(), 0).otherwise(F.size("head"))
    shift = members.select("conv_id", "taken", size.alias("kept"))
    later = placed.join(shift, "conv_id").where(F.col("place") >= F.col("taken")).select("conv_id", (F.col("place") - F.col("taken") + F.col("kept")).cast("long").alias("place"), "key", "words")
    given = members.select("conv_id", F.explode("head").alias("t")).select("conv_id", F.col("t.place").cast("long").alias("place"), "t.key", "t.words")
    return later.unionByName(given), members.select("conv_id")
