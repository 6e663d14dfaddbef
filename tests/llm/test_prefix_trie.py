"""The prefix trie against a plain dictionary of prefixes, over layers and shards of any size."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import types as T

from sleevework.llm import prefix_trie
from sleevework.llm.queries import QUERIES

SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType()), T.StructField("depth", T.StringType()), T.StructField("place", T.StringType()), T.StructField("words", T.StringType())])
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def rows(seed: int) -> list[tuple]:
    draw = random.Random(seed)
    texts = ["", None, "one", "two words", "x  y\nz", "q" * 2000, "é è"]
    out = []
    for conv in range(-21, 70):
        if conv in (0, 40):
            continue
        for turn in range(draw.choice((1, 2, 3, 3, 5, 9))):
            out.append((conv, turn, ("user", "assistant", None)[turn % 3], draw.choice(texts)))
    out += [(20, t, "user", texts[t % 7]) for t in range(300, 420)]
    for conv in range(100, 160):  # one opening and many copies
        out += [(conv, 0, "system", "the same opening"), (conv, 1, "user", "the same question"), (conv, 2, "user", "more"), (conv, 3, "user", "yet more")]
        if conv % 3 == 0:
            out += [(conv, t, "user", texts[(t * conv) % 5]) for t in range(4, 11)]
    out += [(33, None, "user", "no turn number"), (33, 1, "user", "a turn twice"), (33, 1, "user", "a turn twice"), (None, 0, "user", "no id"), (2**62, 0, "user", "far"), (-(2**62), 0, "user", "far")]
    out += [(300, 0, "u", "ser"), (301, 0, "us", "er"), (302, None, None, None)]
    draw.shuffle(out)
    return [(*r, "d", "p", "w") for r in out]


def crc(n: int) -> int:
    return zlib.crc32(str(n).encode())


def plain(table: list[tuple]) -> list[tuple]:
    own = defaultdict(list)
    for conv, turn, role, text, *_ in table:
        if conv is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own[conv].append((turn is not None, turn or 0, key, (role, text)))
    turns = {c: [x[3] for x in sorted(v)] for c, v in own.items()}
    whole = {}
    for c in turns:
        base = c - int(np.fix(c / 20)) * 0 - (abs(c) % 20) * (1 if c >= 0 else -1)
        whole[c] = tuple(turns.get(base, [])[: crc(c) % 4] + turns[c][crc(c) % 4 :])
    members = defaultdict(list)
    for c, path in whole.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    kids, leaves, kept = Counter(), Counter(), Counter()
    for node in members:
        if node:
            kids[node[:-1]] += 1
    for node, convs in members.items():
        worth = (len(convs) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += kids[node] == 0
            kept[node[:d]] += worth
    sha = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return [
        (min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), kids[node], leaves[node], kept[node], sha(c for c in convs if whole[c] == node))
        for node, convs in members.items()
    ]


@pytest.mark.parametrize("levels, shard_turns", [(256, 1 << 18), (4, 1 << 18), (8, 60), (2, 12), (256, 40)])
def test_trie(spark, levels, shard_turns):
    table = rows(levels)
    turns, members = prefix_trie.rebuilt(spark.createDataFrame(table, SCHEMA).repartition(5))
    out = prefix_trie.trie(turns, members, levels, shard_turns).collect()
    assert sorted((tuple(r[c] for c in COLUMNS) for r in out), key=repr) == sorted(plain(table), key=repr)


def test_registered_query_and_small_tables(spark, tmp_path):
    for n, table in enumerate((rows(1), [], [(1, 0, "user", "a b", "", "", "")], [(1, 0, "user", "a b", "", "", ""), (20, 0, "u", "x", "", "", "")])):
        folder = tmp_path / str(n)
        spark.createDataFrame(table, SCHEMA).write.parquet(str(folder / "conversations.parquet"))
        out = QUERIES["op11_prefix_trie"](spark, str(folder))
        assert out.columns == list(COLUMNS)
        assert sorted(map(tuple, out.collect()), key=repr) == sorted(plain(table), key=repr)


def test_members_without_turns(spark):
    turns = spark.createDataFrame([], "conv_id long, place long, key binary, words long")
    out = prefix_trie.trie(turns, spark.createDataFrame([(5,), (-3,)], "conv_id long")).collect()
    assert list(map(tuple, out)) == [(-3, 0, None, 2, 0, 1, 0, hashlib.sha256(b"-3,5").hexdigest())]


def test_double_array_keeps_families_apart():
    draw = np.random.default_rng(3)
    trie, want, states = prefix_trie.DoubleArray(3), {}, np.arange(3)
    for _ in range(6):
        pairs = np.unique(np.stack([np.repeat(states, 5), draw.integers(0, 2000, 5 * len(states))], 1)[draw.random(5 * len(states)) < 0.3], axis=0)
        if not len(pairs):
            break
        trie.add(pairs[:, 0], pairs[:, 1])
        cells = trie.step(pairs[:, 0], pairs[:, 1])
        assert len(set(cells.tolist())) == len(cells) and not set(cells.tolist()) & set(want)
        want.update(zip(cells.tolist(), pairs[:, 0].tolist()))
        states = cells
    assert all(trie.check[cell] == parent for cell, parent in want.items())
    with pytest.raises(ValueError):
        trie.step(np.array([0]), np.array([min(set(range(len(trie.check))) - {c for c, p in want.items() if p == 0})]) - trie.base[0])
