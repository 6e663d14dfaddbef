"""Every corpus operator against a plain computation, and on awkward rows."""

from __future__ import annotations

import hashlib
import json
import math
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from sleevework.llm import backoff_lm, buckets, exact_dedup, minhash_dedup, mixing, packing, rule_quality, sharding, shared, substring_dedup, tool_calls, topk
from sleevework.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("source", T.StringType()), T.StructField("rank", T.StringType()), T.StructField("size", T.StringType()), T.StructField("n", T.IntegerType())])


def prose(seed: int, words: int) -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choice(("ba", "re", "ti", "no", "Ku", "sé")) for _ in range(draw.randint(1, 4))) for _ in range(words))


def awkward() -> list[tuple]:
    base = prose(1, 120)
    words = base.split()
    texts = [
        base, base, "  " + base.replace(" ", "\n", 3) + "\t", " ".join(words[:60] + ["neu"] + words[61:]), " ".join(words[:118]),
        prose(2, 90) + " " + " ".join(words[20:50]) + " " + prose(3, 30), None, "", " \n ", "a", "A b", "a b", "one two three four five", "One two three four five",
        prose(4, 4000), "x" * 30000, "<|endoftext|> it's 12  34　z  \n\n q é è à", prose(5, 40), prose(5, 40).upper(), "word " * 200,
    ]
    rows = [(i, t, ("s1", "s2", None)[i % 3], "r", "s", i) for i, t in enumerate(texts)]
    rows += [(3, texts[3], "s1", None, None, None), (None, base, None, None, None, None), (None, "loose text", "s2", "", "", 0), (17, "another text for a known id", "s2", "", "", 0)]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(awkward(), SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def test_exact_groups(docs, empty):
    groups: dict[str, list] = {}
    for doc, text, *_ in awkward():
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((-len(text or ""), doc is None, doc))
    want = []
    for bare, members in groups.items():
        best = min(members, key=lambda m: (m[0], m[1], m[2] or 0))
        want += [(m[2], best[2], len(members), m == best, hashlib.sha256(bare.encode()).hexdigest()) for m in members]
    got = rows_of(exact_dedup.exact_groups(docs), "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert got == sorted(want, key=repr)
    assert exact_dedup.exact_groups(empty).count() == 0
    stay = exact_dedup.exact_dedup(docs)
    assert stay.columns == docs.columns and stay.count() == len(groups)


def test_exact_groups_tell_hash_collisions_apart(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup.F, "md5", lambda c: F.lit("same"))
    docs = spark.createDataFrame([(1, "a a"), (2, "aa"), (3, "b"), (4, "b "), (5, "c")], "doc_id long, text string")
    assert rows_of(exact_dedup.exact_groups(docs), "doc_id", "keep_id", "group_size") == [(1, 1, 2), (2, 1, 2), (3, 4, 2), (4, 4, 2), (5, 5, 1)]


def test_substrings(docs, empty):
    by_id: dict = {}
    for doc, text, *_ in awkward():
        by_id.setdefault(-1 if doc is None else doc, []).append(text or "")
    seen, want = set(), []
    for doc in sorted(by_id):
        for text in sorted(by_id[doc], key=str.encode):
            words, gone = WORD.findall(text), set()
            for i in range(len(words) - 19):
                key = tuple(words[i : i + 20])
                if key in seen:
                    gone.update(range(i, i + 20))
                seen.add(key)
            kept = " ".join(w for i, w in enumerate(words) if i not in gone)
            want.append((None if doc < 0 else doc, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    assert rows_of(substring_dedup.repeated_words(docs), "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(want, key=repr)
    assert substring_dedup.repeated_words(empty).count() == 0


def test_substrings_over_many_buckets(docs, monkeypatch):
    one = rows_of(substring_dedup.repeated_words(docs), "doc_id", "n_removed", "kept_sha256")
    monkeypatch.setattr(substring_dedup, "BUCKET_BYTES", 4000)
    assert rows_of(substring_dedup.repeated_words(docs), "doc_id", "n_removed", "kept_sha256") == one


def test_shards(docs, empty):
    out = sharding.shard(docs, 4).collect()
    assert len(out) == len(awkward()) and {r["law"] for r in out} == {"bytes"}
    want = sorted((len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for _, t, *_ in awkward())
    assert sorted((r["size"], r["text_crc32"]) for r in out) == want
    for shard in {r["shard"] for r in out}:
        assert sorted(r["slot"] for r in out if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in out)))
    homes: dict = {}
    for r in out:
        homes.setdefault((r["size"], r["text_crc32"]), set()).add(r["shard"])
    assert all(len(h) == 1 for h in homes.values())
    assert sharding.shard(empty, 4).count() == 0


@pytest.mark.parametrize("lots", [1, 1000])
def test_a_group_beyond_a_fair_share_has_a_shard_of_its_own(spark, lots):
    docs = spark.range(1000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 400, "same").otherwise(F.concat(F.lit("t"), "id")).alias("text"))
    sums, home = Counter(), set()
    for r in sharding.shard(docs, 10, lots=lots).collect():
        sums[r["shard"]] += r["size"]
        home |= {r["shard"]} if r["text_crc32"] == zlib.crc32(b"same") else set()
    assert set(sums) == set(range(10)) and len(home) == 1 and sums.pop(home.pop()) == 400 * 20
    if lots == 1000:
        assert sorted(sums.values()) == [64 * 20, *[67 * 20] * 8], "the least capacity for 600 rows in nine shards is 67 rows"
    assert sum(sums.values()) == sum(len(f"t{i}") + 16 for i in range(400, 1000))


def test_huge_items_have_bins_of_their_own():
    sizes = [(1000, 2), (300, 1), (7, 40), (3, 50), (1, 10)]
    loads, items = Counter(), Counter()
    for at, n, number in sharding.near_equal(sizes, 9):
        loads[number] += n * sizes[at][0]
        items[at] += n
    assert [items[i] for i in range(len(sizes))] == [n for _, n in sizes]
    assert sorted(loads.values())[-3:] == [300, 1000, 1000] and max(sorted(loads.values())[:-3]) - min(loads.values()) <= 7 and len(loads) == 9
    assert sharding.near_equal([(5, 1)], 4) == [(0, 1, 0)] and sharding.near_equal([], 4) == []
    assert sorted(number for _, _, number in sharding.near_equal([(5, 3)], 3)) == [0, 1, 2]


def test_best_fit_takes_the_tightest_bin():
    bins = sharding.OpenBins()
    for number, left in enumerate((7, 3, 9, 3, 5)):
        bins.add(left, number)
    assert [bins.take(4), bins.take(3), bins.take(3), bins.take(10), bins.take(1), bins.take(1), bins.take(1)] == [(5, 4), (3, 1), (3, 3), None, (7, 0), (9, 2), None]
    sizes = [(random.Random(i).randint(1, 50), 1 + i % 3) for i in range(60)]
    sizes = list({s: n for s, n in sizes}.items())
    plain, runs = [], sharding.best_fit_decreasing(sizes, 60)
    for size, n in sorted(sizes, reverse=True):
        for _ in range(n):
            fit = [i for i, left in enumerate(plain) if left >= size]
            at = min(fit, key=lambda i: (plain[i], i)) if fit else len(plain)
            plain = plain if fit else [*plain, 60]
            plain[at] -= size
    loads = Counter()
    for at, n, number in runs:
        loads[number] += n * sizes[at][0]
    assert sorted(60 - x for x in plain) == sorted(loads.values())


def test_budget_fit_is_exact_where_it_can_be():
    draw = np.random.default_rng(3)
    for _ in range(40):
        lengths = np.unique(draw.integers(1, 60, 8))
        counts = draw.integers(1, 6, len(lengths))
        budget = int(draw.integers(0, (lengths * counts).sum() + 5))
        reach = {0}
        for length, n in zip(lengths.tolist(), counts.tolist()):
            reach = {r + k * length for r in reach for k in range(n + 1)}
        take = mixing.fit_budget(lengths, counts, budget)
        assert (take <= counts).all() and (take >= 0).all()
        got, best = int((take * lengths).sum()), max(r for r in reach if r <= budget)
        assert got <= best and best - got <= lengths.max()


def test_a_mix_is_a_sample_of_all_lengths():
    lengths, counts = np.arange(1, 4001), np.ones(4000, np.int64)
    take = mixing.fit_budget(lengths, counts, int(lengths.sum()) // 2)
    assert int((take * lengths).sum()) == int(lengths.sum()) // 2
    shares = take.reshape(4, 1000).mean(1)
    assert shares.max() - shares.min() < 0.05
    draw = np.random.default_rng(8)
    for widest in (30, 3000, 400_000):
        for _ in range(20):
            lengths = np.unique(draw.integers(0, widest, 60))
            counts = draw.integers(1, 300, len(lengths))
            budget = int(draw.integers(0, (lengths * counts).sum() + 1))
            take = mixing.fit_budget(lengths, counts, budget)
            assert (take >= 0).all() and (take <= counts).all() and 0 <= budget - int((take * lengths).sum()) <= lengths.max()


def water_fill(sizes: dict, share: float = 1.5, most: float = 2.0) -> dict:
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    left, open_, out = share * sum(sizes.values()), set(sizes), {}
    while open_:
        rate = left / sum(weights[s] for s in open_)
        over = [s for s in open_ if rate * weights[s] > most * sizes[s]]
        if not over:
            out.update({s: rate * weights[s] for s in open_})
            break
        for s in over:
            out[s] = most * sizes[s]
            left -= out[s]
            open_.discard(s)
    return out


def test_mix(docs, empty):
    out = mixing.mix(docs).collect()
    sizes: dict = {}
    for _, text, source, *_ in awkward():
        sizes[source] = sizes.get(source, 0) + len(WORD.findall(text or ""))
    goal, taken = water_fill(sizes), Counter()
    assert len(out) == len(awkward())
    for r in out:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(goal[r["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    longest = max(len(WORD.findall(t or "")) for _, t, *_ in awkward())
    assert all(abs(taken[s] - goal[s]) <= longest for s in sizes)
    again = mixing.mix(docs.repartition(3))
    assert rows_of(again, "doc_id", "size", "taken") == rows_of(mixing.mix(docs), "doc_id", "size", "taken")
    assert mixing.mix(empty).count() == 0
    copies = mixing.mixed(docs)
    assert copies.columns == docs.columns
    assert copies.agg(F.sum(F.regexp_count("text", F.lit(shared.WORD)))).first()[0] == sum(taken.values())


def test_near_duplicates(docs, empty, spark):
    rows = awkward()
    base = prose(9, 200).split()
    for i in range(60):  # a family around one text, and pairs near the threshold
        words = list(base)
        for k in range(i % 7):
            words[(17 * i + 23 * k) % 200] = f"w{i}x{k}"
        rows.append((100 + i, " ".join(words), "s", "", "", 0))
    sets: dict = {}
    for at, (doc, text, *_) in enumerate(rows):
        words = WORD.findall((text or "").translate(LOWER))
        sets[at] = frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])
    ids = {at: r[0] for at, r in enumerate(rows)}
    comp = {d: d for d in ids.values() if d is not None}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for a in sets:
        for b in range(a):
            if ids[a] is None or ids[b] is None or not sets[a] or not sets[b]:
                continue
            if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = find(ids[a]), find(ids[b])
                comp[max(x, y)] = min(x, y)
    want = [(ids[a], len(sets[a]), None if ids[a] is None else find(ids[a]), ids[a] is None or find(ids[a]) == ids[a]) for a in sets]
    got = rows_of(minhash_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA)), "doc_id", "n_shingles", "component_id", "kept")
    assert got == sorted(want, key=repr)
    assert minhash_dedup.near_duplicates(empty).count() == 0
    assert minhash_dedup.near_dedup(docs).columns == docs.columns


def test_near_duplicates_between_the_thresholds(spark):
    rows, shares = [], []
    for pair, n in enumerate((100, 200, 300, 400, 600, 1000) * 3):  # some within a sketch, some beyond the wide one
        words = prose(500 + pair, n).split()
        changed = list(words)
        least = 0.83 if pair < 12 else 0.79  # the last third stays apart
        for k in range(n):
            shingles = [{tuple(w[i : i + 5]) for i in range(n - 4)} for w in ([x.translate(LOWER) for x in words], [x.translate(LOWER) for x in changed])]
            share = len(shingles[0] & shingles[1]) / len(shingles[0] | shingles[1])
            if share <= least:
                break
            changed[(k * 11 + 3) % n] = f"w{pair}x{k}"
        shares.append(share)
        rows += [(2 * pair, " ".join(words), "s", "", "", 0), (2 * pair + 1, " ".join(changed), "s", "", "", 0)]
    assert all(0.8 <= s < 0.85 for s in shares[:12]) and all(s < 0.8 for s in shares[12:])
    docs = spark.createDataFrame(rows, SCHEMA)
    assert minhash_dedup.near_dedup(docs).count() == 36
    linked = sorted(r["doc_id"] for r in minhash_dedup.near_dedup(docs, percent=80).collect())
    assert linked == [*range(0, 24, 2), *range(24, 36)]
    staged = dict(corpus_pipeline.STAGES)["near_dedup"](spark, docs, "")
    assert sorted(r["doc_id"] for r in staged.collect()) == linked


def test_sketches_hardly_lose_a_link_at_the_threshold():
    wide = {p: minhash_dedup.least_shared(p, minhash_dedup.WIDE, minhash_dedup.LOSS_WIDE) for p in (80, 85)}
    narrow = {p: minhash_dedup.least_shared(p, minhash_dedup.KEEP) for p in (80, 85)}
    assert (wide, narrow) == ({80: 63, 85: 70}, {80: 53, 85: 60})
    for kept, shares, most in ((minhash_dedup.WIDE, wide, 10**9), (minhash_dedup.KEEP, narrow, 10**6)):
        for p, share in shares.items():
            least = math.ceil(Fraction(share * kept, 100))
            assert sum(math.comb(kept, i) * p**i * (100 - p) ** (kept - i) for i in range(least)) * most <= 100**kept


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 200 + i) for i in range(50)] + [(500, 501), (501, 500), (7, 7)]
    got = dict(rows_of(shared.components(spark.createDataFrame(edges, "a long, b long")), "node", "root"))
    assert got == {**{i: 0 for i in range(41)}, 100: 100, **{200 + i: 100 for i in range(50)}, 500: 500, 501: 500}


def test_pack(docs, empty):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    want = Counter()
    for doc, text, *_ in awkward():
        want[doc, np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4").tobytes()] += 1
    out = packing.pack(docs, TOKENIZER, 64).collect()
    by_doc: dict = {}
    for (doc, ids), n in want.items():
        for at in range(0, len(ids), 4 * 64):
            by_doc[doc, at // 4, len(ids[at : at + 256]) // 4, zlib.crc32(ids[at : at + 256]), len(ids) // 4] = by_doc.get((doc, at // 4, len(ids[at : at + 256]) // 4, zlib.crc32(ids[at : at + 256]), len(ids) // 4), 0) + n
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in out) == Counter(by_doc)
    places: dict = {}
    for r in out:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in places.values():
        upto = 0
        for offset, length in sorted(parts):
            assert offset == upto
            upto += length
        assert upto <= 64
    assert packing.pack(empty, TOKENIZER, 64).count() == 0


def test_windows_use_up_the_histogram_and_fill_well():
    histogram = np.random.default_rng(5).integers(0, 400, 129)
    histogram[0] = histogram[128] = 0
    plan = packing.plan_windows(histogram, 128)
    used = Counter()
    for lengths, n in plan:
        assert sum(lengths) <= 128
        for x in lengths:
            used[x] += n
    assert used == Counter({i: int(n) for i, n in enumerate(histogram) if n})
    windows = sum(n for _, n in plan)
    assert windows <= 1.05 * max(histogram[65:].sum(), (np.arange(129) * histogram).sum() / 128)


def test_language_model(docs, empty):
    order, prior = 3, 1.5
    learnt = [r for r in awkward() if r[0] is not None and r[0] % 3]
    counts = [Counter() for _ in range(order + 1)]
    for _, text, *_ in learnt:
        tokens = [*WORD.findall((text or "").translate(LOWER)), ("end",)]
        for n in range(1, order + 1):
            counts[n].update(tuple(tokens[i - n + 1 : i + 1]) for i in range(n - 1, len(tokens)))
    total, kinds = sum(counts[1].values()), len(counts[1])
    want = []
    for doc, text, *_ in awkward():
        tokens, base, score, known = [*WORD.findall((text or "").translate(LOWER)), ("end",)], 0.0, 0.0, 0
        for i, token in enumerate(tokens):
            p = (counts[1][token,] + 0.1) / (total + 0.1 * (kinds + 1))
            base += math.log10(p)
            known += counts[1][token,] > 0
            for n in range(2, order + 1):
                history = tuple(tokens[max(0, i - n + 1) : i])
                if len(history) == n - 1 and counts[n - 1][history]:
                    p = (counts[n][(*history, token)] + prior * p) / (counts[n - 1][history] + prior)
            score += math.log10(p)
        want.append((doc, len(tokens), known, total, round(base, 6), round(score, 6)))
    out = backoff_lm.score_texts(docs, F.col("doc_id") % 3 != 0, order, prior)
    got = [(r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6), round(r["score"], 6)) for r in out.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert backoff_lm.score_texts(empty, F.lit(True)).count() == 0
    assert {r["base_score"] for r in backoff_lm.score_texts(docs, F.lit(False)).collect()} == {0.0}


def test_language_model_over_many_buckets(docs, monkeypatch):
    cols = ("doc_id", "n_tokens", "n_known", "train_tokens")
    one = backoff_lm.score_texts(docs, F.lit(True))
    before, sums = rows_of(one, *cols), sorted(round(r["score"], 6) for r in one.collect())
    monkeypatch.setattr(backoff_lm, "BUCKET_BYTES", 3000)
    monkeypatch.setattr(backoff_lm, "PART_KEYS", 500)
    many = backoff_lm.score_texts(docs, F.lit(True))
    assert rows_of(many, *cols) == before and sorted(round(r["score"], 6) for r in many.collect()) == sums


def test_language_model_query_has_two_words_of_history(spark, tmp_path, monkeypatch):
    rows = [(i, prose(700 + i % 30, 40) + " " + prose(800 + i, 15)) for i in range(80)] + [(None, prose(701, 40)), (90, None)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    counts = [Counter() for _ in range(4)]
    held_out = [doc is None or zlib.crc32(str(doc).encode()) % 10 == 0 for doc, _ in rows]
    tokens = [[*WORD.findall((text or "").translate(LOWER)), ("end",)] for _, text in rows]
    for own, held in zip(tokens, held_out):
        for n in range(1, 4):
            counts[n].update(tuple(own[i - n + 1 : i + 1]) for i in range(n - 1, len(own)) if not held)
    total, kinds, want = sum(counts[1].values()), len(counts[1]), []
    for (doc, _), own, held in zip(rows, tokens, held_out):
        score = 0.0
        for i, token in enumerate(own):
            p = (counts[1][token,] + 0.1) / (total + 0.1 * (kinds + 1))
            for n in (2, 3):
                history = tuple(own[i - n + 1 : i]) if i >= n - 1 else None
                if history and counts[n - 1][history]:
                    p = (counts[n][(*history, token)] + 1.5 * p) / (counts[n - 1][history] + 1.5)
            score += math.log10(p)
        want.append((doc, held, round(score, 6)))
    assert 0 < sum(held_out) < len(rows)
    for size, keys in ((backoff_lm.BUCKET_BYTES, backoff_lm.PART_KEYS), (4000, 700)):
        monkeypatch.setattr(backoff_lm, "BUCKET_BYTES", size)
        monkeypatch.setattr(backoff_lm, "PART_KEYS", keys)
        got = [(r["doc_id"], r["held_out"], round(r["score"], 6)) for r in QUERIES["op10_lm_score"](spark, str(tmp_path)).collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr)


def test_sorted_codes_and_counts_come_back():
    draw = np.random.default_rng(1)
    for values in ([], [0], [2**64 - 1], [0, 2**64 - 1], range(1000), draw.integers(0, 2**64, 5000, np.uint64), draw.integers(0, 2**39, 3000, np.uint64)):
        values = np.unique(np.array(values, np.uint64))
        assert (buckets.unpack_sorted(buckets.pack_sorted(values)) == values).all()
    for top in (0, 255, 256, 2**32 - 1, 2**32):
        counts = np.array([0, 1, top], np.int64)
        assert (buckets.unpack_counts(buckets.pack_counts(counts), 3) == counts).all()
    assert len(buckets.unpack_counts(buckets.pack_counts(np.zeros(0, np.int64)), 0)) == 0


def test_top_k(spark):
    draw = np.random.default_rng(1)
    rows = [(i, [float(x) for x in draw.normal(size=6)]) for i in range(120)]
    rows += [(200 + i, rows[0][1]) for i in range(30)] + [(300, None), (310, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (320, [float("nan")] * 6), (None, rows[1][1]), (330, [1.0, 2.0]), (340, [2.0, 2.0]), (0, rows[0][1]), (350, [1e16] * 6), (360, [])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    clean: dict = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            clean.setdefault(i, [math.floor(256 * x) for x in v])
    want = []
    for q, v in clean.items():
        if q % 10 == 0:
            found = sorted((-max(-(2**63) + 1, min(2**63 - 1, sum(a * b for a, b in zip(v, w)))), i) for i, w in clean.items() if i != q and len(w) == len(v))[:5]
            want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found)]
    got = rows_of(topk.top_k(frame, F.col("vec_id") % 10 == 0), "query_id", "rank", "vec_id", "score")
    assert got == sorted(want, key=repr)
    assert topk.top_k(frame.limit(0), F.col("vec_id") % 10 == 0).count() == 0


CALL = "conv_id long, call_id string, parent_id string, name string, arguments string, position long, extra string"
ANSWER = "conv_id long, call_id string, content string, position long, extra string"


def test_tool_calls(spark):
    good = '{"query": "x", "limit": 3}'
    calls = [
        (1, "a", None, "search", good, 5, ""), (1, "b", "a", "search", '{"limit":70,"query":"y","z":1}', 1, ""), (1, "c", "b", "lookup", '{"mode":"odd"}', 0, ""),
        (1, "a", None, "search", '{"query":1}', 9, ""), (2, "p", "q", "search", good, 0, ""), (2, "q", "p", "search", "[1]", 1, ""), (2, "r", "p", "browse", good, 2, ""),
        (3, None, None, "search", None, 0, ""), (None, "a", "gone", "search", '{"query":"x","query":"y","limit":1}', 0, ""), (3, "s", "s", "search", '{"query":null,"limit":1.5}', 1, ""),
    ]
    answers = [(1, "a", "second", 8, ""), (1, "a", "first", 6, ""), (1, "zz", "lost", 2, ""), (3, None, "no name", 3, ""), (None, "a", None, 1, "")]
    out = tool_calls.link_tool_calls(spark.createDataFrame(calls, CALL), spark.createDataFrame(answers, ANSWER), tool_calls.SAMPLE_TOOLS)
    got = {(r["conv_id"], r["call_id"], r["status"]): r for r in out.collect()}
    assert out.count() == len(got) == 11
    first = got[1, "a", "linked"]
    assert (first["arguments"], first["content"], first["n_results"], first["n_calls"], first["depth"], first["call_order"], first["problems"]) == ('{"limit":3,"query":"x"}', "first", 2, 2, 0, 0, [])
    assert got[1, "b", "unanswered"]["problems"] == ["maximum limit", "unexpected z"]
    assert got[1, "c", "unanswered"]["problems"] == ["missing query", "value mode"]
    assert [got[1, c, s]["call_order"] for c, s in (("a", "linked"), ("b", "unanswered"), ("c", "unanswered"), ("zz", "orphan"))] == [0, 1, 2, 3]
    assert all(got[2, c, "cycle"]["depth"] is None for c in "pqr") and got[2, "r", "cycle"]["problems"] == ["unknown tool"]
    assert got[2, "q", "cycle"]["problems"] == ["not a JSON object"]
    assert got[3, "s", "cycle"]["problems"] == ["type limit", "type query"]
    assert got[3, None, "unanswered"]["n_results"] == 0 and got[3, None, "orphan"]["content"] == "no name"
    assert got[None, "a", "linked"]["arguments"] is None and got[None, "a", "linked"]["depth"] == 0
    nothing = tool_calls.link_tool_calls(spark.createDataFrame([], CALL), spark.createDataFrame([], ANSWER), tool_calls.SAMPLE_TOOLS)
    assert nothing.count() == 0


def test_long_chains_take_few_rounds(spark):
    calls = [(1, f"c{i}", f"c{i - 1}", "search", json.dumps({"limit": 1, "query": "q"}), -i, "") for i in range(70)]
    out = tool_calls.link_tool_calls(spark.createDataFrame(calls, CALL), spark.createDataFrame([], ANSWER), tool_calls.SAMPLE_TOOLS)
    assert rows_of(out, "call_order", "depth") == sorted(((i, i) for i in range(70)), key=repr)
    assert all(r["call_id"] == f"c{r['depth']}" for r in out.collect())


def test_quality_rules_hold_on_unseen_rows(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    draw = F.pmod(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")), F.lit(5))
    model = rule_quality.learn(docs, labels, draw != 0)
    assert model.rules
    unseen = rule_quality.scored(docs, model).where(draw == 0).join(labels, "doc_id")
    right = unseen.agg(F.avg(((F.col("quality_score") >= 0.3) == (F.col("quality") == 1)).cast("double"))).first()[0]
    assert right > 0.95


def test_quality_of_awkward_rows(spark, docs, empty):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["quality_score"] for r in rule_quality.scored(docs, rule_quality.learn(docs, none, F.lit(True))).collect()} == {0.5}
    one_kind = spark.createDataFrame([(1, 1), (2, 1), (None, 0), (3, None)], "doc_id long, quality int")
    assert min(r["quality_score"] for r in rule_quality.scored(docs, rule_quality.learn(docs, one_kind, F.lit(True))).collect()) > 0.99
    model = rule_quality.RuleModel(0.0, (((("marks", ">", 0.5),), -2.0), ((("capitals", "<=", 0.5), ("words", ">", 1.0)), 3.0)))
    out = rule_quality.scored(docs, model)
    assert out.columns == [*docs.columns, "quality_score"] and out.count() == docs.count()
    assert out.where("quality_score is null or quality_score < 0 or quality_score > 1").count() == 0
    assert rule_quality.scored(empty, model).count() == 0


def test_paths_of_printed_trees():
    printed = """
  Tree 0 (weight 1.0):
    If (feature 0 <= 0.5)
     If (feature 1 <= 2.0)
      Predict: 0.0
     Else (feature 1 > 2.0)
      Predict: 1.0
    Else (feature 0 > 0.5)
     Predict: 1.0
  Tree 1 (weight 1.0):
    Predict: 1.0
"""
    a, b = ("x", "<=", 0.5), ("x", ">", 0.5)
    assert rule_quality.tree_paths(printed, ["x", "y"]) == [(a,), (a, ("y", "<=", 2.0)), (a, ("y", ">", 2.0)), (b,)]


def test_ranks_of_a_hot_key(spark):
    frame = spark.range(5000).select(F.when(F.col("id") < 3000, "hot").when(F.col("id") < 4000, None).otherwise("cold").alias("k"), F.col("id").alias("o"))
    got = shared.ranked(frame, ["k"], ["o"]).collect()
    first = {"hot": 0, None: 3000, "cold": 4000}
    assert len(got) == 5000 and all(r["rank"] == r["o"] - first[r["k"]] for r in got)
