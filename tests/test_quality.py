"""Field scores, coverage, matching and the full comparison."""

from __future__ import annotations

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from sleevework.operators import notes as N
from sleevework.operators import quality as Q
from sleevework.plans import composed_pages
from sleevework.plans import quality_run as R
from sleevework.plans.catalog import all_queries
from sleevework.sources.golden import ALBUM_SCHEMA, golden_problems, scan_golden

LONG = "source string, album_id bigint, field string, value string, ord int"
GOLD = "album_id bigint, field string, value string, ord int"


def test_every_status(spark):
    golden = spark.createDataFrame([(1, "title", "Album A", 1), (1, "catalog", "CAT-1", 2), (1, "release_date", "2005", 3), (1, "notes", None, 4), (2, "title", "B", 1)], GOLD)
    sources = spark.createDataFrame(
        [("a", 1, "title", " album  a", 1), ("a", 1, "catalog", "CAT-2", 2), ("a", 1, "classification", "Game", 3), ("b", 2, "title", "B", 1)], LONG
    )
    scores = Q.score(sources, golden)
    got = {(r["source"], r["album_id"], r["field"]): r["status"] for r in scores.collect()}
    assert got == {
        ("a", 1, "title"): "match", ("a", 1, "catalog"): "mismatch", ("a", 1, "release_date"): "missing", ("a", 1, "notes"): "absent",
        ("a", 1, "classification"): "extra", ("b", 2, "title"): "match",
    }, "albums a source lacks are not held against it"
    assert {tuple(r) for r in Q.scorecard(scores).collect()} == {("a", 1, 3, "33%"), ("b", 1, 1, "100%")}
    diff = {r["field"]: (r["rank_place"], r["rank_ord"]) for r in Q.nway_diff(scores, ["a", "b"]).where("album_id = 1").collect()}
    assert sorted(diff, key=diff.get) == ["title", "catalog", "release_date", "notes", "classification"]
    shown = scores.where("field = 'title' and album_id = 1").collect()[0]
    assert (shown["golden"], shown["value"]) == ("Album A", " album  a"), "raw values are reported"


def test_coverage(spark):
    albums = spark.createDataFrame([(1,), (2,)], "album_id bigint")
    tracks = spark.createDataFrame([(1, 1), (1, 2), (1, 2), (1, None)], "album_id bigint, number int")
    credits = spark.createDataFrame([(1, 1), (1, 1), (1, 99)], "album_id bigint, track bigint")
    assert {tuple(r) for r in Q.coverage(albums, tracks, credits).collect()} == {(1, True, 1, 2, 2), (2, True, 0, 0, 0)}
    assert {r["available"] for r in Q.coverage(albums, tracks, None).collect()} == {False}


CREDIT = "album_id bigint, track bigint, ord bigint, role string, names array<string>"


def greedy(produced, golden):
    """The matching rule, spelled out on lists."""
    def key(names):
        return {n.lower() for n in names if n}

    counts = {}
    for track in {c[1] for c in produced + golden}:
        remaining = sorted((c for c in produced if c[1] == track), key=lambda c: (c[2], sorted(key(c[4]))))
        wanted = sorted((c for c in golden if c[1] == track), key=lambda c: (c[2], sorted(key(c[4]))))
        row = [0, len(remaining), len(wanted)]
        for g in wanted:
            hit = next((p for p in remaining if p[3] == g[3] and ((not key(p[4]) and not key(g[4])) or key(p[4]) & key(g[4]))), None)
            if hit is not None:
                remaining.remove(hit)
                row[0] += 1
        counts[track] = tuple(row)
    return counts


def random_credits(rng, n):
    pool = ["", "a", "B", "c", "d|e", "e"]
    return [(1, rng.randrange(6), i, rng.choice(["composer", "arranger"]), rng.sample(pool, rng.randrange(3))) for i in range(n)]


@pytest.mark.parametrize("seed", [64, 2, 0])
def test_matching_agrees_with_the_plain_loop(spark, seed):
    rng = random.Random(seed)
    produced, golden = random_credits(rng, 120), random_credits(rng, 140)
    got = Q.match_credits(spark.createDataFrame(produced, CREDIT), spark.createDataFrame(golden, CREDIT)).collect()
    assert {r["track"]: (r["matched"], r["produced"], r["golden"]) for r in got} == greedy(produced, golden)


@pytest.mark.parametrize("limit", [0, 20, 10_000])
def test_matching_of_small_and_large_groups_agrees(spark, monkeypatch, limit):
    rng = random.Random(limit)
    produced, golden = random_credits(rng, 150), random_credits(rng, 130)
    monkeypatch.setattr(Q, "IN_ORDER_CREDITS", limit)
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(size, "3")  # groups run over several batches
    try:
        got = Q.match_credits(spark.createDataFrame(produced, CREDIT), spark.createDataFrame(golden, CREDIT)).collect()
    finally:
        spark.conf.unset(size)
    assert {r["track"]: (r["matched"], r["produced"], r["golden"]) for r in got} == greedy(produced, golden)


def test_matching_with_array_order(spark):
    schema = CREDIT.replace("ord bigint", "ord array<bigint>")
    rows = [(1, 1, [2, 0], "composer", ["a", "b"]), (1, 1, [1, 5], "composer", ["b"]), (1, 1, [10, 0], "composer", ["a"])]
    df = spark.createDataFrame(rows, schema)
    assert [tuple(r) for r in Q.match_credits(df, df).collect()] == [(1, 1, 3, 3, 3)]


def test_credits_without_names_match_on_their_role(spark):
    rows = [(1, 1, 1, "composer", None), (1, 1, 2, "composer", []), (1, 1, 3, "arranger", [""]), (1, 1, 4, "arranger", ["a"])]
    other = [(1, 1, 1, "composer", [""]), (1, 1, 2, "arranger", None), (1, 1, 3, "performer", [])]
    got = Q.match_credits(spark.createDataFrame(rows, CREDIT), spark.createDataFrame(other, CREDIT)).collect()
    assert [tuple(r) for r in got] == [(1, 1, 2, 4, 3)]


def test_one_track_with_many_entangled_credits(spark):
    rows = spark.range(100000).select(
        F.lit(1).cast("bigint").alias("album_id"), F.lit(1).cast("bigint").alias("track"), F.col("id").alias("ord"), F.lit("composer").alias("role"),
        F.array(F.concat(F.lit("n"), F.col("id") % 1000), F.concat(F.lit("m"), F.col("id") % 999)).alias("names"),
    )
    empty = rows.where("ord < 0")
    assert [tuple(r) for r in Q.match_credits(rows, rows).collect()] == [(1, 1, 100000, 100000, 100000)]
    assert [tuple(r) for r in Q.match_credits(empty, rows).collect()] == [(1, 1, 0, 0, 100000)]
    assert Q.match_credits(empty, empty).collect() == []


def test_one_track_with_most_credits_is_only_counted(spark):
    rows = spark.range(200000).select(
        F.lit(1).cast("bigint").alias("album_id"), F.lit(1).cast("bigint").alias("track"), F.col("id").alias("ord"), F.lit("composer").alias("role"),
        F.array(F.concat(F.lit("n"), F.col("id") % 3)).alias("names"),
    )
    got = Q.match_credits(rows.where("ord % 2 = 0"), rows).collect()
    assert [tuple(r) for r in got] == [(1, 1, 100000, 100000, 200000)]


CREDIT_LIST = "album_id bigint, track bigint, role string, is_golden boolean, ord bigint, key array<string>"


def entangled_ids(spark, pairs):
    rows = [(1, 1, "composer", False, i, sorted(set(p))) for i, p in enumerate(pairs)]
    df = spark.createDataFrame(rows, CREDIT_LIST)
    group = ["album_id", "track", "role"]
    return df, df.select(*group, "key").distinct(), group


def test_linked_names_share_a_part(spark):
    pairs = [("a", "b"), ("b", "c"), ("x", "y"), ("y", "z"), ("q",), ("m", "n")]
    _, keys, group = entangled_ids(spark, pairs)
    parts = {tuple(r["key"]): r["part"] for r in Q.connected_parts(keys, group).collect()}
    assert parts == {("a", "b"): "a", ("b", "c"): "a", ("x", "y"): "x", ("y", "z"): "x", ("q",): "q", ("m", "n"): "m"}


def test_a_chain_beyond_the_steps_is_not_cut(spark):
    chain = [(f"n{i:03}", f"n{i + 1:03}") for i in range(60)]
    _, keys, group = entangled_ids(spark, [*chain, ("x", "y")])
    assert {r["part"] for r in Q.connected_parts(keys, group).collect()} == {None}
    produced = [(1, 1, i, "composer", list(p)) for i, p in enumerate(chain)]
    golden = [(1, 1, i, "composer", list(p)) for i, p in enumerate([*chain[::-1], ("x", "n030")])]
    got = Q.match_credits(spark.createDataFrame(produced, CREDIT), spark.createDataFrame(golden, CREDIT)).collect()
    assert {r["track"]: (r["matched"], r["produced"], r["golden"]) for r in got} == greedy(produced, golden)


def test_one_track_of_two_name_credits_spreads_over_all_tasks(spark):
    rows = spark.range(100000).select(
        F.lit(1).cast("bigint").alias("album_id"), F.lit(1).cast("bigint").alias("track"), F.lit("composer").alias("role"), (F.col("id") % 2 == 0).alias("is_golden"),
        F.col("id").alias("ord"), F.array(F.concat(F.lit("a"), F.expr("id div 4")), F.concat(F.lit("b"), F.expr("id div 2"))).alias("key"),
    )
    group = ["album_id", "track", "role"]
    merging = "spark.sql.adaptive.coalescePartitions.enabled"  # small partitions stay apart, to be counted
    spark.conf.set(merging, "false")
    try:
        ordered = Q.entangled_in_order(rows, rows.select(*group, "key").distinct(), group)
        sizes = [r["n"] for r in ordered.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.unset(merging)
    assert sum(sizes) == 100000 and len(sizes) == int(spark.conf.get("spark.sql.shuffle.partitions")) and max(sizes) < 2 * min(sizes)
    credits = rows.withColumnRenamed("key", "names")
    got = Q.match_credits(credits.where("not is_golden"), credits.where("is_golden")).collect()
    assert [(r["matched"], r["produced"], r["golden"]) for r in got] == [(50000, 50000, 50000)]


def test_albums_without_a_source_stay_in_the_diff(spark):
    golden = spark.createDataFrame([(1, "title", "A", 1), (2, "title", "B", 1), (2, "catalog", None, 2)], GOLD)
    sources = spark.createDataFrame([("a", 1, "title", "A", 1), ("a", 1, "catalog", "C", 2)], LONG)
    diff = Q.nway_diff(Q.score(sources, golden), ["a", "b"], golden)
    got = {(r["album_id"], r["field"]): (r["golden"], r["a_value"], r["a_status"], r["b_status"], r["rank_place"], r["rank_ord"]) for r in diff.collect()}
    assert got == {
        (1, "title"): ("A", "A", "match", None, 0, 1), (1, "catalog"): (None, "C", "extra", None, 1, 2),
        (2, "title"): ("B", None, None, None, 0, 1), (2, "catalog"): (None, None, None, None, 0, 2),
    }


@pytest.mark.parametrize(
    ("counts", "expected"),
    [((1, 1, 1), (1.0, 1.0, 1.0)), ((0, 0, 0), (1.0, 1.0, 1.0)), ((0, 1, 0), (0.0, 1.0, 0.0)), ((1, 1, 2), (1.0, 0.5, 2 / 3)), ((0, 1, 1), (0.0, 0.0, 0.0)), ((0, 0, 3), (1.0, 0.0, 0.0))],
)
def test_precision_recall(spark, counts, expected):
    row = Q.with_prf(spark.createDataFrame([counts], "matched bigint, produced bigint, golden bigint")).collect()[0]
    assert (row["precision"], row["recall"], row["f1"]) == pytest.approx(expected)


def test_whole_comparison(spark, tmp_path):
    notes = spark.createDataFrame([(1, "1.\nVocals: A\nMusic by B (2)"), (2, None)], "album_id bigint, notes string")
    tracks = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "album_id bigint, number int")
    golden = spark.createDataFrame([(1, "title", "T", 1), (2, "title", "U", 1)], GOLD)
    sources = golden.select(F.lit("ours").alias("source"), "*")
    truth = R.written(str(tmp_path / "truth"))("truth", R.matching_columns(N.mine_credits(notes, tracks)))
    tables = R.quality_run(sources, golden, notes, tracks, truth, R.written(str(tmp_path / "report")))
    ranking = {(r["backend"], r["album_id"]): (r["matched"], r["precision"], r["recall"]) for r in spark.read.parquet(str(tmp_path / "report" / "ranking")).collect()}
    assert ranking[("rules", None)] == (2, 1.0, 1.0) and ranking[("inline_only", None)] == (1, 1.0, 0.5)
    assert ranking[("rules", 2)] == (0, 1.0, 1.0), "albums without credits count as perfect"
    assert {p.name for p in (tmp_path / "report").iterdir()} == set(tables)
    structural = R.quality_run(sources, golden, notes, tracks, truth, R.written(str(tmp_path / "more")), backends={})
    assert set(structural) == {"field_scores", "agreement", "scorecard"}


#: Own notes in the shapes that the rules know, and what a careful reader takes from them.
WRITTEN_NOTES = {
    1: ("Tracks 1~3\nComposed by Ilse Varn\nLyrics by Tarek & Oda\n\nPressed on recycled vinyl.", [(t, "composer", ["Ilse Varn"]) for t in (1, 2, 3)] + [(t, "lyricist", ["Tarek", "Oda"]) for t in (1, 2, 3)]),
    2: ('2. "Low Tide"\nVocals: Finn Aro\nGuitar, Bass: Wren', [(2, "vocalist", ["Finn Aro"]), (2, "performer", ["Wren"])]),
    3: ("Piano: Oda (1), Nilsa (2~3)\nMixing: Tam (3)", [(1, "performer", ["Oda"]), (2, "performer", ["Nilsa"]), (3, "performer", ["Nilsa"]), (3, "mixing", ["Tam"])]),
    4: ("A record about the sea.\nNo credits known.", []),
    5: ("M-01\nArranged by Tarek\n\nVocals by Nobody Known", [(1, "arranger", ["Tarek"])]),
    6: ("3.\nWith thanks to the harbour choir\nConductor - Ode", [(3, "conductor", ["Ode"])]),
    7: (None, []),
    8: ("2~3\nMusic: Wren; Ilse\n1.\nMastered by Studio Nord", [(2, "composer", ["Wren", "Ilse"]), (3, "composer", ["Wren", "Ilse"]), (1, "mastering", ["Studio Nord"])]),
}


def test_rules_reach_their_floors_on_written_notes(spark, tmp_path):
    notes = spark.createDataFrame([(a, n) for a, (n, _) in WRITTEN_NOTES.items()], "album_id bigint, notes string")
    tracks = spark.createDataFrame([(a, t) for a in WRITTEN_NOTES for t in (1, 2, 3)], "album_id bigint, number int")
    rows = [(a, t, [0, i], role, names) for a, (_, credits) in WRITTEN_NOTES.items() for i, (t, role, names) in enumerate(credits)]
    golden = spark.createDataFrame(rows, "album_id bigint, track bigint, ord array<int>, role string, names array<string>")
    nothing = spark.createDataFrame([], GOLD)
    tables = R.quality_run(nothing.select(F.lit("x").alias("source"), "*"), nothing, notes, tracks, golden, R.written(str(tmp_path)))
    found = {(r["backend"], r["album_id"]): r for r in tables["ranking"].collect()}
    total = found[("rules", None)]
    assert total["precision"] >= 0.90 and total["recall"] >= 0.80
    for album in (4, 7):
        assert (found[("rules", album)]["precision"], found[("rules", album)]["produced"]) == (1.0, 0)


def test_a_run_from_pages(spark, sf_dir, tmp_path):
    pages = composed_pages.album_pages(spark, sf_dir).where("page_id between 1 and 40")
    golden = spark.createDataFrame([(1, "catalog", "CAT-1", 1), (999999, "catalog", "X", 1)], GOLD)
    credits = spark.createDataFrame([], "album_id bigint, track bigint, ord array<int>, role string, names array<string>")
    tables = R.run_from_pages(pages, golden, credits, R.written(str(tmp_path)))
    assert {p.name for p in tmp_path.iterdir()} == set(tables) >= {"albums", "fields", "field_scores", "diff", "ranking"}
    diff = {(r["album_id"], r["field"]): r["ours_status"] for r in tables["diff"].collect()}
    assert diff[(1, "catalog")] == "match" and diff[(1, "title")] == "extra" and diff[(999999, "catalog")] is None


def test_building_queries_starts_no_job(spark, sf_dir):
    context = spark.sparkContext
    context.setJobGroup("building", "building")
    try:
        for name in ("q1_canonical", "q4_score", "q8_match_credits", "q9_prf", "q11_nway_diff", "n11_run_backends", "p18_assemble_album", "flagship_track_credits"):
            all_queries()[name](spark, sf_dir)
        status = context.statusTracker()
        stages = [status.getStageInfo(s) for j in status.getJobIdsForGroup("building") for s in status.getJobInfo(j).stageIds]
        assert {s.name.split(" at ")[0] for s in stages} <= {"parquet", "sql"}, "only the schemas of tables are read"
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


def test_golden_files_must_fit(spark, tmp_path):
    good = {"id": 1, "titles": {"English": "A"}, "discs": [{"number": 1, "name": None, "tracks": [{"titles": {"English": "t"}, "number": 1, "length": "1:00"}]}]}
    (tmp_path / "good").mkdir()
    (tmp_path / "good" / "1.json").write_text(json.dumps(good, indent=2))
    doc = scan_golden(spark, str(tmp_path / "good"), ALBUM_SCHEMA).collect()[0]["doc"]
    assert doc["id"] == 1 and doc["discs"][0]["tracks"][0]["length"] == "1:00"
    date = lambda **d: json.dumps({**good, "release_date": d})
    cases = {
        json.dumps(good): None, json.dumps({**good, "colour": 1}): "unknown field colour", json.dumps({**good, "id": "x"}): "wrong type id", "{": "not JSON", "[]": "wrong type",
        json.dumps({k: v for k, v in good.items() if k != "id"}): "missing id", date(year=2001, month=77): "out of bounds release_date.month", date(year=2001, zz=1): "unknown field release_date.zz",
        date(year=2001, day=3): "needs month release_date.day", date(year=2001, month=None, day=None): None, date(month=3): "missing release_date.year", date(year=2.5): "wrong type release_date.year",
        json.dumps({**good, "credits": [{"role": "foo", "role_raw": "x", "artists": [{"names": {}, "id": 5}]}]}): "unknown word credits[0].role",
        json.dumps({**good, "credits": [{"role": "composer", "role_raw": "x", "artists": [{"names": {}, "nick": 5}, None]}]}): "unknown field credits[0].artists[0].nick; wrong type credits[0].artists[1]",
        json.dumps({**good, "discs": None}): "wrong type discs", json.dumps({**good, "titles": {"English": None}}): "wrong type titles.English",
        json.dumps({**good, "discs": [{"tracks": [{"titles": {}, "number": 2**40}]}]}): "wrong type discs[0].tracks[0].number",
    }
    texts = spark.createDataFrame([(t,) for t in cases], "value string")
    assert {r["value"]: r["problem"] for r in golden_problems(texts, ALBUM_SCHEMA).collect()} == cases
    (tmp_path / "good" / "2.json").write_text(json.dumps({**good, "colour": 1}))
    with pytest.raises(Exception, match="unknown field colour"):
        scan_golden(spark, str(tmp_path / "good"), ALBUM_SCHEMA).collect()


def test_scores_everywhere_are_the_scores_and_the_golden_fields_of_no_source(spark):
    source = [("a", 1, "title", "X", 1), ("a", 1, "title", "y", 2), ("a", 1, "extra", "e", 3), ("b", 1, "catalog", None, 1), ("b", None, "title", "X", 1), ("a", 1, None, "n", 4), ("a", 1, None, "n", 4), (None, 1, "title", "X", 1), (None, 4, "z", "z", 1)]
    gold = [(1, "title", "x", 1), (1, "title", "Y", 2), (1, "catalog", None, 3), (1, None, "f", 4), (2, "title", "t", 1), (2, "title", "t", 1), (None, "title", "X", 1), (4, "title", "q", 1)]
    sources = spark.createDataFrame(source, "source string, album_id long, field string, value string, ord int")
    golden = spark.createDataFrame(gold, "album_id long, field string, value string, ord int")
    rows = lambda df: sorted(map(tuple, df.collect()), key=repr)
    nowhere = [(None, a, f, v, None, None, o, None) for a, f, v, o in gold if a in (2, None)]
    everywhere = Q.score(sources, golden, everywhere=True)
    assert rows(everywhere) == sorted([*map(tuple, Q.score(sources, golden).collect()), *nowhere], key=repr)
    diff = Q.nway_diff(everywhere, ["a", "b"])
    # what has met by album and field is not dealt again for the diff
    plan = diff._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning\(album_id#\d+L, field", plan)) == 1 and "Exchange hashpartitioning(source#" in plan
    assert rows(diff) == rows(Q.nway_diff(Q.score(sources, golden), ["a", "b"], golden))


def test_objects_are_taken_apart_once_whatever_they_hold(spark):
    text = '{"z1": null, "z2": [1, {"a": 1}], "z3": {"_": {"_": 1}, "b": 2}, "z4": "s", "z5": 1.5, "z6": true, "id": 1, "sub": [{"names": {"A": "a"}, "x": [{}]}, [], "t", null, 3], "one": []}'
    schema = "id bigint NOT NULL, sub array<struct<names:map<string,string> NOT NULL,id:bigint>>, one struct<a:string>, name string NOT NULL"
    row = golden_problems(spark.createDataFrame([(text,), ("[]",), ('"t"',), ("null",)], "value string"), schema).collect()
    unknown = [f"unknown field z{i}" for i in range(1, 7)]
    assert row[0]["problem"].split("; ") == [*unknown, "unknown field sub[0].x", *[f"wrong type sub[{i}]" for i in (1, 2, 3, 4)], "wrong type one", "missing name"]
    assert [r["problem"] for r in row[1:]] == ["wrong type"] * 3

    def reads(fields: int) -> int:
        frame = golden_problems(spark.createDataFrame([("{}",)], "value string"), ", ".join(f"f{i} string" for i in range(fields)))
        return frame._jdf.queryExecution().analyzed().toString().count("variant_get(")

    assert reads(3) == reads(20) > 0
