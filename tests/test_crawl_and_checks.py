"""Crawl bookkeeping and integrity checks on small tables."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from sleevework.operators import checks as D
from sleevework.operators import crawl as C
from sleevework.operators import replies as R
from sleevework.sources.manifest import scan_manifest
from sleevework.sources.scan import page_key, scan_html_folder, scan_pages, shared_keys


def test_targets_from_a_manifest_file(spark, tmp_path):
    (tmp_path / "manifest.json").write_text(
        '{"albums": [{"id": 271, "status": "captured", "diversity": ["x"]}],\n "search": [{"slug": "multi-hit", "query": "final fantasy~*"}], "organizations": [{"id": 17}]}'
    )
    targets = C.build_targets(scan_manifest(spark, str(tmp_path)))
    assert {tuple(r) for r in targets.collect()} == {
        ("album/271", "/album/271", "albums/271.html"),
        ("search/multi-hit", "/search?q=final+fantasy~%2A", "search/multi-hit.html"),
        ("org/17", "/org/17", "organizations/17.html"),
    }
    wanted = spark.createDataFrame([("album/271",), ("album/9",), ("album/8",)], "key string")
    assert [r["key"] for r in C.select_targets(targets, wanted).collect()] == ["album/271"]
    assert [r["key"] for r in C.unknown_targets(targets, wanted).collect()] == ["album/8", "album/9"]
    assert C.skip_existing(targets, wanted).count() == 2 and C.skip_existing(targets, wanted, overwrite=True).count() == 3
    assert tuple(C.capture_counts(targets, wanted).collect()[0]) == (2, 1, 3)


def test_pages_are_stored_unchanged_and_latest_wins(spark, tmp_path):
    path = str(tmp_path / "pages")
    schema = "key string, kind string, captured_at bigint, html string"
    first = spark.createDataFrame([("album/1", "album", 1, "<p>\r\né</p>"), ("org/1", "org", 1, "o")], schema)
    assert C.stored_pages(spark, path) is None
    C.sink_pages(first, path)
    C.sink_pages(spark.createDataFrame([("album/1", "album", 2, "skipped"), ("album/2", "album", 2, "added")], schema), path)
    stored = {(r["key"], r["html"]) for r in C.stored_pages(spark, path).collect()}
    assert stored == {("album/1", "<p>\r\né</p>"), ("album/2", "added"), ("org/1", "o")}
    C.sink_pages(spark.createDataFrame([("album/1", "album", 3, "new"), ("album/1", "album", 4, "newest")], schema), path, overwrite=True)
    stored = {(r["key"], r["html"]) for r in C.stored_pages(spark, path).collect()}
    assert stored == {("album/1", "newest"), ("album/2", "added"), ("org/1", "o")}


def test_html_folder(spark, sf_dir, tmp_path):
    (tmp_path / "1.html").write_text("<h1>\nA</h1>")
    (tmp_path / "skip.txt").write_text("x")
    rows = scan_html_folder(spark, str(tmp_path))
    key = spark.range(1).select(page_key(F.lit("1"))).first()[0]
    assert [(r["page_id"], r["html"]) for r in rows.collect()] == [(key, "<h1>\nA</h1>")]
    assert rows.schema["page_id"].dataType == scan_pages(spark, f"{sf_dir}/pages.parquet").schema["page_id"].dataType
    (tmp_path / "again").mkdir()
    (tmp_path / "again" / "1.html").write_text("other")
    (tmp_path / "again" / "2.html").write_text("other")
    assert [(r["page_id"], r["pages"]) for r in shared_keys(scan_html_folder(spark, str(tmp_path))).collect()] == [(key, 2)]


def test_retry_outcomes(spark):
    log = {1: ["transient", "ok"], 2: ["transient"] * 6, 3: ["not_found", "ok"], 4: ["transient", "challenge"], 5: ["transient"] * 4 + ["ok"]}
    rows = spark.createDataFrame([(k, i, o) for k, v in log.items() for i, o in enumerate(v, 1)], "request_id bigint, attempt bigint, outcome string")
    got = {r["request_id"]: (r["outcome"], r["attempts"]) for r in C.retry_outcome(rows, 3).collect()}
    assert got == {1: ("ok", 2), 2: ("transient", 4), 3: ("not_found", 1), 4: ("challenge", 2), 5: ("transient", 4)}


def test_waits_of_a_single_busy_host(spark):
    rng = random.Random(5)
    times = sorted(rng.randrange(0, 200_000_000) for _ in range(3000))
    rows = [("busy", i, t) for i, t in enumerate(times)] + [("quiet", 10**6, 0), ("quiet", 10**6 + 1, 7_300_000_000)]
    log = spark.createDataFrame(rows, "host string, event_id bigint, us bigint").select("host", "event_id", F.timestamp_micros("us").alias("ts"))
    for interval in (1.0, 5000.0):
        got = {r["event_id"]: r["wait"] for r in C.throttle_wait(log, interval).collect()}
        expected = {0: 0.0, 10**6: 0.0, 10**6 + 1: 0.0}
        expected |= {i: round(max(0.0, interval - (times[i] - times[i - 1]) / 1e6), 6) for i in range(1, len(times))}
        assert got == expected
    assert {r["wait"] for r in C.throttle_wait(log, 0).collect()} == {0.0}


def test_checks(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "section string, id int")
    assert {tuple(r) for r in D.min_rows(rows, {"a": 2, "b": 2, "c": 1}).collect()} == {("b", 1, 2), ("c", 0, 1)}
    assert [tuple(r) for r in D.unique_keys(rows, ["section", "id"]).collect()] == [("a", 1, 2)]
    bad = D.well_formed(spark.createDataFrame([(1, " ", ["x"]), (2, "k", []), (3, "k", None), (4, "k", ["y"])], "id int, kind string, tags array<string>"), ["kind"], {"no tags": F.size("tags") > 0})
    assert {(r["id"], r["problems"]) for r in bad.collect()} == {(1, "no kind"), (2, "no tags"), (3, "no tags")}
    keys = lambda *k: spark.createDataFrame([(x,) for x in k], "key string")
    assert [r["key"] for r in D.orphans([keys("a"), keys("b", "z")], keys("a", "b")).collect()] == ["z"]
    stored = spark.createDataFrame([("a", ""), ("b", "x")], "key string, body string")
    assert {tuple(r) for r in D.completeness(keys("a", "b", "c"), stored, F.length("body")).collect()} == {("a", "empty"), ("c", "missing")}
    assert {tuple(r) for r in D.set_difference(keys("a", "b", "b"), keys("b", "c"), ["key"]).collect()} == {("a", "left"), ("c", "right")}
    assert D.set_difference(keys("a", "a"), keys("a"), ["key"]).count() == 0
    assert [tuple(r) for r in D.foreign_key(keys("a", "z", "z"), keys("a"), ["key"]).collect()] == [("z", 2)]


def _render(spark, template, tracks="1. {notes}", notes="N"):
    row = spark.createDataFrame([(template, tracks, notes)], "t string, l string, n string").select(R.render_template(F.col("t"), F.col("l"), F.col("n")).alias("r")).collect()[0]["r"]
    return row["text"], row["error"]


def test_templates(spark):
    assert _render(spark, "{tracklist}|{notes}") == ("1. {notes}|N", None), "inserted text is not searched again"
    assert _render(spark, "{{x}} {notes}") == ("{x} N", None)
    for broken in ("{mood}", "{", "}", "{0}", "a { b } {notes}"):
        assert _render(spark, broken) == (None, "invalid template")


def test_reply_shapes(spark):
    good = ['{"track_credits": {}}', "{}", '{"track_credits": {"1": [{"role_raw": "Music"}]}, "x": 1}', '{"track_credits": {"1": [{"role_raw": "V", "artists": [{"names": {}}]}]}}']
    shape = ["[]", '"x"', '{"track_credits": []}', '{"track_credits": {"1": {}}}', '{"track_credits": {"1": [{}]}}', '{"track_credits": {"1": [{"role_raw": "a", "artists": null}]}}',
             '{"track_credits": {"1": [{"role_raw": "a", "artists": [{"names": {"en": 1}}]}]}}', '{"track_credits": {"1": [{"role_raw": "a", "artists": [{}]}]}}']
    rows = [(1, i, r) for i, r in enumerate([*good, *shape, "{", '{"track_credits": {"x": []}}'])]
    got = [r["reason"] for r in R.validate_replies(spark.createDataFrame(rows, "album_id bigint, attempt int, reply string")).orderBy("attempt").collect()]
    assert got == [None] * len(good) + ["wrong shape"] * len(shape) + ["not JSON", "track key is no number"]


def test_retries_carry_every_correction(spark):
    replies = spark.createDataFrame([(1, 1, "{"), (1, 2, "[]"), (2, 1, "{"), (2, 2, "{}"), (3, 1, "{"), (3, 2, "{"), (3, 3, "{")], "album_id bigint, attempt int, reply string")
    settled = R.settle_replies(R.validate_replies(replies), max_retries=2)
    assert {r["album_id"]: (r["state"], r["accepted_attempt"]) for r in settled.collect()} == {1: ("requeue", None), 2: ("accepted", 2), 3: ("exhausted", None)}
    prompts = spark.createDataFrame([(i,) for i in (1, 2, 3)], "album_id bigint").select("album_id", R.messages(F.lit("s"), F.lit("u")).alias("messages"))
    again = R.requeue(settled, prompts).collect()
    assert [(r["album_id"], [m["role"] for m in r["messages"]]) for r in again] == [(1, ["system", "user", "user", "user"])]
    assert "not JSON" in again[0]["messages"][2]["content"] and "wrong shape" in again[0]["messages"][3]["content"]


def test_requests_of_several_modes_come_from_one_reading(spark):
    messages = "array(named_struct('role', 'system', 'content', 's'), named_struct('role', 'user', 'content', concat('u \\n\"', id)))"
    prompts = spark.range(3).selectExpr("id as album_id", f"{messages} as messages")
    every = R.request_rows(prompts, R.OUTPUT_MODES)
    for mode in R.OUTPUT_MODES:
        assert sorted(map(tuple, every.where(F.col("mode") == mode).drop("mode").collect())) == sorted(map(tuple, R.request_rows(prompts, mode).collect()))
    assert every.columns == ["album_id", "mode", "body"] and every.count() == 9
    assert spark.range(1).selectExpr("id as album_id", "cast(null as array<struct<role:string,content:string>>) as messages").transform(R.request_rows, ("tool",)).count() == 1
    assert every._jdf.queryExecution().executedPlan().toString().count("Range (") == 1
