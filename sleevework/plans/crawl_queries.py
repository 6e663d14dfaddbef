"""Queries over sources and crawl bookkeeping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sleevework.functions import web
from sleevework.operators import crawl as C
from sleevework.plans.quality_queries import album_documents
from sleevework.plans.registry import CHECK_VIEWS, by_key, query, table, view
from sleevework.sources.golden import ALBUM_SCHEMA, golden_documents, golden_findings, golden_problems
from sleevework.sources.manifest import manifest_entries
from sleevework.sources.scan import scan_pages, shared_keys


@query("p0_scan_pages", "select page_id, url, length(html) as n_chars, md5(html) as html_md5 from pages")
def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scan_pages(spark, f"{sf_dir}/pages.parquet")
    return rows.select("page_id", "url", F.length("html").cast("bigint").alias("n_chars"), F.md5("html").alias("html_md5"))


@query("p0b_scan_golden", "select album_id as id, title, catalog, substr(release_date, 1, 4) as year, cast(n_discs as bigint) as n_discs from v_albums")
def golden(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = album_documents(spark, sf_dir)
    texts = docs.select(F.to_json(F.struct(F.col("album_id").alias("id"), "titles", "catalog", "release_date", "discs")).alias("value"))
    rows = golden_documents(texts, ALBUM_SCHEMA).select("doc.*")
    return rows.select(
        "id", F.col("titles")["English"].alias("title"), "catalog", F.col("release_date.year").cast("string").alias("year"),
        F.size("discs").cast("bigint").alias("n_discs"),
    )


_GOLDEN_SHAPES = """case o_orderkey % 10
  when 0 then concat('{"id": ', o_orderkey, ', "titles": {"English": "A"}, "notes": null, "release_date": {"year": 2001, "month": 12, "day": 31}}')
  when 1 then concat('{"id": ', o_orderkey, ', "titles": {}, "mood": 3, "colour": 2}')
  when 2 then '{"id": "x", "titles": {"English": 5}}'
  when 3 then '{"id": '
  when 4 then concat('{"id": 1, "titles": {}, "release_date": {"year": 2001, "month": ', 13 + o_orderkey % 65, ', "zz": 1}}')
  when 5 then '{"titles": {}, "credits": [{"role": "composer", "role_raw": "x"}, {"role": "foo", "role_raw": "y", "artists": [{"names": {"English": "B"}, "nick": "b"}]}]}'
  when 6 then '{"id": 1, "titles": {}, "discs": [{"tracks": [{"titles": {}, "number": 1}, {"number": "2", "titles": {"Romaji": null}}]}]}'
  when 7 then '{"id": 1, "titles": null, "discs": null, "release_date": {"day": 40}}'
  when 8 then '[1, 2]'
  else '{"id": 1.5, "titles": {}, "credits": [null], "release_event": "x"}' end"""


def _golden_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_key(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey").select(F.col("o_orderkey").alias("id"), F.expr(_GOLDEN_SHAPES).alias("value"))


@query(
    "p0b_golden_problems",
    """select o_orderkey as id, case o_orderkey % 10 when 1 then 'unknown field colour; unknown field mood' when 2 then 'wrong type id; wrong type titles.English' when 3 then 'not JSON'
         when 4 then 'unknown field release_date.zz; out of bounds release_date.month'
         when 5 then 'missing id; unknown word credits[1].role; unknown field credits[1].artists[0].nick'
         when 6 then 'wrong type discs[0].tracks[1].titles.Romaji; wrong type discs[0].tracks[1].number'
         when 7 then 'wrong type titles; missing release_date.year; out of bounds release_date.day; needs month release_date.day; wrong type discs' when 8 then 'wrong type'
         when 9 then 'wrong type id; wrong type credits[0]; wrong type release_event' end as problem from orders""",
)
def golden_problem_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return golden_problems(_golden_texts(spark, sf_dir), ALBUM_SCHEMA).select("id", "problem")


@query(
    "p0b_golden_findings",
    """select o_orderkey as id, p.path, p.reason from orders join (values (1, 'colour', 'unknown field'), (1, 'mood', 'unknown field'), (2, 'id', 'wrong type'), (2, 'titles.English', 'wrong type'),
         (3, '', 'not JSON'), (4, 'release_date.zz', 'unknown field'), (4, 'release_date.month', 'out of bounds'), (5, 'id', 'missing'), (5, 'credits[1].role', 'unknown word'),
         (5, 'credits[1].artists[0].nick', 'unknown field'), (6, 'discs[0].tracks[1].titles.Romaji', 'wrong type'), (6, 'discs[0].tracks[1].number', 'wrong type'), (7, 'titles', 'wrong type'),
         (7, 'release_date.year', 'missing'), (7, 'release_date.day', 'out of bounds'), (7, 'release_date.day', 'needs month'), (7, 'discs', 'wrong type'), (8, '', 'wrong type'),
         (9, 'id', 'wrong type'), (9, 'credits[0]', 'wrong type'), (9, 'release_event', 'wrong type')) p(shape, path, reason) on p.shape = o_orderkey % 10""",
)
def golden_finding_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return golden_findings(_golden_texts(spark, sf_dir), ALBUM_SCHEMA).select("id", "path", "reason")


@query("p0_shared_keys", "select page_id, count(*) as pages from (select page_id // 3 as page_id, url from pages) t group by page_id having min(url) <> max(url)")
def shared_page_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scan_pages(spark, f"{sf_dir}/pages.parquet").withColumn("page_id", F.expr("page_id div 3"))
    return shared_keys(rows).select("page_id", "pages")


# one manifest per customer, listing a handful of entries in five of the six sections
_MANIFEST = """concat('{"source": "x", "albums": [{"id": ', 2 * c_custkey, ', "kind": "album", "status": "captured", "diversity": ["a"]}, {"id": ', 2 * c_custkey + 1,
  ', "kind": "album", "status": "candidate", "diversity": []}], "search": [{"slug": "s', c_custkey, '", "kind": "search", "query": ', to_json(named_struct('q', c_name)), ', "status": "captured"}]',
  case when c_custkey % 2 = 0 then concat(', "artists": [{"id": ', c_custkey, ', "kind": "artist", "status": "captured"}]') else '' end,
  case when c_custkey % 3 = 0 then concat(', "organizations": [{"id": ', c_nationkey, ', "kind": "org"}], "products": []') else '' end,
  ', "events": [{"id": ', c_custkey, ', "kind": "event", "status": "', case when c_custkey % 5 = 0 then 'captured' else 'candidate' end, '"}]}')"""
_MANIFEST = _MANIFEST.replace("to_json(named_struct('q', c_name))", "'\"', c_name, ' *~&é\"'")

CHECK_VIEWS["x_entries"] = """
select 'albums' as section, 2 * c_custkey as id, null as slug, 'album' as kind, null as query, 'captured' as status, c_custkey as custkey, 1 as n_tags from customer
union all select 'albums', 2 * c_custkey + 1, null, 'album', null, 'candidate', c_custkey, 0 from customer
union all select 'search', null, concat('s', c_custkey), 'search', concat(c_name, ' *~&é'), 'captured', c_custkey, null from customer
union all select 'artists', c_custkey, null, 'artist', null, 'captured', c_custkey, null from customer where c_custkey % 2 = 0
union all select 'organizations', c_nationkey, null, 'org', null, null, c_custkey, null from customer where c_custkey % 3 = 0
union all select 'events', c_custkey, null, 'event', null, case when c_custkey % 5 = 0 then 'captured' else 'candidate' end, c_custkey, null from customer
"""


def _entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest_entries(table(spark, sf_dir, "customer").select(F.expr(_MANIFEST).alias("value")))


@query("p0c_scan_manifest", "select section, id, slug, kind, query, status, cast(n_tags as bigint) as n_tags from x_entries")
def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tags = F.when(F.col("diversity").isNotNull(), F.size("diversity")).cast("bigint")
    return _entries(spark, sf_dir).select("section", "id", "slug", "kind", "query", "status", tags.alias("n_tags"))


CHECK_VIEWS["x_targets"] = """
select concat(kind, '/', coalesce(slug, cast(id as varchar))) as key,
  case when kind = 'search' then '/search?q=' || replace(replace(replace(replace(replace(replace(query, '#', '%23'), ' ', '+'), '*', '%2A'), '&', '%26'), 'é', '%C3%A9'), '"', '%22')
    else concat('/', kind, '/', id) end as path,
  concat(section, '/', coalesce(slug, cast(id as varchar)), '.html') as out
from x_entries
"""


@query("c1_build_targets", "select key, path, out from x_targets")
def build_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.build_targets(_entries(spark, sf_dir))


def _wanted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.concat(F.lit("album/"), "o_custkey").alias("key"))


@query("c2_select_targets", "select key, path, out from x_targets where key in (select concat('album/', o_custkey) from orders)")
def select_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.select_targets(C.build_targets(_entries(spark, sf_dir)), _wanted(spark, sf_dir))


@query("c2_unknown_targets", "select distinct concat('album/', o_custkey * 3) as key from orders where concat('album/', o_custkey * 3) not in (select key from x_targets)")
def unknown_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = table(spark, sf_dir, "orders").select(F.concat(F.lit("album/"), F.col("o_custkey") * 3).alias("key"))
    return C.unknown_targets(C.build_targets(_entries(spark, sf_dir)), wanted)


def _order_keys(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    targets = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), "o_orderstatus")
    return targets, table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("key"))


@query("c3_skip_existing", "select o_orderkey as key, o_orderstatus from orders where o_orderkey not in (select l_orderkey from lineitem)")
def skip_existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.skip_existing(*_order_keys(spark, sf_dir))


@query(
    "c3_capture_counts",
    """select count(*) filter (where o_orderkey not in (select l_orderkey from lineitem)) as captured,
         count(*) filter (where o_orderkey in (select l_orderkey from lineitem)) as skipped, count(*) as targets from orders""",
)
def capture_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.capture_counts(*_order_keys(spark, sf_dir))


@query(
    "c4_latest_pages",
    """select key, kind, page_id, html_md5 from (select url as key, 'page' as kind, page_id, md5(html) as html_md5,
         row_number() over (partition by url order by page_id desc) as n from pages) t where n = 1""",
)
def latest_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures = scan_pages(spark, f"{sf_dir}/pages.parquet").select(F.col("url").alias("key"), F.lit("page").alias("kind"), "page_id", F.col("page_id").alias("captured_at"), "html")
    return C.latest_pages(captures).select("key", "kind", "page_id", F.md5("html").alias("html_md5"))


def _headers() -> Column:
    return F.create_map(F.lit("Server"), F.col("server"), F.lit("CF-Mitigated"), F.col("mitigated"), F.lit("Retry-After"), F.col("retry_after"))


CHECK_VIEWS["x_log"] = """
select *, status in (403, 503) and (lower(mitigated) = 'challenge' or (lower(body) like '%just a moment%' and lower(server) = 'cloudflare')) as challenge from v_fetch_log
"""
CHECK_VIEWS["x_outcomes"] = """
select *, case when status between 200 and 299 then 'ok' when status = 404 then 'not_found' when challenge then 'challenge' when status = 429 then 'rate_limited'
  when status >= 500 then 'transient' else 'error' end as outcome from x_log
"""


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = view(spark, sf_dir, "v_fetch_log")
    return log.withColumn("outcome", web.classify_response(F.col("status"), _headers(), F.col("body")))


@query("c5_classify_response", "select event_id, cast(status as bigint) as status, outcome from x_outcomes")
def classify_response(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _log(spark, sf_dir).select("event_id", F.col("status").cast("bigint").alias("status"), "outcome")


@query("c5b_is_challenge", "select event_id, challenge from x_log")
def is_challenge(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = view(spark, sf_dir, "v_fetch_log")
    return log.select("event_id", web.is_challenge(F.col("status"), _headers(), F.col("body")).alias("challenge"))


@query("c5c_lower_headers", "select event_id, 'retry-after,server' as names, coalesce(nullif(mitigated, ''), server) as server from v_fetch_log")
def lower_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    later = F.coalesce(F.nullif(F.col("mitigated"), F.lit("")), F.col("server"))
    headers = F.create_map(F.lit("Server"), F.col("server"), F.lit("Retry-AFTER"), F.col("retry_after"), F.lit("SERVER"), later)
    log = view(spark, sf_dir, "v_fetch_log").select("event_id", web.lower_headers(headers).alias("h"))
    return log.select("event_id", F.array_join(F.array_sort(F.map_keys("h")), ",").alias("names"), F.col("h")["server"].alias("server"))


@query("c6_retry_after", "select event_id, try_cast(retry_after as double) as seconds from v_fetch_log")
def retry_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "v_fetch_log").select("event_id", web.retry_after(_headers()).alias("seconds"))


@query(
    "c7_retry_outcome",
    """select request_id, coalesce(arg_min(outcome, attempt) filter (where outcome <> 'transient'), 'transient') as outcome,
         coalesce(min(attempt) filter (where outcome <> 'transient'), max(attempt)) as attempts
       from x_outcomes where attempt <= 4 group by request_id""",
)
def retry_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.retry_outcome(_log(spark, sf_dir), 3)


@query(
    "c8_throttle_wait",
    """select event_id, host, coalesce(round(greatest(0.0, 900.0 - (epoch_us(ts) - epoch_us(lag(ts) over (partition by host order by ts, event_id))) / cast(1000000 as double)), 6), 0) as wait
       from v_fetch_log""",
)
def throttle_wait(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.throttle_wait(view(spark, sf_dir, "v_fetch_log"), 900.0).select("event_id", "host", "wait")


@query("c9_captured_only", "select section, id, slug from x_entries where status = 'captured'")
def captured_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.captured_only(_entries(spark, sf_dir)).select("section", "id", "slug")


@query("c9_ordered_ids", "select cast(o_orderkey as varchar) as id, row_number() over (order by o_orderkey) - 1 as place from orders")
def ordered_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("id"))
    # the parts of a range sort follow one another, so a row's place is its place in the part and the rows before
    parts = C.ordered_ids(rows).select("id", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"))
    counts = parts.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    shift = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    within = F.col("at").bitwiseAND((1 << 33) - 1)
    return parts.join(counts.withColumn("shift", shift), "part").select("id", (F.col("shift") + within).alias("place"))
