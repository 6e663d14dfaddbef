"""Queries over the quality operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sleevework.functions.dates import parse_partial_date
from sleevework.operators import notes as N
from sleevework.operators import quality as Q
from sleevework.plans import quality_run as R
from sleevework.plans import composed_pages
from sleevework.plans.registry import CHECK_VIEWS, VIEWS, by_key, notes_view, query, table, view
from sleevework.session import shared_folder
from sleevework.sources.golden import ALBUM_SCHEMA, golden_documents

SOURCES = ("ours", "other")


def album_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested album documents, built inside each row of v_albums."""

    def track(album, d, t):
        title = F.concat(F.lit("Song "), album, F.lit("-"), d, F.lit("-"), t)
        return F.struct(F.create_map(F.lit("English"), title).alias("titles"), t.cast("int").alias("number"), F.lit(None).cast("string").alias("length"))

    def disc(album, d):
        tracks = F.transform(F.sequence(F.lit(1).cast("bigint"), (album + d) % 3 + 1), lambda t: track(album, d, t))
        return F.struct(d.cast("int").alias("number"), F.concat(F.lit("Disc "), d).alias("name"), tracks.alias("tracks"))

    albums = by_key(view(spark, sf_dir, "v_albums"), "album_id")
    album = F.col("album_id")
    titles = F.map_filter(F.create_map(F.lit("English"), F.col("title")), lambda _k, v: v.isNotNull())
    discs = F.transform(F.sequence(F.lit(1).cast("bigint"), F.col("n_discs").cast("bigint")), lambda d: disc(album, d))
    return albums.select(
        "album_id", titles.alias("titles"), "catalog", parse_partial_date(F.col("release_date")).alias("release_date"),
        "classification", discs.alias("discs"),
    )


_GOLDEN_IN_ORDER = "select album_id, field, value, row_number() over (partition by album_id order by ord) as ord from v_golden"


@query("q1_canonical", _GOLDEN_IN_ORDER)
def canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.canonical(album_documents(spark, sf_dir)).withColumn("ord", F.col("ord").cast("bigint"))


@query("q2_canonical_golden", _GOLDEN_IN_ORDER)
def canonical_golden(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = album_documents(spark, sf_dir)
    fields = [F.col("album_id").alias("id"), *[F.col(c) for c in docs.columns if c != "album_id"]]
    texts = docs.select(F.to_json(F.struct(*fields)).alias("value"))
    golden = golden_documents(texts, ALBUM_SCHEMA).select(F.col("doc.id").alias("album_id"), "doc.*")
    return Q.canonical(golden).withColumn("ord", F.col("ord").cast("bigint"))


# third-party payloads: eight shapes by album, with parts missing, null or of a wrong type
_EXTERNAL = """concat('{', array_join(filter(array(
  case album_id % 8 when 0 then null when 1 then '"name": null' when 2 then '"name": {"ja": "J", "Romaji": "Rom"}' when 3 then '"name": 12'
    else concat('"name": "Album ', album_id, '"') end,
  case when album_id % 3 = 0 then '"names": {"Korean": "K1"}' end,
  case album_id % 5 when 0 then null when 1 then '"catalog": " "' when 2 then '"catalog": ["x"]' else concat('"catalog": "CAT-', album_id, '"') end,
  case when album_id % 4 <> 0 then '"release_date": "2001"' end,
  case album_id % 6 when 0 then '"discs": "none"' when 1 then '"discs": []' when 2 then '"discs": [{"tracks": ["One", {"names": {"en": "Two"}}, 3, {"title": "x"}]}, "bad", {"tracks": ["Last"]}]'
    when 3 then '"discs": [{"tracks": {"a": 1}}, {"tracks": [{"names": "Plain"}]}]' end),
  x -> x is not null), ', '), '}') as payload"""

CHECK_VIEWS["x_external_fields"] = """
select album_id, 'title' as field,
  case album_id % 8 when 0 then case when album_id % 3 = 0 then 'K1' end when 1 then null when 2 then 'Rom' when 3 then null else concat('Album ', album_id) end as value, 1 as ord from v_albums
union all select album_id, 'catalog', case when album_id % 5 in (3, 4) then concat('CAT-', album_id) end, 2 from v_albums
union all select album_id, 'release_date', case when album_id % 4 <> 0 then '2001' end, 3 from v_albums
union all select album_id, 'classification', null, 4 from v_albums
union all select album_id, r.field, r.value, r.ord from v_albums cross join (values ('disc1.track1.title', 'One', 5), ('disc1.track2.title', 'Two', 6),
  ('disc1.track3.title', null, 7), ('disc1.track4.title', null, 8), ('disc3.track1.title', 'Last', 9)) r(field, value, ord) where album_id % 6 = 2
union all select album_id, 'disc2.track1.title', 'Plain', 5 from v_albums where album_id % 6 = 3
"""


@query("q3_canonical_external", "select album_id, field, value, cast(ord as bigint) as ord from x_external_fields")
def canonical_external(spark: SparkSession, sf_dir: str) -> DataFrame:
    payloads = view(spark, sf_dir, "v_albums").selectExpr("album_id", _EXTERNAL)
    return Q.canonical_external(payloads).withColumn("ord", F.col("ord").cast("bigint"))


CHECK_VIEWS["x_scores"] = """
select source, album_id, field, golden, value, golden_ord, ord,
  case when gn is null and sn is null then 'absent' when gn is null then 'extra' when sn is null then 'missing' when gn = sn then 'match' else 'mismatch' end as status
from (
  select coalesce(e.source, s.source) as source, coalesce(e.album_id, s.album_id) as album_id, coalesce(e.field, s.field) as field, e.value as golden, s.value as value,
    e.ord as golden_ord, s.ord as ord, nullif(lower(trim(regexp_replace(e.value, '\\s+', ' ', 'g'))), '') as gn, nullif(lower(trim(regexp_replace(s.value, '\\s+', ' ', 'g'))), '') as sn
  from (select p.source, g.* from v_golden g join (select distinct source, album_id from v_source) p on p.album_id = g.album_id) e
  full outer join v_source s on s.source = e.source and s.album_id = e.album_id and s.field = e.field
) t
"""


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.score(view(spark, sf_dir, "v_source"), view(spark, sf_dir, "v_golden"))


@query("q4_score", "select source, album_id, field, golden, value, status from x_scores")
def score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scores(spark, sf_dir).select("source", "album_id", "field", "golden", "value", "status")


@query(
    "q5_agreement",
    """select source, album_id, count(*) filter (where status = 'match') as matches,
         count(*) filter (where status in ('match', 'mismatch', 'missing')) as scored from x_scores group by source, album_id""",
)
def agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.agreement(_scores(spark, sf_dir))


_SCORECARD = """select source, matches, scored, case when scored = 0 then 'n/a' else concat(cast(cast(round_even(100.0 * cast(matches as double) / scored, 0) as bigint) as varchar), '%') end as agreement
from (select source, count(*) filter (where status = 'match') as matches, count(*) filter (where status in ('match', 'mismatch', 'missing')) as scored from x_scores group by source) t"""


@query("q6_scorecard", _SCORECARD)
def scorecard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.scorecard(_scores(spark, sf_dir))


CHECK_VIEWS["x_coverage"] = """
select o.album_id, true as available, coalesce(c.tracks_with_credits, 0) as tracks_with_credits, coalesce(t.total_tracks, 0) as total_tracks, coalesce(c.total_credits, 0) as total_credits
from v_notes o
left join (select album_id, count(distinct number) as total_tracks from v_tracks group by album_id) t on t.album_id = o.album_id
left join (select album_id, count(distinct track) as tracks_with_credits, count(*) as total_credits from x_credits group by album_id) c on c.album_id = o.album_id
"""


@query("q7_coverage", "select album_id, available, tracks_with_credits, total_tracks, total_credits from x_coverage")
def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    notes = notes_view(spark, sf_dir)
    # the emitted credits still name tracks the album lacks; coverage leaves them out itself
    return Q.coverage(notes.select("album_id"), view(spark, sf_dir, "v_tracks"), N.emit(notes))


def _names(df: DataFrame) -> DataFrame:
    return df.withColumn("names", F.split("names", "\\|"))


# the matching done step by step, one golden credit per recursion
_MATCH_SQL = """
with recursive {ctes}
x_g as (select {keys}, role, list(names order by ord, names) as gs from {gold} group by {keys}, role),
x_p as (select {keys}, role, list(names order by ord, names) as ps from {prod} group by {keys}, role),
x_m as (
  select {keys}, role, gs, ps, 1 as i, cast([] as bigint[]) as used from x_g join x_p using ({keys}, role)
  union all
  select {keys}, role, gs, ps, i + 1, list_concat(used, list_filter(range(1, len(ps) + 1), lambda j: not list_contains(used, j)
      and ((len(gs[i]) = 0 and len(ps[j]) = 0) or list_has_any(gs[i], ps[j])))[1:1])
  from x_m where i <= len(gs)
),
x_matched as (select {keys}, sum(len(used)) as matched from x_m where i = len(gs) + 1 group by {keys}),
x_totals as (
  select {keys}, sum(p) as produced, sum(g) as golden from (
    select {keys}, 1 as p, 0 as g from {prod} union all select {keys}, 0, 1 from {gold}) t group by {keys}
)
select {keys}, cast(coalesce(matched, 0) as bigint) as matched, cast(produced as bigint) as produced, cast(golden as bigint) as golden
from x_totals left join x_matched using ({keys})
"""
CHECK_VIEWS["x_gold_lists"] = "select album_id, track, ord, role, list_filter(list_distinct(list_sort(string_split(lower(names), '|'))), lambda n: n <> '') as names from v_cred_gold"
CHECK_VIEWS["x_prod_lists"] = "select album_id, track, ord, role, list_filter(list_distinct(list_sort(string_split(lower(names), '|'))), lambda n: n <> '') as names from v_cred_prod"


def _match_check(gold: str, prod: str, keys: str, tail: str = "") -> str:
    """The recursive text is a view of its own, so that other texts can build on it."""
    return _MATCH_SQL.format(ctes="", gold=gold, prod=prod, keys=keys) + tail


CHECK_VIEWS["x_match_counts"] = _match_check("x_gold_lists", "x_prod_lists", "album_id, track")


@query("q8_match_credits", "select album_id, track, matched, produced, golden from x_match_counts")
def match_credits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.match_credits(_names(view(spark, sf_dir, "v_cred_prod")), _names(view(spark, sf_dir, "v_cred_gold")))


_PRF = """case when produced = 0 then 1.0 else round(matched / produced, 6) end as precision,
  case when golden = 0 then 1.0 else round(matched / golden, 6) end as recall,
  case when matched = 0 and produced > 0 and golden > 0 then 0.0
    when produced = 0 and golden = 0 then 1.0
    when produced = 0 then round(2.0 * 1.0 * (matched / golden) / (1.0 + matched / golden), 6)
    when golden = 0 then round(2.0 * 1.0 * (matched / produced) / (1.0 + matched / produced), 6)
    else round(2.0 * matched / (produced + golden), 6) end as f1"""
_PRF = _PRF.replace("1.0 else", "cast(1 as double) else").replace("then 0.0", "then cast(0 as double)").replace("then 1.0\n", "then cast(1 as double)\n")


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


@query("q9_prf", f"select album_id, track, matched, produced, golden, {_PRF} from x_match_counts")
def prf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(Q.with_prf(match_credits(spark, sf_dir)))


def golden_credits(mined: DataFrame) -> DataFrame:
    """A golden table for the mined credits: some left out, some under another role."""
    kept = mined.where((F.col("album_id") + F.col("track")) % 5 != 0)
    return kept.withColumn("role", F.when(F.col("album_id") % 7 == 0, "other").otherwise(F.col("role")))


CHECK_VIEWS["x_bgold"] = """
select b.backend, album_id, track, pos * 1000 + grp as ord, case when album_id % 7 = 0 then 'other' else role end as role,
  list_filter(list_distinct(list_sort(list_transform(names, lambda n: lower(n)))), lambda n: n <> '') as names
from x_credits cross join (values ('rules'), ('inline_only')) b(backend) where (album_id + track) % 5 <> 0
"""
CHECK_VIEWS["x_bprod"] = """
select backend, album_id, track, pos * 1000 + grp as ord, role,
  list_filter(list_distinct(list_sort(list_transform(names, lambda n: lower(n)))), lambda n: n <> '') as names
from x_backend_credits
"""
CHECK_VIEWS["x_backend_tracks"] = _match_check("x_bgold", "x_bprod", "backend, album_id, track")
CHECK_VIEWS["x_backend_scores"] = """
select backend, album_id, cast(sum(matched) as bigint) as matched, cast(sum(produced) as bigint) as produced, cast(sum(golden) as bigint) as golden
from (select backend, album_id, matched, produced, golden from x_backend_tracks
      union all select b.backend, album_id, 0, 0, 0 from v_notes cross join (values ('rules'), ('inline_only')) b(backend)) t
group by backend, album_id
"""
CHECK_VIEWS["x_ranking"] = f"""
select backend, album_id, matched, produced, golden, over_all, {_PRF} from (
  select backend, album_id, matched, produced, golden, false as over_all from x_backend_scores
  union all
  select backend, null, cast(sum(matched) as bigint), cast(sum(produced) as bigint), cast(sum(golden) as bigint), true from x_backend_scores group by backend
) t
"""


def _stored(spark: SparkSession) -> R.Keep:
    """The tables of a run in the shared folder."""
    return R.written(f"{shared_folder(spark).rstrip('/')}/sleevework/quality-{uuid.uuid4().hex}")


def _backend_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    notes, tracks = notes_view(spark, sf_dir), view(spark, sf_dir, "v_tracks")
    produced = _stored(spark)("credits", R.matching_columns(N.run_backends(notes, tracks), "backend"))
    golden = golden_credits(produced.where("backend = 'rules'").drop("backend"))
    return Q.score_backends(produced, golden, list(N.BACKENDS), notes.select("album_id"))


@query("q10_rank_backends", "select backend, album_id, matched, produced, golden, over_all, precision, recall, f1 from x_ranking")
def rank_backends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(Q.rank_backends(_backend_scores(spark, sf_dir)))


@query(
    "q11_nway_diff",
    """select album_id, field, max(golden) as golden,
         max(case when source = 'ours' then value end) as ours_value, max(case when source = 'ours' then status end) as ours_status,
         max(case when source = 'other' then value end) as other_value, max(case when source = 'other' then status end) as other_status,
         case when min(golden_ord) is null then min(case when source = 'ours' then 1 else 2 end) else 0 end::bigint as rank_place,
         coalesce(min(golden_ord), arg_min(ord, case when source = 'ours' then 1 else 2 end * 10000 + ord))::bigint as rank_ord
       from (select * from x_scores where album_id % 10 <> 3
             union all by name select null as source, album_id, field, value as golden, ord as golden_ord from v_golden where album_id % 10 = 3) t group by album_id, field""",
)
def nway_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One album in ten is in no source: its golden fields are in the diff all the same."""
    golden = view(spark, sf_dir, "v_golden")
    sources = view(spark, sf_dir, "v_source").where("album_id % 10 <> 3")
    return Q.nway_diff(Q.score(sources, golden, everywhere=True), SOURCES)


@query("q12_distinct_in_first_seen_order", "select o_orderpriority as name, min(o_orderkey) as first_seen from orders group by 1")
def distinct_in_first_seen_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("name"), "o_orderkey")
    return Q.distinct_in_first_seen_order(rows, "name", "o_orderkey")


# what a curated table says about the albums of the composed pages, some of which cannot be read
VIEWS["v_page_golden"] = """
select p_partkey as album_id, 'catalog' as field, concat('CAT-', p_partkey) as value, 1 as ord from part
union all select p_partkey, 'release_date', cast(1990 + p_size % 30 as varchar(4)), 2 from part
union all select p_partkey, 'classification', concat(p_type, ', VOCAL'), 3 from part
union all select p_partkey, 'disc1.track1.title', concat('E', p_partkey, case when p_partkey % 3 = 0 then '-0-1' else '-1-1' end), 4 from part
"""
VIEWS["v_page_other"] = """
select 'other' as source, album_id, field, case when album_id % 9 = 1 then null else value end as value, ord from v_page_golden where album_id % 4 <> 0
"""
VIEWS["v_page_credits"] = """
select p_partkey as album_id, cast(1 as bigint) as track, 1 as ord, case when p_partkey % 5 = 0 then 'arranger' else 'composer' end as role, upper(p_brand) as names from part where p_partkey % 4 in (0, 3)
union all select p_partkey, cast(2 as bigint), 1, 'composer', concat('X|', p_brand) from part where p_partkey % 4 in (0, 3)
"""
CHECK_VIEWS["x_page_fields"] = """
select id as album_id, 'title' as field, coalesce(english, romaji, japanese) as value, 1 as ord from x_good_parts
union all select id, 'catalog', case when id % 11 <> 0 then concat('CAT-', id) when id % 13 = 0 then 'OLD' end, 2 from x_good_parts
union all select g.id, 'release_date', printf('%04d', year) || case when month is null then '' else printf('-%02d', month) end || case when day is null then '' else printf('-%02d', day) end, 3
  from x_good_parts g join x_part_dates d on d.id = g.id
union all select id, 'classification', concat(p_type, ', Vocal'), 4 from x_good_parts
union all select m.id, concat('disc', dense_rank() over (partition by m.id order by d), '.track', row_number() over (partition by m.id, d order by pos), '.title'), coalesce(m.english, m.japanese), 5
  from x_merged m join x_good_parts g on g.id = m.id
"""
CHECK_VIEWS["x_page_sources"] = """
select 'ours' as source, album_id, field, value from x_page_fields union all select source, album_id, field, value from v_page_other
"""
CHECK_VIEWS["x_page_scores"] = """
select coalesce(e.source, s.source) as source, coalesce(e.album_id, s.album_id) as album_id, coalesce(e.field, s.field) as field, e.field is not null as golden, lower(e.value) as gn, lower(s.value) as sn
from (select p.source, g.* from v_page_golden g join (select distinct source, album_id from x_page_sources) p on p.album_id = g.album_id) e
full outer join x_page_sources s on s.source = e.source and s.album_id = e.album_id and s.field = e.field
"""
CHECK_VIEWS["x_page_produced"] = """
select g.id as album_id, t.t as track from x_good_parts g cross join (values (1), (2)) t(t)
where g.id % 4 in (0, 3) and exists (select 1 from x_merged m where m.id = g.id and m.number = t.t)
"""


CHECK_VIEWS["x_page_card"] = "select source, count(*) filter (where gn = sn) as matches, count(*) filter (where gn is not null) as scored from x_page_scores group by source"
CHECK_VIEWS["x_page_made"] = "select count(*) as produced, count(*) filter (where not (track = 1 and album_id % 5 = 0)) as matched from x_page_produced"
CHECK_VIEWS["x_page_wanted"] = "select count(*) as golden from v_page_credits"


@query(
    "q13_quality_run",
    """
select 'scorecard' as section, source as name, matches, scored, cast(null as double) as precision, cast(null as double) as recall from x_page_card
union all select 'enrichment', 'rules', matched, golden, round(matched / produced, 6), round(matched / golden, 6) from x_page_made, x_page_wanted
union all select 'enrichment', 'inline_only', 0, golden, 1.0, 0.0 from x_page_wanted
union all select 'coverage', 'rules', (select count(*) from x_page_produced), (select count(distinct (m.id, number)) from x_merged m join x_good_parts g on g.id = m.id), null, null
union all select 'diff', 'fields', (select count(*) from (select album_id, field from v_page_golden union select album_id, field from x_page_sources) t), (select count(*) from v_page_golden), null, null""",
)
def quality_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From composed pages to the figures of a run; the run stores each of its tables in the shared folder."""
    tables = R.run_from_pages(
        pages=composed_pages.album_pages(spark, sf_dir), golden=view(spark, sf_dir, "v_page_golden"), golden_credits=_names(view(spark, sf_dir, "v_page_credits")).withColumn("ord", F.array("ord", F.lit(0))),
        others=view(spark, sf_dir, "v_page_other"), names=SOURCES, keep=_stored(spark),
    )
    return R.summary(tables).withColumns({c: F.round(c, 6) for c in ("precision", "recall")})


@query(
    "q14_first_n",
    """select o_custkey as query, o_orderkey as id, rank from (
         select o_custkey, o_orderkey, row_number() over (partition by o_custkey order by o_orderkey) as rank from orders) t where rank <= 10""",
)
def first_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("query"), F.col("o_orderkey").alias("id"))
    return R.first_n(hits, "query", "id", 10).withColumn("rank", F.col("rank").cast("bigint"))


