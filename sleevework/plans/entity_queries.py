"""Queries over whole entity records and the edges between them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sleevework.functions.dates import iso
from sleevework.operators import pages as P
from sleevework.plans import composed_pages as pages
from sleevework.plans.page_queries import _big, _text_of
from sleevework.plans.registry import CHECK_VIEWS, query, table

CHECK_VIEWS["x_good_parts"] = """
select l.id, p.*, english, japanese, romaji from x_localized l join part p on p.p_partkey = l.id
where l.id % 17 <> 0 and l.id % 19 <> 0 and (english is not null or japanese is not null or romaji is not null)
"""
_ISO = "printf('%04d', year) || case when month is null then '' else printf('-%02d', month) end || case when day is null then '' else printf('-%02d', day) end"
_NAMES = "concat_ws('|', 'English=' || english, 'Japanese=' || japanese, 'Romaji=' || romaji)"


@query("p18_assemble_album", f"""
select g.id, {_NAMES} as titles, case when g.id % 11 <> 0 then concat('CAT-', g.id) when g.id % 13 = 0 then 'OLD' end as catalog, {_ISO} as released,
  concat(p_type, ', Vocal') as classification, concat('https://thumb-media.example.org/albums/9/', g.id, '/s.jpg') as cover_small,
  coalesce(t.n_discs, 0) as n_discs, coalesce(t.n_tracks, 0) as n_tracks, coalesce(t.numbers, 0) as numbers, 1 + case when g.id % 3 <> 0 then 1 else 0 end as n_credits, a.n_artists,
  case when g.id % 4 in (0, 3) then length('Tracks 1~2') + length(p_brand) + length('Composed by  & Co') + 12 end as notes_chars,
  case g.id % 4 when 0 then g.id % 50 when 1 then 3 end as event_id
from x_good_parts g join x_part_dates d on d.id = g.id
left join (select id, count(distinct d) as n_discs, count(*) as n_tracks, cast(sum(number) as bigint) as numbers from x_merged group by id) t on t.id = g.id
left join (select id, count(*) as n_artists from x_credit_artists group by id) a on a.id = g.id
""".replace("1 + case when g.id % 3 <> 0 then 1 else 0 end as n_credits", "cast(1 + case when g.id % 3 <> 0 then 1 else 0 end as bigint) as n_credits"))
def assemble_album(spark: SparkSession, sf_dir: str) -> DataFrame:
    albums = P.album_records(pages.album_pages(spark, sf_dir))
    tracks = F.flatten(F.transform("discs", lambda d: d["tracks"]))
    return albums.select(
        "id", _text_of(F.col("titles")).alias("titles"), "catalog", iso(F.col("release_date")).alias("released"), "classification", "cover_small",
        F.size("discs").cast("bigint").alias("n_discs"), F.size(tracks).cast("bigint").alias("n_tracks"),
        F.aggregate(tracks, F.lit(0).cast("bigint"), lambda s, t: s + t["number"]).alias("numbers"),
        F.size("credits").cast("bigint").alias("n_credits"), F.size(F.flatten(F.transform("credits", lambda c: c["artists"]))).cast("bigint").alias("n_artists"),
        F.length("notes").cast("bigint").alias("notes_chars"), F.col("release_event.id").alias("event_id"),
    )


@query("p18_artist_records", """
select c_custkey as id, case when c_custkey % 4 = 0 then concat('Japanese=悪魔 ', c_custkey) else concat('English=', c_name) end as names, concat(c_mktsegment, '|A.&', c_custkey) as aliases,
  case c_custkey % 3 when 0 then '1970-03-03' when 1 then '1971' end as born, cast(2 as bigint) as n_members, cast(case when c_custkey % 2 = 0 then 1 else 0 end as bigint) as n_units, cast(null as varchar) as type
from customer where c_custkey % 17 <> 0 and c_custkey % 19 <> 0
""")
def artist_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = P.artist_records(pages.artist_pages(spark, sf_dir))
    return rows.select(
        "id", _text_of(F.col("names")).alias("names"), F.array_join("aliases", "|").alias("aliases"), iso(F.col("birthdate")).alias("born"),
        F.size("members").cast("bigint").alias("n_members"), F.size("units").cast("bigint").alias("n_units"), "type",
    )


CHECK_VIEWS["x_product_orgs"] = """
select id, ord, name, org, row_number() over (partition by id order by ord) - 1 as pos from (
  select id, 0 as ord, concat('Dev ', p_size % 5) as name, p_size % 5 as org from x_good_parts
  union all select id, 1, 'NoId', null from x_good_parts
  union all select id, 2, 'NoId', null from x_good_parts
  union all select id, 3, concat('Pub ', p_size % 3), p_size % 3 from x_good_parts where p_size % 5 <> p_size % 3
  union all select id, 4, 'Pub 9', 9 from x_good_parts) t
"""


@query("p18_product_records", f"""
select g.id, {_NAMES} as names, concat('https://example.org/product/', g.id) as link, cast(2 as bigint) as n_franchises, o.orgs
from x_good_parts g join (select id, string_agg(concat(name, ':', coalesce(cast(org as varchar), '')), '|' order by pos) as orgs from x_product_orgs group by id) o on o.id = g.id
""")
def product_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = P.product_records(pages.product_pages(spark, sf_dir))
    orgs = F.transform("organizations", lambda o: F.concat(o["names"]["English"], F.lit(":"), F.coalesce(o["id"].cast("string"), F.lit(""))))
    return rows.select("id", _text_of(F.col("names")).alias("names"), "link", F.size("franchises").cast("bigint").alias("n_franchises"), F.array_join(orgs, "|").alias("orgs"))


@query("p18_organization_records", """
select s_suppkey as id, concat('English=', s_name) as names, n_name as type, case when s_suppkey % 3 <> 0 then concat('A & B', s_suppkey, ' !é') end as notes
from supplier join nation on s_nationkey = n_nationkey where s_suppkey % 17 <> 0 and s_suppkey % 19 <> 0
""")
def organization_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = P.organization_records(pages.org_pages(spark, sf_dir))
    return rows.select("id", _text_of(F.col("names")).alias("names"), "type", "notes")


@query("p18_event_records", f"""
select id, concat_ws('|', case when id % 19 <> 0 then concat('English=Event ', id) end, case when id % 3 = 0 then 'Japanese=祭り' end) as names,
  {_ISO} as starts, cast(null as varchar) as ends
from x_any_dates where id % 17 <> 0 and not (id % 19 = 0 and id % 3 <> 0)
""")
def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = P.event_records(pages.event_pages(spark, sf_dir))
    return rows.select("id", _text_of(F.col("names")).alias("names"), iso(F.col("start_date")).alias("starts"), iso(F.col("end_date")).alias("ends"))


CHECK_VIEWS["x_edges"] = """
select 'album' as src_kind, g.id as src, 'credit' as rel, row_number() over (partition by g.id order by credit, pos) - 1 as pos, artist_id as dst_id, a.name as name from x_good_parts g join x_credit_artists a on a.id = g.id
union all select 'album', id, 'release_event', 0, case id % 4 when 0 then id % 50 else 3 end, case id % 4 when 0 then concat('English=Fest ', id % 50) else 'Japanese=祭り' end from x_good_parts where id % 4 in (0, 1)
union all select 'artist', c_custkey, 'members', 0, c_custkey + 1, concat('English=M', c_custkey) from customer where c_custkey % 17 <> 0 and c_custkey % 19 <> 0
union all select 'artist', c_custkey, 'members', 1, null, 'English=NoId' from customer where c_custkey % 17 <> 0 and c_custkey % 19 <> 0
union all select 'artist', c_custkey, 'units', 0, c_custkey + 2, concat('English=U <', c_custkey) from customer where c_custkey % 17 <> 0 and c_custkey % 19 <> 0 and c_custkey % 2 = 0
union all select 'product', id, 'franchises', 0, id + 1, concat('English=', p_brand, '|Romaji=R ', p_brand) from x_good_parts
union all select 'product', id, 'franchises', 1, 5, concat('English=Plain ', id) from x_good_parts
union all select 'product', id, 'organizations', pos, org, concat('English=', name) from x_product_orgs
"""


@query("p15_entity_edges", "select src_kind, src, rel, cast(pos as bigint) as pos, cast(dst_id as bigint) as dst_id, name from x_edges")
def entity_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = P.edges(
        P.album_records(pages.album_pages(spark, sf_dir)), P.artist_records(pages.artist_pages(spark, sf_dir)), P.product_records(pages.product_pages(spark, sf_dir))
    )
    return rows.select("src_kind", "src", "rel", *_big("pos"), "dst_id", _text_of(F.col("names")).alias("name"))


@query("p15b_orgs_merge_dedupe", """
select src, dst_id, field_ord, pos from (
  select l_orderkey as src, case when l_suppkey % 5 = 0 then null else l_suppkey % 7 end as dst_id, l_linenumber % 2 as field_ord, l_partkey * 10000 + l_suppkey as pos,
    row_number() over (partition by l_orderkey, case when l_suppkey % 5 = 0 then null else l_suppkey % 7 end order by l_linenumber % 2, l_partkey * 10000 + l_suppkey) as n
  from (select distinct l_orderkey, l_suppkey, l_linenumber % 2 as l_linenumber, l_partkey from lineitem) d) t where n = 1 or dst_id is null
""".replace("l_linenumber % 2 as field_ord", "cast(l_linenumber as bigint) as field_ord"))
def orgs_merge_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey as src", "case when l_suppkey % 5 <> 0 then l_suppkey % 7 end as dst_id", "cast(l_linenumber % 2 as bigint) as field_ord", "l_partkey * 10000 + l_suppkey as pos"
    )
    return P.merge_edges(lines)
