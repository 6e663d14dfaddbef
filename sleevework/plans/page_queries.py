"""Queries over the page readers: real pages first, then pages composed from tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sleevework.functions import html as H
from sleevework.functions import web
from sleevework.functions.core import blank_to_null
from sleevework.operators import pages as P
from sleevework.plans import composed_pages as pages
from sleevework.plans.registry import CHECK_VIEWS, by_key, query, table, view
from sleevework.sources.scan import scan_pages

CHECK_VIEWS["x_clean"] = """
select page_id, url, regexp_replace(html, '(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->', '', 'g') as html from pages
"""


def _decoded(text: str) -> str:
    out = text
    for name, char in (("middot", "·"), ("copy", "©"), ("quot", '"'), ("lt", "<"), ("gt", ">"), ("amp", "&")):
        out = f"replace({out}, '&{name};', '{char}')"
    return out


def _text(fragment: str) -> str:
    bare = f"regexp_replace({fragment}, '<[^>]*>', '', 'g')"
    return f"trim(regexp_replace({_decoded(bare)}, '\\s+', ' ', 'g'))"


def _real(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_key(scan_pages(spark, f"{sf_dir}/pages.parquet"), "page_id")


def _big(*names: str) -> list[Column]:
    return [F.col(n).cast("bigint").alias(n) for n in names]


def _parts(date: str) -> list[Column]:
    return [F.col(f"{date}.{p}").cast("bigint").alias(p) for p in ("year", "month", "day")]


def _text_of(names: Column) -> Column:
    """A language map as text, because maps do not compare."""
    return F.concat_ws("|", F.transform(F.map_entries(names), lambda e: F.concat(e["key"], F.lit("="), e["value"])))


@query("p2_tokenise", f"""
select page_id, u.pos - 1 as pos, case when u.tok like '<%' then u.tok else {_decoded('u.tok')} end as tok,
  case when u.tok like '<%' then lower(regexp_extract(u.tok, '^</?\\s*([A-Za-z][A-Za-z0-9]*)', 1)) end as tag, u.tok like '</%' as is_close
from (select page_id, regexp_extract_all(html, '<[^>]+>|[^<]+') as toks from x_clean) t, unnest(t.toks) with ordinality as u(tok, pos)
""")
def tokenise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.tokenise(_real(spark, sf_dir)).select("page_id", *_big("pos"), "tok", "tag", "is_close")


@query("p3_node_text", f"""
select page_id, {_text("regexp_extract(html, '(?is)<title>(.*?)</title>', 1)")} as title, {_text("regexp_extract(html, '(?is)<h1>(.*?)</h1>', 1)")} as h1, '' as missing from x_clean
""")
def node_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = F.col("html")
    one = lambda tag: H.text(H.inner(F.get(H.elements(page, tag), F.lit(0))))
    return P.cleaned(_real(spark, sf_dir)).select("page_id", one("title").alias("title"), one("h1").alias("h1"), one("blink").alias("missing"))


@query("p8_heading_name", f"""
select page_id, t as name, case when regexp_matches(t, '[\\x{{3040}}-\\x{{30ff}}\\x{{3400}}-\\x{{4dbf}}\\x{{4e00}}-\\x{{9fff}}\\x{{ff00}}-\\x{{ffef}}]') then 'Japanese' else 'English' end as lang
from (select page_id, {_text("regexp_extract(html, '(?is)<h1>(.*?)</h1>', 1)")} as t from x_clean) t
""")
def heading_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = P.cleaned(_real(spark, sf_dir)).select("page_id", P.heading_name(F.col("html")).alias("n"))
    return rows.select("page_id", F.get(F.map_values("n"), F.lit(0)).alias("name"), F.get(F.map_keys("n"), F.lit(0)).alias("lang"))


CHECK_VIEWS["x_links"] = f"""
select page_id, u.pos - 1 as pos, {_decoded("regexp_extract(u.a, 'href=\"([^\"]*)\"', 1)")} as href, {_text('u.a')} as text
from (select page_id, regexp_extract_all(html, '(?is)<a\\b[^>]*href\\s*=[^>]*>.*?</a>') as links from x_clean) t, unnest(t.links) with ordinality as u(a, pos)
"""


@query("p15_refs", "select page_id, pos, href, text from x_links")
def refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.page_links(_real(spark, sf_dir)).select("page_id", *_big("pos"), "href", "text")


_ABSOLUTE = "case when {h} = '' then null when {h} like 'http://%' or {h} like 'https://%' then {h} when {h} like '/%' then 'https://example.org' || {h} else 'https://example.org/' || {h} end"


@query("p15c_absolute_url", f"""
select page_id, pos, {_ABSOLUTE.format(h='href')} as link, {_ABSOLUTE.format(h="split_part(href, '?', 1)")} as ref from x_links
union all select o_orderkey, -1, {_ABSOLUTE.format(h='h')}, {_ABSOLUTE.format(h="split_part(h, '?', 1)")}
from (select o_orderkey, case o_orderkey % 4 when 0 then '' when 1 then concat('org/', o_orderkey, '?tab=x') when 2 then concat('http://a.org/', o_orderkey, '?q=1?2') else null end as h from orders) t
""")
def absolute_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    real = P.page_links(_real(spark, sf_dir)).select("page_id", *_big("pos"), "link", "ref")
    href = F.expr("case o_orderkey % 4 when 0 then '' when 1 then concat('org/', o_orderkey, '?tab=x') when 2 then concat('http://a.org/', o_orderkey, '?q=1?2') end")
    made = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("page_id"), F.lit(-1).cast("bigint").alias("pos"), href.alias("h"))
    return real.unionByName(made.select("page_id", "pos", web.absolute_url(F.col("h"), P.DEFAULT_SITE).alias("link"), web.ref_link(F.col("h"), P.DEFAULT_SITE).alias("ref")))


@query("p19_notes_text", f"""
select page_id, md5(nullif(trim({_decoded("regexp_replace(regexp_replace(regexp_extract(html, '(?is)<article>(.*?)</article>', 1), '(?i)<br\\s*/?>', chr(10), 'g'), '<[^>]*>', '', 'g')")}, ' ' || chr(9) || chr(10) || chr(13)), '')) as notes_md5 from x_clean
""")
def notes_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = P.cleaned(_real(spark, sf_dir))
    return rows.select("page_id", F.md5(H.plain_notes(H.container(F.col("html"), "article", ""))).alias("notes_md5"))


# -- composed pages --------------------------------------------------------------------------------

CHECK_VIEWS["x_routes"] = """
select 'org' as page_kind, s_suppkey as id, s_name as name, s_suppkey % 19 = 0 as nameless from supplier
union all select 'artist', c_custkey, case when c_custkey % 4 = 0 then concat('悪魔 ', c_custkey) else c_name end, c_custkey % 19 = 0 from customer
union all select 'product', id, null, id % 19 = 0 or (english is null and japanese is null and romaji is null) from x_localized
union all select 'album', id, null, id % 19 = 0 or (english is null and japanese is null and romaji is null) from x_localized
union all select 'event', o_orderkey, concat('Event ', o_orderkey), o_orderkey % 19 = 0 and o_orderkey % 3 <> 0 from orders
"""


@query("p1_route_pages", """
select page_kind, id as page_id, case when id % 17 <> 0 then page_kind end as kind, case when id % 17 <> 0 then id end as entity_id,
  case when id % 17 = 0 then 'no canonical link' when nameless then 'no name' end as reason from x_routes
union all select 'search', c_custkey, case when c_custkey % 10 <> 9 then 'search' end, null, case when c_custkey % 10 = 9 then 'no canonical link' end from customer
union all select 'real', page_id, null, null, 'no canonical link' from pages
""")
def route_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = {
        "org": pages.org_pages, "artist": pages.artist_pages, "product": pages.product_pages, "album": pages.album_pages,
        "event": pages.event_pages, "search": pages.search_pages, "real": _real,
    }
    out = None
    for name, make in inputs.items():
        rows = make(spark, sf_dir).withColumn("page_kind", F.lit(name))
        out = rows if out is None else out.unionByName(rows)
    return P.route_pages(out, keep=("page_kind",)).select("page_kind", "page_id", "kind", "entity_id", "reason")


@query("p4_localized_text", """
select id, english, japanese, romaji, id % 7 = 0 as repeated
from (select id, case when id % 7 = 0 then 'later' else english end as english, japanese, case when id % 7 = 0 and english is null then romaji when id % 7 = 0 and romaji = 'later' then null else romaji end as romaji
  from (select l.id, english, japanese, case when v.romaji <> '' and v.romaji <> case when v.id % 7 = 0 then 'later' else v.en end then v.romaji end as romaji from x_localized l join v_localized v on v.id = l.id) t) u
""")
def localized_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    again = F.when(F.col("id") % 7 == 0, F.lit('<span class="albumtitle" lang="en">later</span>')).otherwise(F.lit(""))
    spans = F.concat(F.expr(pages.language_spans("albumtitle", "en", "ja", "romaji")), again)
    rows = view(spark, sf_dir, "v_localized").select("id", H.localized(H.language_spans(spans, "albumtitle")).alias("t"), (F.col("id") % 7 == 0).alias("repeated"))
    return rows.select("id", *[F.col("t")[k].alias(k.lower()) for k in ("English", "Japanese", "Romaji")], "repeated")


@query("p6_leading_group", """
select o_orderkey as id, case when o_orderkey % 3 = 0 then 'en,-,ja' else 'en,-' end as langs from orders
""")
def leading_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    group = H.leading_group(H.language_spans(F.col("html"), "albumtitle"))
    rows = P.cleaned(pages.event_pages(spark, sf_dir)).select(F.col("page_id").alias("id"), group.alias("g"))
    return rows.select("id", F.array_join(F.transform("g", lambda s: F.coalesce(s["lang"], F.lit("-"))), ",").alias("langs"))


CHECK_VIEWS["x_part_dates"] = """
select p_partkey as id, 1990 + p_size % 30 as y,
  case p_partkey % 4 when 0 then case when 1 + p_partkey % 13 <= 12 then 1990 + p_size % 30 end when 1 then 1990 + p_size % 30 when 2 then 1990 + p_size % 30 end as year,
  case p_partkey % 4 when 0 then case when 1 + p_partkey % 13 <= 12 then 1 + p_partkey % 13 end when 1 then 3 end as month,
  case p_partkey % 4 when 0 then case when 1 + p_partkey % 13 <= 12 then 5 end when 1 then 1 + p_partkey % 9 end as day
from part
"""


@query("p7_info_fields", """
select p_partkey as id, 'Catalog Number' as label, case when p_partkey % 11 = 0 then 'OLD' else concat('CAT-', p_partkey) end as value, case when p_partkey % 11 <> 0 then '/x' end as href from part where p_partkey % 11 <> 0 or p_partkey % 13 = 0
union all select p_partkey, 'Release Date', case p_partkey % 4 when 0 then 'Jan 5' when 1 then concat('Mar 0', 1 + p_partkey % 9, ', ', 1990 + p_size % 30) when 2 then cast(1990 + p_size % 30 as varchar) else 'TBA' end,
  case when p_partkey % 4 = 0 then concat('/db/calendar.php?year=', 1990 + p_size % 30, '&month=1#', 1990 + p_size % 30, lpad(cast(1 + p_partkey % 13 as varchar), 2, '0'), '05') end from part
union all select p_partkey, 'Classification', concat(p_type, ', Vocal'), null from part
""")
def info_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = P.cleaned(pages.album_pages(spark, sf_dir)).select(F.col("page_id").alias("id"), F.explode(P.info_fields(F.col("html"))).alias("f"))
    return rows.select("id", "f.label", "f.value", "f.href")


@query("p7b_first_fields", """
select 'org' as source, s_suppkey as id, 'Type' as label, n_name as value from supplier join nation on s_nationkey = n_nationkey
union all select 'org', s_suppkey, 'Description', case when s_suppkey % 3 <> 0 then concat('A & B', s_suppkey, ' !é') end from supplier
union all select 'artist', c_custkey, 'Birthdate', case c_custkey % 3 when 0 then 'Mar 03, 1970' when 1 then '1971' else 'unknown' end from customer
""")
def first_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = P.cleaned(pages.org_pages(spark, sf_dir)).select("page_id", P.label_pairs(F.col("html")).alias("f"))
    orgs = pairs.select(F.lit("org").alias("source"), F.col("page_id").alias("id"), F.explode(F.array(
        *[F.struct(F.lit(n).alias("label"), blank_to_null(H.text(P.definition(F.col("f"), n))).alias("value")) for n in ("Type", "Description")])).alias("r"))
    fields = P.cleaned(pages.artist_pages(spark, sf_dir)).select("page_id", F.explode(P.artist_fields(F.col("html"))).alias("f"))
    artists = fields.where("f.label = 'Birthdate'").select(F.lit("artist").alias("source"), F.col("page_id").alias("id"), F.struct("f.label", blank_to_null(H.text(F.col("f.body"))).alias("value")).alias("r"))
    return orgs.unionByName(artists).select("source", "id", "r.label", "r.value")


@query("p9_aliases", "select c_custkey as id, 0 as pos, c_mktsegment as alias from customer union all select c_custkey, 1, concat('A.&', c_custkey) from customer")
def aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = P.cleaned(pages.artist_pages(spark, sf_dir)).select("page_id", P.artist_fields(F.col("html")).alias("f"))
    body = F.get(F.filter("f", lambda f: f["label"] == "Aliases"), F.lit(0))["body"]
    return rows.select(F.col("page_id").alias("id"), F.posexplode(P.aliases(body)).alias("pos", "alias"))


@query("p10_cover_url", """
select p_partkey as id, concat('https://medium-media.example.org/albums/9/', p_partkey, '/c.jpg') as full_url, concat('https://thumb-media.example.org/albums/9/', p_partkey, '/s.jpg') as thumb_url from part
""")
def cover_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    page, key = F.col("html"), F.col("page_id")
    return P.cleaned(pages.album_pages(spark, sf_dir)).select(
        key.alias("id"), P.cover_url(page, "medium-media.example.org", key).alias("full_url"), P.cover_url(page, "thumb-media.example.org", key).alias("thumb_url")
    )


@query("p11_release_event", """
select p_partkey as id, case p_partkey % 4 when 0 then concat('English=Fest ', p_partkey % 50) when 1 then 'Japanese=祭り' end as name,
  case p_partkey % 4 when 0 then p_partkey % 50 when 1 then 3 end as event_id,
  case p_partkey % 4 when 0 then concat('https://example.org/event/', p_partkey % 50) when 1 then 'https://example.org/event/3' end as link from part
""")
def release_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = P.cleaned(pages.album_pages(spark, sf_dir)).select(F.col("page_id").alias("id"), P.release_event(F.col("html")).alias("e"))
    return rows.select("id", F.when(F.col("e").isNotNull(), _text_of(F.col("e.names"))).alias("name"), F.col("e.id").alias("event_id"), "e.link")


CHECK_VIEWS["x_discs"] = """
select p_partkey as id, d.d, case when p_partkey % 3 = 0 then 1 else d.d + 1 end as number, case when p_partkey % 3 <> 0 then concat('Disc ', d.d + 1) end as name
from part cross join (values (0), (1), (2)) d(d)
where case when p_partkey % 3 = 0 then d.d = 0 else d.d between 1 and p_partkey % 3 end
"""
CHECK_VIEWS["x_raw_tracks"] = """
select id, d, number as disc_number, name, case when id % 3 = 0 and id % 7 = 0 then t.t + 1 else t.t end as pos, t.t as number, case when t.t % 2 = 0 then concat(t.t, ':0', d) end as length,
  concat('E', id, '-', d, '-', t.t) as title
from x_discs cross join (values (1), (2), (3), (4), (5)) t(t) where t.t <= (id + d) % 4 + 1 + case when id % 6 = 2 then 1 else 0 end
union all select id, d, 1, null, 1, 99, null, 'Stray' from x_discs where id % 3 = 0 and id % 7 = 0
"""


CHECK_VIEWS["x_every_tab"] = """
select id, b.tab, d, number as disc_number, name, case when id % 3 = 0 and id % 7 = 0 then t.t + 1 else t.t end as pos, t.t as number, case when t.t % 2 = 0 then concat(t.t, ':0', d) end as length,
  case when b.tab = 2 and t.t = 1 then concat('曲 ', id, '-', d) else concat(case b.tab when 3 then 'X' else 'E' end, id, '-', d, '-', t.t) end as title
from x_discs cross join (values (1), (2), (3)) b(tab) cross join (values (1), (2), (3), (4), (5)) t(t)
where t.t <= (id + d) % 4 + 1 + case when b.tab = 1 and id % 6 = 2 then 1 else 0 end and (b.tab < 3 or id % 5 = 0)
union all select id, b.tab, d, 1, null, 1, 99, null, 'Stray' from x_discs cross join (values (1), (2), (3)) b(tab)
where id % 3 = 0 and id % 7 = 0 and (b.tab < 3 or id % 5 = 0)
"""


def _disc_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, tab, disc_ord, d): the discs of every tracklist tab."""
    tabs = H.containers(F.col("html"), "span", 'class="tl"')
    rows = P.cleaned(pages.album_pages(spark, sf_dir)).select(F.col("page_id").alias("id"), F.posexplode(tabs).alias("at", "t"))
    rows = rows.select("id", (F.col("at") + 1).alias("tab"), F.posexplode(P.disc_groups(F.col("t.inner"))).alias("pos", "d"))
    return rows.select("id", "tab", (F.col("pos") + 1).cast("bigint").alias("disc_ord"), "d")


@query("p12_disc_groups", """
select id, tab, row_number() over (partition by id, tab order by d) as disc_ord, disc_number as number, name, n from (
  select id, tab, d, disc_number, name, count(*) as n from x_every_tab group by id, tab, d, disc_number, name) t
""")
def disc_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _disc_rows(spark, sf_dir)
    return rows.select("id", "tab", "disc_ord", F.col("d.number").alias("number"), "d.name", F.size("d.tracks").cast("bigint").alias("n"))


@query("p13_raw_track", "select id, tab, cast(disc_number as int) as disc, cast(pos as bigint) as pos, cast(number as int) as number, length, title from x_every_tab")
def raw_track(spark: SparkSession, sf_dir: str) -> DataFrame:
    tracks = _disc_rows(spark, sf_dir).select("id", "tab", F.col("d.number").alias("disc"), F.posexplode("d.tracks").alias("pos", "t"))
    return tracks.select("id", "tab", "disc", (F.col("pos") + 1).cast("bigint").alias("pos"), "t.number", "t.length", "t.title")


# the tab that speaks for English, and whether Japanese leads
CHECK_VIEWS["x_tabs"] = """
select p_partkey as id, 'English' as label, case when p_partkey % 2 <> 0 then 0 when p_partkey % 5 = 0 then 2 else 0 end as pos, p_partkey % 2 <> 0 or p_partkey % 5 = 0 as canonical from part
union all select p_partkey, 'Japanese', 1, true from part
"""


@query("p14_choose_tabs", "select id, label, cast(pos as int) as pos, canonical, row_number() over (partition by id order by not canonical, pos) = 1 as is_primary from x_tabs")
def choose_tabs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = P.cleaned(pages.album_pages(spark, sf_dir)).select(F.col("page_id").alias("id"), F.posexplode(P.choose_tabs(F.col("html"))).alias("i", "t"))
    return rows.select("id", "t.label", "t.pos", "t.canonical", (F.col("i") == 0).alias("is_primary"))


# tracks of each tab: tab 1 may have one more than the others; stray rows lead a bare list
CHECK_VIEWS["x_tab_tracks"] = """
select r.id, tb.tab, r.d, r.pos, r.number, r.length,
  case when r.title = 'Stray' then 'Stray' when tb.tab = 1 then r.title when tb.tab = 3 then concat('X', r.id, '-', r.d, '-', r.number) when r.number = 1 then concat('曲 ', r.id, '-', r.d) else r.title end as title
from x_raw_tracks r cross join (values (1), (2), (3)) tb(tab)
where r.title = 'Stray' or tb.tab = 1 or r.number <= (r.id + r.d) % 4 + 1
"""
CHECK_VIEWS["x_merged"] = """
select p.id, p.d, p.pos, p.number, p.length, en.title as english,
  case when ja.title <> '' and regexp_matches(ja.title, '[\\x{4e00}-\\x{9fff}]') then ja.title end as japanese
from (select t.* from x_tab_tracks t join (select id, case when id % 2 = 0 then 2 else 1 end as tab from x_tabs where label = 'English') k on k.id = t.id and k.tab = t.tab) p
left join (select t.* from x_tab_tracks t join (select id, pos + 1 as tab from x_tabs where label = 'English') k on k.id = t.id and k.tab = t.tab) en on en.id = p.id and en.d = p.d and en.pos = p.pos
left join x_tab_tracks ja on ja.tab = 2 and ja.id = p.id and ja.d = p.d and ja.pos = p.pos
"""


@query("p14b_merge_tabs_by_position", """
select id, dense_rank() over (partition by id order by d) as disc_ord, cast(pos as bigint) as pos, cast(number as int) as number, length, english, japanese from x_merged
""")
def merge_tabs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = P.cleaned(pages.album_pages(spark, sf_dir)).select(F.col("page_id").alias("id"), F.posexplode(P.discs(F.col("html"))).alias("d", "disc"))
    tracks = rows.select("id", (F.col("d") + 1).cast("bigint").alias("disc_ord"), F.posexplode("disc.tracks").alias("pos", "t"))
    titles = F.col("t.titles")
    return tracks.select("id", "disc_ord", (F.col("pos") + 1).cast("bigint").alias("pos"), "t.number", "t.length", titles["English"].alias("english"), titles["Japanese"].alias("japanese"))


CHECK_VIEWS["x_credit_artists"] = """
select p_partkey as id, 0 as credit, a.pos, a.name, a.artist_id from part cross join lateral (values
  (0, concat('English=A', p_partkey, '|Japanese=名'), p_partkey), (1, 'English=Eight', 8), (2, concat('English=Plain ', p_partkey), null), (3, 'English=Studio , City', null)) a(pos, name, artist_id)
union all
select p_partkey, 1, a.pos, a.name, null from part cross join lateral (values
  (0, concat('English=', p_brand, ' and Co')), (1, 'English=Bold'), (2, 'English=Name'), (3, concat('Japanese=名 ', p_partkey))) a(pos, name) where p_partkey % 3 <> 0
"""


@query("p16_credit_rows", """
select p_partkey as id, cast(0 as bigint) as credit, 'Composer' as role_raw, 'composer' as role from part
union all select p_partkey, 1, case p_partkey % 3 when 1 then 'Recording Producer' else '1st VIOLIN' end, case p_partkey % 3 when 1 then 'producer' else 'performer' end from part where p_partkey % 3 <> 0
""")
def credit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = P.cleaned(pages.album_pages(spark, sf_dir)).select(F.col("page_id").alias("id"), F.posexplode(P.credit_rows(F.col("html"))).alias("credit", "c"))
    return rows.select("id", *_big("credit"), "c.role_raw", "c.role")


@query("p17_split_artists", "select id, cast(credit as bigint) as credit, cast(pos as bigint) as pos, name, cast(artist_id as bigint) as artist_id from x_credit_artists")
def split_artists(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = P.cleaned(pages.album_pages(spark, sf_dir)).select(F.col("page_id").alias("id"), F.posexplode(P.credit_rows(F.col("html"))).alias("credit", "c"))
    artists = rows.select("id", "credit", F.posexplode("c.artists").alias("pos", "a"))
    return artists.select("id", *_big("credit", "pos"), _text_of(F.col("a.names")).alias("name"), F.col("a.id").alias("artist_id"))


@query("p19_album_notes", """
select p_partkey as id, case when p_partkey % 4 in (0, 3) then concat('Tracks 1~2', chr(10), 'Composed by ', p_brand, ' & Co', chr(10), chr(10), 'Inner end') end as notes from part
""")
def album_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.cleaned(pages.album_pages(spark, sf_dir)).select(F.col("page_id").alias("id"), P.notes_text(F.col("html")).alias("notes"))


@query("p22_event_date", "select id, cast(year as bigint) as year, cast(month as bigint) as month, cast(day as bigint) as day from x_any_dates")
def event_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = P.cleaned(pages.event_pages(spark, sf_dir)).select(F.col("page_id").alias("id"), P.event_date(F.col("html")).alias("d"))
    return rows.select("id", *_parts("d"))


CHECK_VIEWS["x_hits"] = """
select c_custkey, t.t, row_number() over (partition by c_custkey order by t.t) as rank from customer cross join generate_series(1, 14) t(t)
where c_custkey % 10 <> 9 and t.t <= c_custkey % 14 and t.t % 5 <> 4
"""


@query("p20_search_rows", """
select c_custkey as page_id, rank, c_custkey * 100 + t as id, concat('https://example.org/album/', c_custkey * 100 + t) as link, concat('English=Hit ', t, '|Japanese=曲') as titles,
  case when t % 4 in (2, 3) then cast(2000 + t as varchar) end as catalog, cast(case when t % 3 = 2 then 1999 else 2005 end as bigint) as year,
  cast(case when t % 3 <> 2 then 11 end as bigint) as month, cast(case when t % 3 = 0 then 8 end as bigint) as day
from x_hits
""")
def search_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = P.search_rows(pages.search_pages(spark, sf_dir))
    return rows.select("page_id", *_big("rank"), "id", "link", _text_of(F.col("titles")).alias("titles"), "catalog", *_parts("release_date"))


@query("p21_search_query", "select c_custkey as page_id, case when c_custkey % 10 = 9 then '' else concat('say \"', c_custkey, '\"') end as query from customer")
def search_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.cleaned(pages.search_pages(spark, sf_dir)).select("page_id", P.search_query(F.col("html")).alias("query"))
