"""Catalogue pages composed from the sample tables, one page per row.

The parsed result can be compared with the table the page came from, without any engine having to
read HTML for the comparison. Pages deliberately hold what real ones do: missing links and names,
repeated labels, popup menus, related items ahead of the own picture, unclosed elements.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sleevework.plans.registry import by_key, table, view

SITE = "https://example.org"


def canonical(kind: str, key: str, missing: int = 17) -> str:
    return f"""case when {key} % {missing} = 0 then '' else concat('<link rel="canonical" href="{SITE}/{kind}/', {key}, '">') end"""


def language_spans(css: str, en: str, ja: str, romaji: str) -> str:
    return f"""concat('<span class="{css}" lang="en">', {en}, '</span><span class="{css}" lang="ja" style="display:none"><em> / </em>', {ja},
      '</span><span class="{css}" lang="ja-Latn" style="display:none"><em> / </em>', {romaji}, '</span>')"""


def _page(key: str, kind: str, head: str, body: str) -> list[str]:
    return [
        f"{key} as page_id", f"concat('{SITE}/{kind}/', {key}) as url",
        f"""concat('<html><head><title>x</title>', {head}, '<style>h1 {{}}</style></head><body><script>var x="<h1>no</h1>";</script><!-- <h1>no</h1> --><p>Open ', {body}, '</body></html>') as html""",
    ]


def org_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One per supplier: its name, its nation as type (labelled twice), a description."""
    nation = F.broadcast(table(spark, sf_dir, "nation"))  # 25 rows at every scale
    rows = table(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    body = """concat('<h1> </h1><h1> ', case when s_suppkey % 19 = 0 then '' else s_name end, ' </h1><dl><dt class="label">Type</dt><dd>', n_name, '</dd>',
      '<dt class="smallfont label">Description</dt>\n<dd>', case when s_suppkey % 3 = 0 then ' ' else concat('A &amp; B<br>', s_suppkey, '&nbsp;&#33;&eacute;') end, '</dd><dt class="label">Type</dt><dd>second</dd></dl>')"""
    return by_key(rows, "s_suppkey").selectExpr(*_page("s_suppkey", "org", canonical("org", "s_suppkey"), body))


def artist_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One per customer: name, birth date, aliases, members and units."""
    body = """concat('<div id="innermain"><span style="font-size: 1.5em">', case when c_custkey % 19 = 0 then '' when c_custkey % 4 = 0 then concat('悪魔 ', c_custkey) else c_name end, '</span>',
      '<div><b style="color: #788990">Birthdate</b><br />', case c_custkey % 3 when 0 then 'Mar 03, 1970' when 1 then '1971' else 'unknown' end, '</div>',
      '<div><b style="color: #788990">Aliases</b><div>', c_mktsegment, '</div><div> </div><div>A.&amp;', c_custkey, '</div></div>',
      '<div><b style="color: #788990">Members</b><a href="/artist/', c_custkey + 1, '"><span class="artistname" lang="en">M', c_custkey, '</span><span class="artistname" lang="ja"><em> / </em>M', c_custkey, '</span></a>, <a href="/artist/x">NoId</a><a href="/album/3">not</a></div>',
      case when c_custkey % 2 = 0 then concat('<div><b style="color: #788990">Units</b><a href="https://other.org/artist/', c_custkey + 2, '?x=1">U &lt;', c_custkey, '</a></div>') else '' end,
      '<div><b style="color: #788990">Birthdate</b>1999</div></div>')"""
    rows = table(spark, sf_dir, "customer")
    return by_key(rows, "c_custkey").selectExpr(*_page("c_custkey", "artist", canonical("artist", "c_custkey"), body))


def product_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One per part: names in the heading, franchises, developers and publishers."""
    spans = language_spans("albumtitle", "en", "ja", "romaji")
    names = language_spans("productname", "p_brand", "p_brand", "concat('R ', p_brand)")
    body = f"""concat('<h1>', case when id % 19 = 0 then '' else concat({spans}, '<span class="albumtitle" lang="en">again</span>') end, '</h1>',
      '<dl><dt class="label">Franchises</dt><dd><a href="/product/', id + 1, '?tab=x">', {names}, '<span class="productname" lang="en">later</span></a><a href="/product/5">Plain ', id, '</a></dd>',
      '<dt class="label">Developer</dt><dd><a href="/org/', p_size % 5, '?tab=p">Dev ', p_size % 5, '</a><a href="/org/none">NoId</a><a href="/org/none">NoId</a></dd>',
      '<dt class="label">Publisher</dt><dd><a href="/org/', p_size % 3, '">Pub ', p_size % 3, '</a><a href="/org/9">Pub 9</a></dd></dl>')"""
    rows = table(spark, sf_dir, "part").join(view(spark, sf_dir, "v_localized"), F.col("p_partkey") == F.col("id"))
    return by_key(rows, "id").selectExpr(*_page("id", "product", canonical("product", "id"), body))


def event_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One per order: the event's own name is the leading group of title spans; one date label."""
    body = """concat('<span class="albumtitle" lang="en">', case when id % 19 = 0 then '' else concat('Event ', id) end, '</span><span class="albumtitle">no language</span>',
      case when id % 3 = 0 then '<span class="albumtitle" lang="ja"><em> / </em>祭り</span>' else '' end,
      '<span class="albumtitle" lang="en">Other album</span><span class="albumtitle" lang="ja-Latn">late</span>',
      '<span class="smallfont label">', raw, '</span><span class="smallfont label">2030</span>')"""
    rows = view(spark, sf_dir, "v_dates")
    return by_key(rows, "id").selectExpr(*_page("id", "event", canonical("event", "id"), body))


# tracks of album p: discs 1 .. p % 3 (none: a bare list), disc d has (p + d) % 4 + 1 tracks
_TAB = """concat('<span class="tl" id="tl{n}">', case when p_partkey % 7 = 0 then '<table><tr class="rolebit"><td><span class="label">99</span></td><td width="100%">Stray</td></tr></table>' else '' end,
  array_join(transform(sequence(if(p_partkey % 3 = 0, 0, 1), p_partkey % 3), d -> concat(
    case when p_partkey % 3 = 0 then '' else concat('<span style="x"><b>Disc ', d + 1, '</b> [x]</span>') end, '<table>',
    array_join(transform(sequence(1, (p_partkey + d) % 4 + 1 + {extra}), t -> concat('<tr class="rolebit"><td><span class="label">', lpad(cast(t as string), 2, '0'), '</span></td><td width="100%">',
      {title}, '</td><td align="right">', case when t % 2 = 0 then concat('<span class="time">', t, ':0', d, '</span>') else '<span class="time"> </span>' end, '</td></tr>')), ''), '</table>')), ''), '</span>')"""


def album_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One per part: titles, info box, pictures, tracklist tabs, credits, notes, release event."""
    titles = language_spans("albumtitle", "en", "ja", "romaji")
    label = lambda name: f"""<tr><td><span class="label"><b>{name}</b></span></td><td>"""
    info = f"""concat('<table id="album_infobit_large">', case when id % 13 = 0 then '{label("Catalog Number")}OLD</td></tr>' else '' end,
      case when id % 11 = 0 then '' else concat('{label("Catalog Number")}CAT-', id, ' <script>pop()</script><div class="vbmenu_popup" id="m"><a href="/x">menu</a></div></td></tr>') end,
      '{label("Release Date")}', case id % 4 when 0 then concat('<a href="/db/calendar.php?year=', 1990 + p_size % 30, '&amp;month=1#', 1990 + p_size % 30, lpad(cast(1 + id % 13 as string), 2, '0'), '05">Jan 5</a>')
         when 1 then concat('Mar 0', 1 + id % 9, ', ', 1990 + p_size % 30) when 2 then concat('<b>', 1990 + p_size % 30, '</b>') else 'TBA' end, '</td></tr>',
      '{label("Classification")}', p_type, ',<b>Vocal</b></td></tr><tr><td>no label</td><td>x</td></tr></table>')"""
    pictures = """concat('<img src="https://thumb-media.example.org/albums/x/', id + 1, '/r.jpg"><div style="background: url(''https://medium-media.example.org/albums/9/', id, '/c.jpg'')"></div><a href="https://thumb-media.example.org/albums/9/', id, '/s.jpg">x</a>')"""
    tab = lambda n, title, extra: _TAB.format(n=n, title=title, extra=extra)
    tracklist = f"""concat('<ul class="tabnav"><li><a rel="tl1" href="#">', case when id % 2 = 0 then 'English (unofficial)' else 'English' end, '</a></li><li><a rel="tl2">Japanese</a></li>',
      case when id % 5 = 0 then '<li><a rel="tl3">English</a></li>' else '' end, '</ul><div id="tracklist"><div>',
      {tab(1, "concat('E', id, '-', d, '-', t)", "if(id % 6 = 2, 1, 0)")}, {tab(2, "case when t = 1 then concat('曲 ', id, '-', d) else concat('E', id, '-', d, '-', t) end", "0")},
      case when id % 5 = 0 then {tab(3, "concat('X', id, '-', d, '-', t)", "0")} else '' end, '</div></div>')"""
    credits = f"""concat('<div id="collapse_credits"><div><table id="album_infobit_large"><tr class="maincred"><td><span class="label"><b><span class="artistname" lang="en">Composer</span><span class="artistname" lang="ja">作曲</span></b></span></td><td>',
        '<a href="/artist/', id, '">', {language_spans("artistname", "concat('A', id)", "'名'", "concat('A', id)")}, '</a> (<a href="/artist/7">aka</a>), <a href="/artist/8">Eight</a>, Plain ', id, ', Studio , City (Label)</td></tr>',
        '<tr class="maincred"><td>', case id % 3 when 0 then ' ' when 1 then 'Recording Producer' else '1st VIOLIN' end, '</td><td>', p_brand, ' and Co, <b>Bold, Name</b>( <a href="/artist/x">NoId</a> ), 名 ', id, '</td></tr>',
        '<tr class="other"><td>Ignored</td><td>x</td></tr></table></div></div>')"""
    notes = """case when id % 4 = 1 then '' when id % 4 = 2 then '<div id="notes"> </div>' else concat('<div id="notes">Tracks 1~2<br>Composed by ', p_brand, ' &amp; Co<br />\n<div>Inner</div> end</div>') end"""
    event = """case when id % 4 = 0 then concat('<a class="thickbox link_event" href="/event/', id % 50, '" title="Released at Fest ', id % 50, ' (Dec 1, 2001)">x</a>')
       when id % 4 = 1 then '<a href="/event/3" class="link_event">Released at  祭り (2002) </a>' when id % 4 = 2 then '<a href="/event/3" class="link_event">(2002)</a>' else '' end"""
    body = f"""concat('<h1>', case when id % 19 = 0 then '' else {titles} end, '</h1>', {pictures}, {credits}, {info}, {event}, {tracklist}, {notes}, '<div>after</div>')"""
    rows = table(spark, sf_dir, "part").join(view(spark, sf_dir, "v_localized"), F.col("p_partkey") == F.col("id"))
    return by_key(rows, "id").selectExpr(*_page("id", "album", canonical("album", "id"), body))


def search_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One per customer, with c_custkey % 14 hits, some of them without an album link."""
    hit = """concat('<tr rel="rel_', t, '"><td><span class="catalog">', case t % 4 when 0 then 'N/A' when 1 then '' else cast(2000 + t as string) end, '</span></td><td>',
      case when t % 5 = 4 then 'no link' else concat('<a href="/album/', c_custkey * 100 + t, '?x"><span class="albumtitle" lang="en">Hit ', t, '</span><span class="albumtitle" lang="ja">曲</span></a>') end,
      '</td><td>media</td><td>', case t % 3 when 0 then 'Nov 08, 2005' when 1 then 'Nov 2005' else 'TBA' end, '</td><td>1999</td></tr>')"""
    body = f"""concat('<h3 class="label">x</h3>', case when c_custkey % 10 = 9 then '' else concat('<div id="albumresults"><h3 class="label">', c_custkey % 14, ' album results for "say "', c_custkey, '""</h3><table class="results"><thead><tr><th>head</th></tr></thead>',
      array_join(transform(slice(sequence(1, 14), 1, cast(c_custkey % 14 as int)), t -> {hit}), ''), '</table></div>') end, '<div id="artistresults"><h3 class="label">0 artist results for "q"</h3></div>')"""
    rows = table(spark, sf_dir, "customer")
    return by_key(rows, "c_custkey").selectExpr(*_page("c_custkey", "search", "''", body))
