"""Page readers on small hand-made pages, and the stream."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from sleevework.functions import html as H
from sleevework.operators import pages as P
from sleevework.streaming import pages as S

BASE = '<html><head><link href="https://example.org/album/271" rel="canonical"></head><body>{}</body></html>'


def on_page(spark, html, column):
    df = P.cleaned(spark.createDataFrame([(1, "u", html)], "page_id bigint, url string, html string"))
    return df.select(column.alias("out")).collect()[0]["out"]



def test_entities_and_noise(spark):
    html = "<script>var a='<h1>x</h1>'</script><!-- <h1>y</h1> --><h1> A &amp;lt; B&nbsp;&#33;&#x43;&eacute; &bogus; &amp; </h1>"
    assert on_page(spark, html, H.text(H.inner(F.get(H.elements(F.col("html"), "h1"), F.lit(0))))) == "A &lt; B !Cé &bogus; &"
    assert on_page(spark, "<p>a&#60;b&#62;c</p>", H.text(F.col("html"))) == "a<b>c"


def test_nested_containers(spark):
    html = '<div id="a"><div>1</div><p>open<div><div>2</div></div></div><div>3</div>'
    assert on_page(spark, html, H.container(F.col("html"), "div", 'id="a"')) == '<div>1</div><p>open<div><div>2</div></div>'
    assert on_page(spark, html, H.container(F.col("html"), "div", 'id="b"')) is None


def test_markup_inside_quoted_values(spark):
    body = """<h1><span class="albumtitle" lang="en" title="x > y">Name</span><span class='albumtitle' lang='ja' title='a "<b>" c'> / 名</span></h1>
      <a data-x='1 > 0' href="/artist/5?q=a>b" title="<i>">A &lt; B</a> 1 < 2"""
    page = BASE.format(body)
    title = H.localized(H.language_spans(F.col("html"), "albumtitle"))
    assert on_page(spark, page, title) == {"English": "Name", "Japanese": "名"}
    link = F.get(H.elements(F.col("html"), "a", 'href="[^"]*/artist/'), F.lit(0))
    assert on_page(spark, page, F.array(H.attribute(link, "href"), H.attribute(link, "title"), H.attribute(link, "data-x"), H.text(H.inner(link)))) == ["/artist/5?q=a>b", "<i>", "1 > 0", "A < B"]
    rows = P.tokenise(spark.createDataFrame([(1, "u", '<a title="x > y">t</a><br/><b c=\'>\'>&gt;')], "page_id bigint, url string, html string")).orderBy("pos").collect()
    assert [(r["tok"], r["tag"]) for r in rows] == [('<a title="x &gt; y">', "a"), ("t", None), ("</a>", "a"), ("<br/>", "br"), ("<b c='&gt;'>", "b"), (">", None)]
    long = '<p title="' + "> <" * 20000 + '">end</p>'
    assert on_page(spark, long, H.text(F.col("html"))) == "end"
    plain = "<p a=b c>1 = 2 > 1</p>" + "<i>x</i>" * 5000
    assert on_page(spark, plain, F.col("html")) == plain


def test_attributes(spark):
    tag = F.col("html")
    assert on_page(spark, """<a title='it "is"' href="/x?a=1&amp;b=2" rel=tl1>""", F.array(H.attribute(tag, "title"), H.attribute(tag, "href"), H.attribute(tag, "rel"), H.attribute(tag, "id"))) == [
        'it "is"', "/x?a=1&b=2", "tl1", None,
    ]


def artists(spark, cell):
    out = on_page(spark, cell, P.split_artists(F.col("html")))
    return [(next(iter(a["names"].items())) if a["names"] else None, a["id"]) for a in out]


@pytest.mark.parametrize(
    ("cell", "expected"),
    [
        ("A, B and C", [(("English", "A"), None), (("English", "B and C"), None)]),
        ("Studio , City", [(("English", "Studio , City"), None)]),
        ("X (Label), 名", [(("English", "X"), None), (("Japanese", "名"), None)]),
        ('<a href="/artist/1">One</a> (<a href="/artist/2">alias</a>)', [(("English", "One"), 1)]),
        ('(<a href="/artist/2">first</a>)', [(("English", "first"), 2)]),
        ('<a href="/artist/1">One</a>, <a href="/artist/2">Two</a> / text', [(("English", "One"), 1), (("English", "Two"), 2), (("English", "/ text"), None)]),
        ('<a href="/org/1">Org</a>', [(("English", "Org"), None)]),
        (" , ", []),
    ],
)
def test_artists_of_a_cell(spark, cell, expected):
    assert artists(spark, cell) == expected


def test_disc_groups(spark):
    row = lambda n: f'<tr class="rolebit"><td><span class="label">{n}</span></td><td width="100%">T{n}</td></tr>'
    headed = f"<table>{row(9)}</table><b>Disc 1</b> x<table>{row(1)}{row(2)}</table><b>note</b><b> disc two</b><table></table><b>DISC 3 (Bonus)</b><table>{row(3)}</table>"
    out = on_page(spark, headed, P.disc_groups(F.col("html")))
    assert [(d["number"], d["name"], [t["title"] for t in d["tracks"]]) for d in out] == [(1, "Disc 1", ["T1", "T2"]), (None, "disc two", []), (3, "DISC 3 (Bonus)", ["T3"])]
    bare = on_page(spark, f"<table>{row(1)}</table>", P.disc_groups(F.col("html")))
    assert [(d["number"], d["name"], len(d["tracks"])) for d in bare] == [(1, None, 1)]
    assert on_page(spark, "<p>none</p>", P.disc_groups(F.col("html"))) == []


def test_album_without_optional_parts(spark):
    html = BASE.format('<h1><span class="albumtitle" lang="en">Only</span></h1>')
    row = P.album_records(spark.createDataFrame([(1, "u", html)], "page_id bigint, url string, html string")).collect()[0]
    assert (row["id"], row["titles"], row["catalog"], row["release_date"], row["discs"], row["credits"], row["notes"], row["release_event"]) == (
        271, {"English": "Only"}, None, None, [], [], None, None,
    )


def test_empty_search_page(spark):
    html = '<div id="albumresults" style="x"><h3 class="label">0 album results for "zzq"</h3></div>'
    df = spark.createDataFrame([(1, "u", html)], "page_id bigint, url string, html string")
    assert P.search_rows(df).count() == 0
    assert on_page(spark, html, P.search_query(F.col("html"))) == "zzq"
    assert P.route_pages(df).collect()[0]["reason"] is None


def test_stream_equals_batch(spark, sf_dir, tmp_path):
    source = tmp_path / "in"
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    named = pages.withColumn("html", F.when(F.col("page_id") % 2 == 0, F.concat(F.lit('<link rel="canonical" href="/org/'), "page_id", F.lit('">'), "html")).otherwise(F.col("html")))
    named.repartition(3).write.parquet(str(source))
    rows = S.routed_stream(S.page_stream(spark, str(source), max_files=1))
    S.write_available(rows, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    streamed = spark.read.parquet(str(tmp_path / "out"))
    batch = S.routed_stream(spark.read.parquet(str(source)))
    assert streamed.count() == pages.count() and streamed.exceptAll(batch).count() == 0
    assert streamed.where("reason is null").count() > 0
    S.write_available(rows, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == pages.count(), "a restart reads nothing twice"


def test_entry_points(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["album_id", "track", "role", "role_raw", "artist"] and df.count() > 0
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
    assert os.path.exists(os.path.join(os.path.dirname(entry_points.__file__), "bench.py"))


def _album(spark, html):
    page = spark.createDataFrame([(1, "u", html)], "page_id bigint, url string, html string")
    return P.route_pages(page).collect()[0]


@pytest.mark.parametrize("rel", ["rel='canonical'", "rel=canonical", 'rel = "canonical"'])
def test_canonical_link_in_any_quoting(spark, rel):
    row = _album(spark, f"<html><head><link {rel} href=/album/7></head><h1>Site</h1><h1><span class='albumtitle' lang=en>A <span>B</span> C</span></h1></html>")
    assert (row["entity_id"], row["reason"], row["names"]) == (7, None, {"English": "A B C"})


def test_attribute_names_are_whole(spark):
    html = '<div data-id="notes">no</div><section id=notes>a<br>b<section>c</section></section><p>d</p>'
    assert on_page(spark, html, P.notes_text(F.col("html"))) == "a\nbc"


def test_more_entities(spark):
    html = "<p>it&apos;s &copy 2024 &#39 &#146; &hellip; &amp &notaname; a&copyb &lt;b&gt;</p>"
    assert on_page(spark, html, H.text(F.col("html"))) == "it's © 2024 ' ’ … & &notaname; a&copyb <b>"


def test_blank_credits_box_keeps_the_info_box(spark):
    info = '<table id="album_infobit_large"><tr><td><span class="label">Catalog Number</span></td><td>AB 12</td></tr></table>'
    html = f'<div id="collapse_credits"> </div>{info}'
    assert on_page(spark, html, P.info_value(P.info_fields(F.col("html")), "Catalog Number")) == "AB 12"
    inside = f'<div id="collapse_credits"><div>{info}</div></div><p>x</p>'
    assert on_page(spark, inside, P.info_value(P.info_fields(F.col("html")), "Catalog Number")) is None


def test_definition_lists_without_end_tags(spark):
    def pairs(html):
        return [(p["label"], p["body"]) for p in on_page(spark, html, P.label_pairs(F.col("html")))]

    assert pairs('<dl><dt class="label">Type</dt><dt class="label">Developer</dt><dd>X</dd></dl>') == [("Type", "X"), ("Developer", "X")]
    assert pairs("<dl><dt class=label>Type<dd>Game<dt class='a label'>Maker<dd><b>Y</b></dl>") == [("Type", "Game"), ("Maker", "<b>Y</b>")]
    assert pairs('<dl><dt class="label">Type</dt></dl><dl><dt>No</dt><dd>Z</dd></dl>') == [("Type", None)]
    assert pairs("<p>no list</p>") == []


def test_profile_labels_in_any_element(spark):
    html = '<p><b style="color:#788990">Birthdate</b> 1970</p><div>x <b style="color: #788990">Type</b> Unit</div>'
    assert [(f["label"], f["body"].strip()) for f in on_page(spark, html, P.artist_fields(F.col("html")))] == [("Birthdate", "1970"), ("Type", "Unit")]


def test_cover_of_any_quoting(spark):
    html = "<img src='https://thumb.media.example/albums/7/a&amp;b.jpg'><img src=https://thumbXmedia.example/albums/7/c.jpg>"
    assert on_page(spark, html, P.cover_url(F.col("html"), "thumb.media.example", F.lit(7))) == "https://thumb.media.example/albums/7/a&b.jpg"


def test_elements_with_and_without_their_own_tag(spark):
    cases = ["<p>z</p><b class=x>a</b>t</b>", "<b class=x>a<b>b</b>c</b>d", "<B class='x'>a</b >", '<b class="x">open', '<b class="x">x</b><b class="x">y<b>z</b></b>t', "none"]
    df = spark.createDataFrame([(c,) for c in cases], "html string")
    found = [H.containers(F.col("html"), "b", 'class="x"', flat=flat)["inner"].alias(f"flat_{flat}") for flat in (True, False)]
    rows = df.select(*found).collect()
    assert [r["flat_True"] for r in rows] == [r["flat_False"] for r in rows] == [["a"], ["a<b>b</b>c"], ["a"], ["open"], ["x", "y<b>z</b>"], []]
    first = df.select(H.element(F.col("html"), "b").alias("e"), H.opening_tag(F.col("html"), "b", 'class="x"').alias("o")).collect()
    assert [tuple(r) for r in first[1::2]] == [("<b class=x>a<b>b</b>", "<b class=x>"), (None, '<b class="x">'), (None, None)]
