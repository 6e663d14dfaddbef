"""What a page costs: results as before, with fewer exceptions, searches and texts read."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from sleevework.functions import html as H
from sleevework.functions.dates import partial_date
from sleevework.operators import pages as P


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def page(spark, column):
    return plan(spark.createDataFrame([("x",)], "html string").select(column.alias("out")))


def test_no_empty_group_is_cast(spark):
    """An empty text makes ``try_cast`` throw and catch an exception."""
    event, link = page(spark, P.event_date(F.col("html"))), page(spark, P.reference(F.col("html"), "artist", P.ARTIST_CLASS, P.DEFAULT_SITE))
    for text in (event, link, page(spark, P.raw_track(F.col("html"))), page(spark, H.clean(F.col("html")))):
        assert "try_cast(regexp_extract(" not in text and "try_cast(" in text
    rows = spark.createDataFrame([*enumerate(["2001", "2001-02", "2001-02-03", "Mar 2001", "TBA", "", None, "#20010203", "year=2001&month=2", "#2001", "0000", "2001-13"])], "n int, t string")
    found = rows.select("n", partial_date(F.col("t")).alias("d")).orderBy("n").collect()
    none = (None, None, None)
    assert [tuple(r["d"] or none) for r in found] == [
        (2001, None, None), (2001, 2, None), (2001, 2, 3), (2001, 3, None), none, none, none, (2001, 2, 3), (2001, 2, None), (2001, None, None), (0, None, None), none,
    ]


def test_elements_are_cut_without_a_copy_of_them(spark):
    """A found element is not put into a row of its own before it is cut."""
    assert page(spark, H.containers(F.col("html"), "b", 'class="x"')).count("struct(all,") == 0
    rows = spark.createDataFrame([('<b class="x" title="悪>">1 > 2<b>3</b></b><b class=x></b>',), (None,), ("",)], "html string")
    found = [r["c"] for r in rows.select(H.containers(F.col("html"), "b", 'class="x"').alias("c")).collect()]
    assert [(c["open"], c["inner"]) for c in found[0]] == [('<b class="x" title="悪>', '">1 > 2<b>3</b>'), ("<b class=x>", "")]
    assert found[1:] == [None, []]


def test_names_in_spans(spark):
    html = "".join(f'<span class="n" lang="en">{t}</span>' for t in ("Plain", "/ lead", "/lead", " a  b ", "<em> / </em>祭り", "", "&amp; b", "\u3000x\u3000", "a/b", "/"))
    got = spark.createDataFrame([(html,), (None,)], "html string").select(H.language_spans(F.col("html"), "n").alias("s")).collect()
    assert [s["text"] for s in got[0]["s"]] == ["Plain", "lead", "lead", "a b", "祭り", "", "& b", "x", "a/b", ""]
    assert got[1]["s"] is None


def test_a_page_is_decoded_for_fewer_patterns(spark):
    """A page is passed over for scripts and for open values; only pages with an entity are split at it."""
    assert len(re.findall("RLIKE", page(spark, H.clean(F.col("html"))))) <= 3
    rows = {
        "a &amp; b &lt; &gt; &quot;": "a &amp; b &lt; &gt; &quot;", "a & b &; &1 &": "a & b &; &1 &", "&eacute;&eacute &#33;&#x21; &middot;x": "éé !! ·x",
        "&lt x &amp x &quot=": "&lt; x &amp; x &quot=", "&" + "a" * 60 + ";x": "&" + "a" * 60 + ";x", "&thetasym;1&#9999999;": "\u03d11\ufffd",
        '<a t="x > y" u=\'<i>\'>&eacute;</a>': '<a t="x &gt; y" u=\'&lt;i&gt;\'>é</a>', '= "<" &amp;': '= "<" &amp;', "": "",
    }
    df = spark.createDataFrame([*enumerate([*rows, None])], "n int, html string")
    assert [r["h"] for r in df.select("n", H.clean(F.col("html")).alias("h")).orderBy("n").collect()] == [*rows.values(), None]


def test_texts_outside_the_leading_group_are_not_read(spark):
    """Spans are grouped by their languages first; the texts of the others are never looked at."""
    html = "".join(f'<span class="albumtitle"{lang}>{t}</span>' for lang, t in ((' lang="en"', "Own"), ("", "none"), (' lang="ja"', "祭り"), (' lang="en"', "Other"), (' lang="ja-Latn"', "late")))
    df = spark.createDataFrame([(html,), ("",), (None,)], "html string")
    spans = H.language_spans(F.col("html"), "albumtitle", H.leading_group)
    got = [r["s"] for r in df.select(spans.alias("s")).collect()]
    assert [(s["lang"], s["text"]) for s in got[0]] == [("en", "Own"), (None, "none"), ("ja", "祭り")] and got[1:] == [[], None]
    late = H.leading_group(H.language_spans(F.col("html"), "albumtitle"))
    assert got == [r["s"] for r in df.select(late.alias("s")).collect()]
    for kind in ("event", "product"):
        text = page(spark, P.names_of_kind(F.col("html"), kind))
        assert text.index("array_min(") > 0 and "inner" in text[: text.index("array_min(")]
