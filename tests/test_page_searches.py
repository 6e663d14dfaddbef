"""How often a page is searched, and elements found by pattern against a plain count of their tags."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from sleevework.functions import html as H
from sleevework.operators import pages as P


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def searches(spark, column):
    text = plan(spark.createDataFrame([("x",)], "html string").select(column.alias("out")))
    return len(re.findall(r"regexp_\w+\(|split\(", text)) + text.count(" RLIKE ")


def test_searches_of_a_track_and_an_event(spark):
    assert searches(spark, F.transform(F.array("html"), P.raw_track)) <= 25
    assert searches(spark, P.release_event(F.col("html"))) <= 40


def counted(html, tag, having, first=False):
    """(opening, inside) of each element: from its opening up to the next such opening, cut where its own tags are even."""
    opens = [*re.finditer(rf"(?is)<({tag})\b(?=[^>]*\s{having})[^>]*>", html)]
    out = []
    for i, o in enumerate(opens):
        tail = html[o.end():] if first or i + 1 == len(opens) else html[o.end():opens[i + 1].start()]
        own, depth, taken = o[1], 1, 0
        pieces = re.split(rf"(?is)</{own}\s*>", tail)
        while depth > 0 and taken < len(pieces):
            depth += len(re.findall(rf"(?is)<{own}\b", pieces[taken])) - 1
            taken += 1
        close = tag if tag.isalnum() else own
        out.append((o[0], f"</{close}>".join(pieces[:taken])))
    return out


DEEP = '<b class="x">' + "<b>1" * 6 + "</b>" * 6 + "2</b>3</b>"
PAGES = [
    'a<b class="x">1</b>2<b class="x"></b>', '<b class="x">1<b>2</b>3</b>4</b>', '<b class="x">1<b class="x">2</b>3</b>4', '<b class="x">1<b>2</b>3',
    '<b class="x">1<i>2</i', '<b class="x">1</B >2<b class="x">3<B>4</B>5</b>', '<b class="x">1<b>2<b class="x">3</b></b></b>', "<b class='x'>1</b x>2</b><b class=x>3", DEEP,
    DEEP + '<b class="x">7</b>', '<B CLASS="x">1<b>2</b></B>3', '<b class="x"', "<b>1</b>", "", '<b class="x">悪<b>魔</b>𝄞</b>城', '<b <b class="x">1</b>2</b>',
    '<b class="x">' + "<b>1</b>" * 3000 + "</b>2",
]


@pytest.mark.parametrize("flat", [True, False])
def test_containers_by_pattern_and_by_counting(spark, flat):
    rows = spark.createDataFrame([*enumerate(PAGES)], "n int, html string")
    found = rows.select("n", H.containers(F.col("html"), "b", 'class="x"', flat=flat).alias("c")).collect()
    having = r"""class=(?:"x"|'x'|x(?=[\s/>]))"""
    assert {r["n"]: [(c["open"], c["inner"]) for c in r["c"]] for r in found} == {n: counted(p, "b", having) for n, p in enumerate(PAGES)}


def test_first_container_of_one_tag_and_of_any(spark):
    rows = spark.createDataFrame([*enumerate([*PAGES, None])], "n int, html string")
    having = r"""class=(?:"x"|'x'|x(?=[\s/>]))"""
    for tag in ("b", H.ANY_TAG):
        found = rows.select("n", H.container(F.col("html"), tag, 'class="x"').alias("c"), H.without_container(F.col("html"), tag, 'class="x"').alias("w")).collect()
        for n, inside, rest in found:
            page = [*PAGES, None][n]
            first = counted(page, tag, having, first=True) if page is not None else []
            assert inside == (first[0][1] if first else None), (tag, n)
            if not first:
                assert rest == page
            else:
                at = page.index(first[0][0])
                assert rest.startswith(page[:at] + " ") and len(rest) <= len(page) - len(first[0][0]) + 1


def test_text_of_an_element(spark):
    rows = ["<td width=100%>a  b</td>", "<td width=100%></td>x", "<td>a</td>", "<td width=100%>x</b y</td>", "<td width=100%>1 < 2 &amp; <b>3</b></td>", "<td width='100%'>曲 &lt;1&gt;</td>", None]
    wide = r"""(?:width\s*=\s*["']?100%|colspan\s*=)"""
    df = spark.createDataFrame([*enumerate(rows)], "n int, html string")
    both = df.select(H.element_text(F.col("html"), "td", wide).alias("a"), H.text(H.inner(H.element(F.col("html"), "td", wide))).alias("b")).collect()
    assert [r["a"] for r in both] == [r["b"] for r in both] == ["a b", "", "", "x", "1 3", "曲 <1>", ""]


def test_names_in_a_credit(spark):
    cell = " , Plain One , Studio , City (Label), A (B), 名 1 ,, x)y, (z), - , "
    got = spark.createDataFrame([(cell,)], "html string").select(P.split_artists(F.col("html")).alias("a")).collect()[0]["a"]
    assert [next(iter(a["names"].values())) for a in got] == ["Plain One , Studio , City", "A", "名 1", "x)y"]
