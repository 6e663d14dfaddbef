"""From pages(page_id, url, html) to typed entities, references and rejects.

Every reader is a column expression over one clean page. ``cleaned`` is applied once, then any number
of readers share its column.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sleevework.functions import html as H
from sleevework.functions.core import blank_to_null, computed, deduplicate, digits, first, let, positions, sections
from sleevework.functions.dates import partial_date, release_date
from sleevework.functions.roles import normalize_role_once
from sleevework.functions.text import name_key, strip
from sleevework.functions.localized import placeholder_rule
from sleevework.functions.web import absolute_url, ref_link

DEFAULT_SITE = "https://example.org"
KINDS = ("album", "artist", "product", "org", "event")

# Page anchors.
TITLE_CLASS = "albumtitle"
ARTIST_CLASS = "artistname"
PRODUCT_CLASS = "productname"
FIELD_COLOR = "788990"
ORG_FIELDS = ("Developer", "Publisher")
LIST_COMMA = r"(?<=\S),\s*"
TRAILING_PAREN = r"\s*\([^)]*\)$"
PLAIN_NAME = r"\A[!-')-+\--~]++(?:[ ,]++[!-')-+\--~]++)*+\z"  # nothing to strip at its ends and no parenthesis


def cleaned(pages: DataFrame) -> DataFrame:
    return computed(pages, "html", H.clean(F.col("html")))


def tokenise(pages: DataFrame) -> DataFrame:
    """(page_id, pos, tok, tag, is_close): tags and texts in document order, texts decoded."""
    tokens = F.posexplode(F.regexp_extract_all("html", F.lit(H.TOKEN), 0)).alias("pos", "tok")
    rows = cleaned(pages).select("page_id", tokens)
    is_tag = F.col("tok").startswith("<")
    return rows.select(
        "page_id",
        "pos",
        F.when(is_tag, F.col("tok")).otherwise(H.unescape(F.col("tok"))).alias("tok"),
        F.when(is_tag, H.tag_name(F.col("tok"))).alias("tag"),
        F.col("tok").startswith("</").alias("is_close"),
    )


# -- names and routing -----------------------------------------------------------------------------


def single_name(name: Column) -> Column:
    """A name on its own as a language map keyed by its script; empty for no name."""
    return F.map_filter(F.create_map(name_key(name), name), lambda _k, v: v != "")


def heading_name(html: Column) -> Column:
    """First non-empty first-level heading."""
    headings = F.transform(H.elements(html, "h1"), lambda h: H.text(H.inner(h)))
    return single_name(F.coalesce(first(headings, lambda t: t != ""), F.lit("")))


def names_of_kind(html: Column, kind: str) -> Column:
    """Names of an entity page of a known kind."""
    if kind in ("album", "product"):
        headings = F.array_join(F.transform(H.containers(html, "h1", ""), lambda h: h["inner"]), " ")
        return H.localized(H.language_spans(headings, TITLE_CLASS, None if kind == "album" else H.leading_group))
    if kind == "event":
        return H.localized(H.language_spans(html, TITLE_CLASS, H.leading_group))
    if kind == "org":
        return heading_name(html)
    artist = first(H.elements(F.coalesce(H.container(html, "div", 'id="innermain"'), F.lit("")), "span", 'style="[^"]*1\\.5em'))
    return single_name(H.text(H.inner(artist)))


def entity_names(html: Column, kind: Column) -> Column:
    return F.coalesce(*[F.when(kind == k, names_of_kind(html, k)) for k in KINDS])


def route_pages(pages: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """(page_id, kind, entity_id, link, names, reason): reason is NULL for pages worth extracting.

    The canonical link decides kind and id; without it, or without a name, the page is a reject.
    Search pages have no id and are known by their results box.
    """
    link = H.canonical_link(F.col("html"))
    pattern = f"/({'|'.join(KINDS)})/(\\d+)"
    rows = computed(cleaned(pages), "link", link).withColumns(
        {
            "_kind": blank_to_null(F.regexp_extract("link", pattern, 1)),
            "entity_id": digits(F.regexp_extract("link", pattern, 2), "bigint"),
            "_search": H.has(F.col("html"), H.ANY_TAG, 'id="albumresults"'),
        }
    )
    rows = rows.withColumn("kind", F.coalesce("_kind", F.when(F.col("_search"), F.lit("search"))))
    rows = computed(rows, "names", entity_names(F.col("html"), F.col("kind")))
    reason = (
        F.when(F.col("kind") == "search", F.lit(None))
        .when(F.col("link").isNull(), "no canonical link")
        .when(F.col("entity_id").isNull(), "no entity id")
        .when(F.size("names") == 0, "no name")
    )
    return rows.select("page_id", *keep, "kind", "entity_id", "link", "names", reason.alias("reason"))


# -- references ------------------------------------------------------------------------------------


def reference(anchor: Column, kind: str, span_class: str, site: str, *, keep_query: bool = True) -> Column:
    """``struct<names, id, link>`` of a link to an entity."""
    grouped = H.language_spans(anchor, span_class, H.leading_group if span_class == PRODUCT_CLASS else None)
    plain = F.map_filter(F.create_map(F.lit("English"), H.text(H.inner(anchor))), lambda _k, v: v.isNotNull())
    names = F.when(H.has(anchor, "span", f'class="{span_class}"'), H.localized(grouped)).otherwise(plain)

    def read(href: Column) -> Column:
        link = absolute_url(href, site) if keep_query else ref_link(href, site)
        return F.struct(names.alias("names"), digits(F.regexp_extract(href, f"/{kind}/(\\d+)", 1), "bigint").alias("id"), link.alias("link"))

    return let(H.attribute(anchor, "href"), read)


def anchors(html: Column, kind: str) -> Column:
    return H.elements(html, "a", f'href="[^"]*/{kind}/')


def references(html: Column, kind: str, span_class: str, site: str, *, keep_query: bool = True) -> Column:
    refs = F.transform(anchors(html, kind), lambda a: reference(a, kind, span_class, site, keep_query=keep_query))
    return F.filter(refs, lambda r: F.size(r["names"]) > 0)


def page_links(pages: DataFrame, site: str = DEFAULT_SITE) -> DataFrame:
    """(page_id, pos, href, text, link, ref): every link of a page in document order."""
    rows = cleaned(pages).select("page_id", F.posexplode(H.elements(F.col("html"), "a", "href\\s*=")).alias("pos", "a"))
    href = H.attribute(F.col("a"), "href")
    return rows.select(
        "page_id", "pos", href.alias("href"), H.text(H.inner(F.col("a"))).alias("text"),
        absolute_url(href, site).alias("link"), ref_link(href, site).alias("ref"),
    )


# -- label/value fields ----------------------------------------------------------------------------


def label_pairs(html: Column) -> Column:
    """``array<struct<label, body>>`` of the ``dt`` labels of a page, each with the next ``dd`` of its list.

    End tags may be missing, and labels that follow one another share a ``dd``; without one the body is NULL.
    """
    events = F.regexp_extract_all(html, F.lit(r"(?is)<d[td]\b[^>]*>.*?(?=<d[td]\b|</d[tdl]\b|\z)|</dl\b"), 0)

    def read(part: Column) -> Column:
        end = F.try_element_at(part, F.lit(-1))
        body = F.when(end.rlike("(?i)^<dd"), F.regexp_replace(end, r"(?s)^<[^>]*>", ""))
        labels = F.filter(part, lambda e: H.has(F.regexp_extract(e, "^<[^>]*>", 0), "dt", 'class="[^"]*label'))
        return F.transform(labels, lambda e: F.struct(H.text(e).alias("label"), body.alias("body")))

    def pairs(items: Column) -> Column:
        after_end = lambda i: (i == 0) | ~F.get(items, i - 1).rlike("(?i)^<dt")
        starts = F.filter(F.transform(items, lambda _e, i: F.when(after_end(i), i + 1)), lambda p: p.isNotNull())
        return F.flatten(F.transform(sections(items, starts), read))

    return let(events, pairs)


def definition(pairs: Column, label: str) -> Column:
    """Body of the first pair with a label."""
    return first(pairs, lambda p: p["label"] == label)["body"]


def artist_fields(html: Column) -> Column:
    """``array<struct<label, body>>`` of an artist's profile blocks, whatever their tag; the first of a label counts."""
    mark = rf"<b\b(?=[^>]*{FIELD_COLOR})[^>]*>.*?</b\s*>"
    blocks = H.containers(html, "(?:div|p|td|li|dd|span|section)", "", rf"[^<]*{mark}")
    fields = F.transform(blocks, lambda b: F.struct(H.text(F.regexp_extract(b["open"], rf"(?is){mark}", 0)).alias("label"), b["inner"].alias("body")))
    return deduplicate(F.filter(fields, lambda f: f["label"] != ""), lambda f, _i: f["label"])


def aliases(body: Column) -> Column:
    names = F.transform(H.elements(F.coalesce(body, F.lit("")), "div"), lambda d: H.text(H.inner(d)))
    return F.filter(names, lambda n: n != "")


def info_fields(html: Column) -> Column:
    """``array<struct<label, value, href>>`` of an album's info box; the last of a label counts."""
    def field(cells: Column) -> Column:
        label = first(H.containers(F.get(cells, F.lit(0)), "span", 'class="label"'))["inner"]
        body = F.regexp_replace(F.get(cells, F.lit(1)), r"(?is)<(?:/td\s*>).*\z", "")
        return let(F.struct(label.alias("label"), body.alias("body")), read)

    def read(cell: Column) -> Column:
        body, marked = cell["body"], cell["body"].contains("<")
        shown = F.when(marked, F.regexp_replace(body, r'(?is)<div\b(?=[^>]*class="[^"]*vbmenu_popup)[^>]*>.*?</div\s*>', " ")).otherwise(body)
        href = F.when(marked, H.attribute(H.opening_tag(body, "a", "href\\s*="), "href"))
        row = F.struct(H.text(cell["label"]).alias("label"), H.spaced_text(shown).alias("value"), href.alias("href"))
        return F.when(cell["label"].isNotNull() & cell["body"].isNotNull(), row)

    tables = H.containers(H.without_container(html, "div", 'id="collapse_credits"'), "table", 'id="album_infobit_large"')
    rows = F.flatten(F.transform(tables, lambda t: H.pieces(t["inner"], r"(?is)<tr\b[^>]*>")))
    fields = F.transform(rows, lambda row: let(H.pieces(row, r"(?is)<(?:td)\b[^>]*>"), field))
    return deduplicate(F.filter(fields, lambda f: f.isNotNull()), lambda f, _i: f["label"], keep="last")


def info_value(fields: Column, label: str, part: str = "value") -> Column:
    return first(fields, lambda f: f["label"] == label)[part]


# -- album parts -----------------------------------------------------------------------------------


def cover_url(html: Column, host: str, album_id: Column) -> Column:
    """First address on a media host whose path names this album, so not a related album's picture."""
    site = re.escape(host)
    quoted = rf"""(?is)\s(?:src|href|style)\s*=\s*(?:"[^"]*{site}[^"]*"|'[^']*{site}[^']*'|[^\s"'>]*{site}[^\s"'>]*)"""
    values = F.regexp_extract_all(html, F.lit(quoted), 0)
    needle = F.concat(F.lit("/"), album_id.cast("string"), F.lit("/"))
    found = F.transform(values, lambda v: F.regexp_extract(H.unescape(v), rf"https?://{re.escape(host)}[^\"' )]+", 0))
    return first(found, lambda u: u.contains(needle))


def release_event(html: Column, site: str = DEFAULT_SITE) -> Column:
    """The event an album was released at, without the lead-in and the date in its link text."""
    anchor = first(H.elements(html, "a", 'class="[^"]*link_event'), lambda a: H.has(a, "a", 'href="[^"]*/event/'))

    def read(a: Column) -> Column:
        title = F.coalesce(blank_to_null(H.attribute(a, "title")), H.text(H.inner(a)))
        name = strip(F.regexp_replace(F.regexp_replace(title, r"(?iU)^\s*Released at\s+", ""), r"(?U)\s*\([^)]*\)\s*$", ""))
        return let(F.struct(name.alias("name"), H.attribute(a, "href").alias("href")), refer)

    def refer(x: Column) -> Column:
        ref = F.struct(
            F.create_map(name_key(x["name"]), x["name"]).alias("names"),
            digits(F.regexp_extract(x["href"], r"/event/(\d+)", 1), "bigint").alias("id"),
            absolute_url(x["href"], site).alias("link"),
        )
        return F.when(x["name"] != "", ref)

    return let(anchor, lambda found: F.when(found.isNotNull(), read(found)))


def raw_track(row: Column) -> Column:
    """``struct<number, length, title>`` of a tracklist row."""
    return _track(row, F.lit(True))


def _track(row: Column, numbered: Column) -> Column:
    """``raw_track``; ``numbered`` tells whether number and length are wanted."""
    number = digits(F.regexp_extract(H.element_text(row, "span", 'class="label"'), r"\d+", 0), "int")
    title = H.element_text(row, "td", r"""(?:width\s*=\s*["']?100%|colspan\s*=)""")
    length = blank_to_null(H.element_text(row, "span", 'class="time"'))  # the text of a missing element is empty
    return F.struct(F.when(numbered, number).alias("number"), F.when(numbered, length).alias("length"), title.alias("title"))


def disc_groups(tab: Column) -> Column:
    """``array<struct<number, name, tracks>>`` of one language's tracklist.

    A "Disc N" heading opens a group; rows before the first heading belong to none. Without any
    heading all rows form disc 1.
    """
    return _groups(tab, F.lit(True))


def _groups(tab: Column, numbered: Column) -> Column:
    row = r'tr\b(?=[^>]*class="[^"]*rolebit)[^>]*>(?:[^<]+|<(?!tr\b|/table|b\b[^>]*>\s*disc))*+'
    events = F.regexp_extract_all(tab, F.lit(rf"(?is)<(?:b\b[^>]*>(?:[^<]+|<(?!/b\s*>))*+</b\s*>|{row})"), 0)

    def lead(event: Column) -> Column:
        return F.regexp_extract(event, r"(?is)^<b\b[^>]*>([^<]*)", 1)

    def is_row(event: Column) -> Column:  # an event is a row or bold
        return ~(event.startswith("<b") | event.startswith("<B"))

    def is_heading(event: Column) -> Column:
        return ~is_row(event) & event.rlike(r"(?isU)^<b\b[^>]*>\s*disc")

    def rows_of(group: Column) -> Column:
        return F.transform(F.filter(group, is_row), lambda r: _track(r, numbered))

    def groups(all_events: Column) -> Column:
        headed = F.transform(
            sections(all_events, positions(all_events, is_heading)),
            lambda g: F.struct(
                F.regexp_extract(lead(F.get(g, F.lit(0))), r"\d+", 0).try_cast("int").alias("number"),
                H.text(H.inner(F.get(g, F.lit(0)))).alias("name"),
                rows_of(g).alias("tracks"),
            ),
        )
        lone = F.struct(F.lit(1).alias("number"), F.lit(None).cast("string").alias("name"), rows_of(all_events).alias("tracks"))
        only = F.when(F.exists(all_events, is_row), F.array(lone)).otherwise(F.slice(F.array(lone), F.lit(1), F.lit(0)))
        return F.when(F.exists(all_events, is_heading), headed).otherwise(only)

    return let(events, groups)


def choose_tabs(html: Column) -> Column:
    """``array<struct<label, canonical, pos, body>>``: one tracklist tab per language label.

    A canonical tab (no parenthesis in its caption) is preferred to an unofficial one; a tab without
    a caption is English.
    """
    box = F.coalesce(H.container(html, "div", 'id="tracklist"'), F.lit(""))  # read once: ``containers`` binds it
    nav = F.coalesce(first(H.containers(html, "ul", 'class="[^"]*tabnav'))["inner"], F.lit(""))
    captions = F.transform(H.elements(nav, "a", 'rel="tl'), lambda a: F.struct(H.attribute(a, "rel").alias("rel"), H.text(H.inner(a)).alias("text")))

    def tabs(named: Column) -> Column:
        def read(tab: Column, i: Column) -> Column:
            own = let(H.attribute(tab["open"], "id"), lambda key: F.try_element_at(F.filter(named, lambda c: c["rel"] == key), F.lit(-1))["text"])

            def with_caption(caption: Column) -> Column:
                return F.struct(
                    strip(F.when(caption.contains("("), F.regexp_replace(caption, r"(?U)\s*\(.*\)\s*$", "")).otherwise(caption)).alias("label"),
                    (~caption.contains("(")).alias("canonical"),
                    i.alias("pos"),
                    tab["inner"].alias("body"),
                )

            return let(F.coalesce(own, F.lit("English")), with_caption)

        return F.transform(H.containers(box, "span", 'class="tl"', flat=False), read)

    def preferred(all_tabs: Column) -> Column:
        ranked = F.array_sort(F.transform(all_tabs, lambda t: F.struct((~t["canonical"]).alias("unofficial"), t["pos"].alias("pos"))))
        ordered = F.transform(ranked, lambda r: F.get(all_tabs, r["pos"]))
        return deduplicate(ordered, lambda t, _i: t["label"])

    # canonical tabs come first, each in page order: the first one is the primary tab
    return let(let(captions, tabs), preferred)


def discs(html: Column) -> Column:
    """``array<struct<number, name, tracks>>`` with titles merged over the language tabs by position.

    The primary tab gives structure, numbers and lengths; other tabs only add titles at the same
    disc and track ordinals.
    """

    def merge(tabs: Column) -> Column:
        def title(label: str, d: Column, t: Column) -> Column:
            tab = first(tabs, lambda x: x["label"] == label)
            return F.get(F.get(tab["discs"], d)["tracks"], t)["title"]

        def track(raw: Column, d: Column, t: Column) -> Column:
            titles = placeholder_rule(title("English", d, t), title("Japanese", d, t), title("Romaji", d, t))
            return F.struct(titles.alias("titles"), raw["number"].alias("number"), raw["length"].alias("length"))

        def disc(raw: Column, d: Column) -> Column:
            tracks = F.transform(raw["tracks"], lambda x, t: track(x, d, t))
            return F.struct(raw["number"].alias("number"), raw["name"].alias("name"), tracks.alias("tracks"))

        return F.transform(F.coalesce(F.get(tabs, F.lit(0))["discs"], F.array()), disc)

    parsed = F.transform(choose_tabs(html), lambda t, i: F.struct(t["label"].alias("label"), _groups(t["body"], i == 0).alias("discs")))
    return let(parsed, merge)


def split_artists(cell: Column, site: str = DEFAULT_SITE) -> Column:
    """``array<struct<names, id, link>>`` of a credit's value cell, in document order.

    Plain text is split at commas that follow a visible character, so "Studio , City" stays whole.
    A linked artist in parentheses right after another is an alias and dropped.
    """
    runs = F.regexp_extract_all(cell, F.lit(r"(?is)<(\w+)\b[^>]*>(?:[^<]+|<(?!/\1\s*>))*+</\1\s*>|<[^>]+>|[^<]+"), 0)

    def tidy(part: Column) -> Column:
        return let(F.btrim(part), lambda p: F.when(p.rlike(PLAIN_NAME), p).otherwise(trimmed(part)))

    def trimmed(part: Column) -> Column:
        bare = F.btrim(F.regexp_replace(part, r"(?U)^[\s,]+|[\s,]+$", ""))
        return F.btrim(let(bare, lambda p: F.when(p.contains("("), F.regexp_replace(p, TRAILING_PAREN, "")).otherwise(p)), F.lit(" ,"))

    def read(run: Column) -> Column:
        shown = lambda link: F.when(link, F.lit("")).otherwise(H.raw_text(run))
        return let(run.rlike(r'(?is)^<a\b[^>]*href="[^"]*/artist/'), lambda link: let(shown(link), lambda text: read_shown(run, link, text)))

    def read_shown(run: Column, link: Column, shown: Column) -> Column:
        parts = F.transform(F.when(shown.contains(","), F.split(shown, LIST_COMMA, -1)).otherwise(F.array(shown)), tidy)
        names = F.filter(parts, lambda n: n.rlike(r"(?U)\w"))
        plain = F.transform(
            names,
            lambda n: F.struct(F.create_map(name_key(n), n).alias("names"), F.lit(None).cast("bigint").alias("id"), F.lit(None).cast("string").alias("link")),
        )
        linked = F.array(reference(run, "artist", ARTIST_CLASS, site))
        return F.struct(
            link.alias("is_link"),
            F.when(run.startswith("<"), F.lit("")).otherwise(shown).alias("text"),
            F.when(link, linked).otherwise(plain).alias("artists"),
        )

    def keep(items: Column) -> Column:
        return let(F.array_min(positions(items, lambda x: F.size(x["artists"]) > 0)) - 1, lambda start: keep_after(items, start))

    def keep_after(items: Column, start: Column) -> Column:
        def is_alias(i: Column) -> Column:
            before = F.rtrim(F.coalesce(F.get(items, i - 1)["text"], F.lit("")))
            after = F.ltrim(F.coalesce(F.get(items, i + 1)["text"], F.lit("")))
            return (i > start) & before.endswith("(") & after.startswith(")")

        return F.flatten(F.transform(F.filter(items, lambda x, i: ~(x["is_link"] & is_alias(i))), lambda x: x["artists"]))

    return let(F.transform(runs, read), keep)


def credit_rows(html: Column, site: str = DEFAULT_SITE) -> Column:
    """``array<struct<role, role_raw, artists>>`` of the credits box; rows without a role are skipped."""
    box = F.coalesce(H.container(html, "div", 'id="collapse_credits"'), F.lit(""))
    rows = F.regexp_extract_all(box, F.lit(r'(?is)<(?:tr)\b(?=[^>]*class="maincred")[^>]*>(?:[^<]+|<(?!tr\b))*+'), 0)

    def read(row: Column) -> Column:
        cells = F.transform(H.pieces(row, r"(?is)<(?:td)\b[^>]*>"), lambda c: F.regexp_replace(c, r"(?is)<(?:/td\s*>).*\z", ""))

        def credit(c: Column) -> Column:
            spans = H.elements(F.get(c, F.lit(0)), "span", f'class="{ARTIST_CLASS}"')
            label = F.coalesce(first(spans), F.get(c, F.lit(0)))
            return F.struct(H.text(label).alias("role_raw"), F.get(c, F.lit(1)).alias("cell"))

        return let(cells, credit)

    found = F.filter(F.transform(rows, read), lambda r: (r["role_raw"] != "") & r["cell"].isNotNull())
    return F.transform(
        found,
        lambda r: F.struct(normalize_role_once(r["role_raw"]).alias("role"), r["role_raw"].alias("role_raw"), split_artists(r["cell"], site).alias("artists")),
    )


def notes_text(html: Column) -> Column:
    return H.plain_notes(H.container(html, H.ANY_TAG, 'id="notes"'))


def event_date(html: Column) -> Column:
    return partial_date(H.text(H.inner(H.element(html, "span", 'class="smallfont label"'))))


# -- whole entities --------------------------------------------------------------------------------


def _entities(pages: DataFrame, kind: str) -> DataFrame:
    """Clean pages of one kind that pass routing, with id, link and names."""
    def head(link: Column) -> Column:
        entity = digits(F.regexp_extract(link, f"/{kind}/(\\d+)", 1), "bigint")
        return F.struct(entity.alias("id"), link.alias("link"), F.when(entity.isNotNull(), names_of_kind(F.col("html"), kind)).alias("names"))

    rows = computed(cleaned(pages), "_head", let(H.canonical_link(F.col("html")), head), lambda x: x["id"].isNotNull() & (F.size(x["names"]) > 0))
    return rows.select("page_id", "html", "_head.*")


def album_records(
    pages: DataFrame, site: str = DEFAULT_SITE, full_host: str = "medium-media.example.org", thumb_host: str = "thumb-media.example.org"
) -> DataFrame:
    """Album documents, assembled inside each page row."""
    page = F.col("html")
    rows = computed(_entities(pages, "album"), "info", info_fields(page))
    info = F.col("info")
    return rows.select(
        "page_id",
        "id",
        "link",
        F.col("names").alias("titles"),
        info_value(info, "Catalog Number").alias("catalog"),
        release_date(info_value(info, "Release Date", "href"), info_value(info, "Release Date")).alias("release_date"),
        info_value(info, "Classification").alias("classification"),
        cover_url(page, thumb_host, F.col("id")).alias("cover_small"),
        cover_url(page, full_host, F.col("id")).alias("cover_full"),
        discs(page).alias("discs"),
        credit_rows(page, site).alias("credits"),
        notes_text(page).alias("notes"),
        release_event(page, site).alias("release_event"),
    )


def _nothing(kind: str = "string") -> Column:
    return F.lit(None).cast(kind)


def artist_records(pages: DataFrame, site: str = DEFAULT_SITE) -> DataFrame:
    rows = computed(_entities(pages, "artist"), "fields", artist_fields(F.col("html")))
    body = lambda label: first(F.col("fields"), lambda f: f["label"] == label)["body"]
    none = F.array().cast("array<struct<names:map<string,string>,id:bigint,link:string>>")
    refs = {label: F.coalesce(references(body(label), "artist", ARTIST_CLASS, site), none) for label in ("Members", "Units")}
    return rows.select(
        "page_id", "id", "link", "names", aliases(body("Aliases")).alias("aliases"), _nothing().alias("type"),
        partial_date(blank_to_null(H.text(body("Birthdate")))).alias("birthdate"), _nothing().alias("notes"),
        refs["Members"].alias("members"), refs["Units"].alias("units"),
    )


def organization_refs(pairs: Column, site: str) -> Column:
    """Developers, then publishers; an id counts once, links without an id always count."""
    bodies = [F.coalesce(definition(pairs, label), F.lit("")) for label in ORG_FIELDS]
    refs = F.concat(*[references(b, "org", PRODUCT_CLASS, site, keep_query=False) for b in bodies])
    return deduplicate(refs, lambda r, i: F.struct(r["id"].alias("id"), F.when(r["id"].isNull(), i).alias("i")))


def product_records(pages: DataFrame, site: str = DEFAULT_SITE) -> DataFrame:
    rows = computed(_entities(pages, "product"), "pairs", label_pairs(F.col("html")))
    franchises = references(F.coalesce(definition(F.col("pairs"), "Franchises"), F.lit("")), "product", PRODUCT_CLASS, site, keep_query=False)
    return rows.select(
        "page_id", "id", "link", "names", _nothing().alias("type"), _nothing().alias("notes"),
        franchises.alias("franchises"), organization_refs(F.col("pairs"), site).alias("organizations"),
    )


def organization_records(pages: DataFrame) -> DataFrame:
    rows = computed(_entities(pages, "org"), "pairs", label_pairs(F.col("html")))
    shown = lambda label: blank_to_null(H.text(definition(F.col("pairs"), label)))
    return rows.select("page_id", "id", "link", "names", shown("Type").alias("type"), shown("Description").alias("notes"))


def event_records(pages: DataFrame) -> DataFrame:
    date = "struct<year:int,month:int,day:int>"
    return _entities(pages, "event").select(
        "page_id", "id", "link", "names", _nothing().alias("type"), event_date(F.col("html")).alias("start_date"),
        _nothing(date).alias("end_date"), _nothing().alias("notes"),
    )


def search_query(html: Column) -> Column:
    """The query in the "N album results for ..." header, empty if there is none."""
    headers = F.transform(H.elements(html, "h3", 'class="label"'), lambda h: H.text(H.inner(h)))
    shape = r'(?U)results for "(.*)"\s*$'
    header = first(headers, lambda t: t.contains("album results for") & t.rlike(shape))
    return F.coalesce(F.regexp_extract(header, shape, 1), F.lit(""))


def search_rows(pages: DataFrame, site: str = DEFAULT_SITE) -> DataFrame:
    """(page_id, query, rank, id, link, titles, catalog, release_date): one row per hit in page order."""
    box = H.container(F.col("html"), "div", 'id="albumresults"')
    rows = computed(cleaned(pages), "box", box, lambda b: b.isNotNull()).select("page_id", search_query(F.col("html")).alias("query"), "box")
    hits = F.regexp_extract_all("box", F.lit(r'(?is)<tr\b(?=[^>]*\srel=)[^>]*>.*?(?=<tr\b|</table|\z)'), 0)
    linked = F.filter(hits, lambda h: h.rlike(r'(?is)<a\b[^>]*href="[^"]*/album/\d'))
    rows = rows.select("page_id", "query", F.posexplode(linked).alias("rank", "hit"))

    title_link = H.element(F.col("hit"), "a", 'href="[^"]*/album/')
    rows = rows.withColumn("a", title_link).withColumn("id", digits(F.regexp_extract(H.attribute(F.col("a"), "href"), r"/album/(\d+)", 1), "bigint"))
    catalog = H.text(H.inner(H.element(F.col("hit"), "span", 'class="[^"]*catalog')))
    cells = F.transform(H.pieces(F.col("hit"), r"(?is)<td\b[^>]*>"), lambda c: F.regexp_replace(c, r"(?is)<(?:/td\s*>).*\z", ""))
    free = F.filter(cells, lambda c: ~c.rlike(r'(?is)<span\b[^>]*class="[^"]*catalog|<a\b[^>]*href="[^"]*/album/'))
    dated = F.filter(F.transform(free, lambda c: partial_date(blank_to_null(H.text(c)))), lambda d: d.isNotNull())
    return rows.select(
        "page_id", "query", (F.col("rank") + 1).alias("rank"), "id", F.concat(F.lit(site + "/album/"), "id").alias("link"),
        H.localized(H.language_spans(F.col("a"), TITLE_CLASS)).alias("titles"),
        let(catalog, lambda c: F.when(~c.isin("", "N/A"), c)).alias("catalog"), first(dated).alias("release_date"),
    )


# -- edges -----------------------------------------------------------------------------------------


def edges(albums: DataFrame | None = None, artists: DataFrame | None = None, products: DataFrame | None = None) -> DataFrame:
    """(src_kind, src, rel, pos, dst_kind, dst_id, names, link) of entity records, document order.

    All references of a record leave in one explode, so a page is parsed once for all its relations.
    """

    def labelled(rel: str, dst_kind: str, refs: Column) -> Column:
        return F.transform(refs, lambda r, i: F.struct(F.lit(rel).alias("rel"), i.alias("pos"), F.lit(dst_kind).alias("dst_kind"), r.alias("ref")))

    def rows(records: DataFrame, src_kind: str, *relations: Column) -> DataFrame:
        found = F.filter(F.concat(*relations), lambda e: F.size(e["ref"]["names"]) > 0)
        exploded = records.select(F.lit(src_kind).alias("src_kind"), F.col("id").alias("src"), F.explode(found).alias("e"))
        return exploded.select("src_kind", "src", "e.rel", "e.pos", "e.dst_kind", F.col("e.ref.id").alias("dst_id"), "e.ref.names", "e.ref.link")

    parts = []
    if albums is not None:
        credited = F.flatten(F.transform("credits", lambda c: c["artists"]))
        parts.append(rows(albums, "album", labelled("credit", "artist", credited), labelled("release_event", "event", F.array_compact(F.array("release_event")))))
    if artists is not None:
        parts.append(rows(artists, "artist", *[labelled(rel, "artist", F.col(rel)) for rel in ("members", "units")]))
    if products is not None:
        parts.append(rows(products, "product", labelled("franchises", "product", F.col("franchises")), labelled("organizations", "org", F.col("organizations"))))
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def merge_edges(edge_rows: DataFrame, keys: tuple[str, ...] = ("src", "dst_id"), order: tuple[str, ...] = ("field_ord", "pos")) -> DataFrame:
    """First edge per key in field and document order; edges without a target id are all kept.

    Repeated edges collapse on the map side, before the shuffle.
    """
    lone = F.when(F.col(keys[-1]).isNull(), F.struct(*order))
    rest = [c for c in edge_rows.columns if c not in keys]
    best = edge_rows.groupBy(*keys, lone.alias("_lone")).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("e"))
    return best.select(*keys, "e.*")


