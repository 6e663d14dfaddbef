"""Reading HTML with string expressions, one page per row.

A page is cut into the few fragments that matter by literal patterns; nothing is exploded before the
result rows, so page extraction needs no shuffle and no Python.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from html.entities import html5, name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from sleevework.functions.core import blank_to_null, digits, let
from sleevework.functions.localized import placeholder_rule
from sleevework.functions.text import collapse, strip

NOISE = r"(?is)<(?:script\b.*?</script\s*>|style\b.*?</style\s*>|!--.*?-->)"
_ATTRIBUTES = r"""(?>[^>=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|=)*+"""  # up to the end of a tag; quoted values may hold anything
TOKEN = rf"<(?=[^>]){_ATTRIBUTES}>|[^<]+"
_OPEN_VALUE = r"""<[A-Za-z](?>[^<>=]++|=\s*+"[^"<>]*+"|=\s*+'[^'<>]*+'|=(?!\s*+["']))*+=\s*+(?:"[^"<>]*+[<>]|'[^'<>]*+[<>])"""
_MARKED_VALUE = r"""=\s*+(?:"[^"<>]*+[<>]|'[^'<>]*+[<>])"""  # in all pages with an open value and few others; quick to look for
TAG = r"<[^>]*>"
_WORDS = r"\A[!-%'-;=-~]++(?: [!-%'-;=-~]++)*+\z"
_NAME = _WORDS.replace(r"\A", r"\A(?!/)")  # that do not begin with a separator
LINE_BREAK = r"(?i)<br\s*/?>"

# characters that stay escaped until a text is read, because decoding them early would forge markup
_MARKUP = {"&": "&amp;", "<": "&lt;", ">": "&gt;", '"': "&quot;", "'": "&#39;"}
_SHORT = sorted((n for n in html5 if n in name2codepoint), key=len, reverse=True)  # names that may go without a semicolon
_ENTITY = r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"
_OPEN_ENTITY = rf"^(#[0-9]{{1,7}}|#[xX][0-9a-fA-F]{{1,6}}|{'|'.join(_SHORT)})(?![0-9A-Za-z=;])"
_LONGEST_ENTITY = 40  # no known name and no number is nearly as long
ANY_TAG = "[A-Za-z][A-Za-z0-9]*"
NESTED = 3  # elements of its own tag inside an element are followed by pattern so deep, deeper ones are counted


def _code_page() -> dict[int, str]:
    """Code points 128 to 159 stand for the characters of the Windows code page."""
    pairs = ((n, bytes([n]).decode("cp1252", "ignore")) for n in range(128, 160))
    return {n: c for n, c in pairs if c}


def _names() -> dict[str, str]:
    """The entity names of HTML 4 and ``apos``; those of markup characters keep them escaped."""
    full = {n: html5[f"{n};"] for n in [*name2codepoint, "apos"]}
    return {n: _MARKUP.get(c, c) for n, c in full.items()}


def _constant_map(entries: dict[str, str]) -> Column:
    """A map of literals, which the optimizer folds to a constant."""
    quoted = lambda t: "'" + t.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return F.expr("map(" + ", ".join(f"{quoted(k)}, {quoted(v)}" for k, v in entries.items()) + ")")


def _code_point(number: Column) -> Column:
    valid = number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
    text = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
    special = {**{ord(c): e for c, e in _MARKUP.items()}, **_code_page()}
    markup = _constant_map({str(n): c for n, c in special.items()})
    return F.when(valid, F.coalesce(markup[number.cast("string")], text)).otherwise(F.lit("�"))


def _decode_names(html: Column) -> Column:
    """Named and numeric entities to characters, except those that stand for markup."""
    named = _constant_map(_names())

    def entity(name: Column) -> Column:
        decimal = digits(F.regexp_extract(name, "^#([0-9]+)$", 1), "bigint")
        hexadecimal = F.conv(F.nullif(F.regexp_extract(name, "^#[xX](.+)$", 1), F.lit("")), 16, 10).try_cast("bigint")
        number = F.coalesce(decimal, hexadecimal)
        return F.when(name.startswith("#"), _code_point(number)).otherwise(named[name])

    def found(text: Column) -> Column:
        closed, bare = F.regexp_extract(text, _ENTITY, 1), F.regexp_extract(text, _OPEN_ENTITY, 1)
        return let(closed, lambda c: F.when(c != "", F.struct(c.alias("n"), F.lit(2).alias("skip"))).otherwise(F.struct(bare.alias("n"), F.lit(1).alias("skip"))))

    def piece(text: Column, i: Column) -> Column:
        name = let(F.substring(text, 1, _LONGEST_ENTITY), found)  # a search goes on behind the place it is bound to
        decoded = let(name, lambda x: F.when(x["n"] != "", F.concat(entity(x["n"]), F.substr(text, F.length(x["n"]) + x["skip"]))))
        return F.when(i == 0, text).when(text.startswith("amp;"), F.concat(F.lit("&"), text)).otherwise(F.coalesce(decoded, F.concat(F.lit("&"), text)))

    return F.array_join(F.transform(F.split(html, "&", -1), piece), "")


def _escape_values(html: Column) -> Column:
    """The page with ``<`` and ``>`` inside quoted attribute values escaped, so that a tag ends at its first ``>``.

    Values are decoded again where an attribute is read. Pages without such a value are left as they are.
    """

    def escaped(token: Column) -> Column:
        inside = F.substr(token, F.lit(2), F.length(token) - 2)
        inside = F.replace(F.replace(inside, F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
        return F.when(token.rlike(r"(?s)^<.*[<>].*>\z"), F.concat(F.lit("<"), inside, F.lit(">"))).otherwise(token)

    tokens = F.regexp_extract_all(html, F.lit(f"<{_ATTRIBUTES}>|[^<]+|<"), 0)
    return F.when(html.rlike(_OPEN_VALUE), F.array_join(F.transform(tokens, escaped), "")).otherwise(html)


def clean(html: Column) -> Column:
    """The page without scripts, styles and comments, with ordinary entities decoded.

    Every pattern has to decode the bytes of a page first, so those that few pages need come after a plainer look.
    """
    escaped = lambda bare: F.when(bare.rlike(_MARKED_VALUE), _escape_values(bare)).otherwise(bare)
    decoded = lambda h: F.when(h.contains("&"), _decode_names(h)).otherwise(h)
    return let(F.regexp_replace(html, NOISE, ""), lambda bare: let(escaped(bare), decoded))


def unescape(text: Column) -> Column:
    """The remaining entities of a text taken from a clean page."""

    def decode(escaped: Column) -> Column:
        out = escaped
        for char in ('"', "'", "<", ">", "&"):
            out = F.replace(out, F.lit(_MARKUP[char]), F.lit(char))
        return F.when(escaped.contains("&"), out).otherwise(escaped)

    return let(text, decode)


def tag_name(token: Column) -> Column:
    return F.lower(F.regexp_extract(token, r"^</?\s*([A-Za-z][A-Za-z0-9]*)", 1))


def attribute(tag: Column, name: str) -> Column:
    """Value of an attribute of an opening tag, NULL if it is not there."""
    quoted = rf"""(?is)^<[^>]*?\s{name}\s*=\s*(["'])(.*?)\1"""
    bare = rf"""(?is)^<[^>]*?\s{name}\s*=\s*([^\s"'>]+)"""

    def read(t: Column) -> Column:
        other = lambda: F.when(t.rlike(quoted), F.lit("")).when(t.rlike(bare), F.regexp_extract(t, bare, 1))
        return let(F.regexp_extract(t, quoted, 2), lambda value: F.when(value != "", unescape(value)).otherwise(other()))

    return let(tag, read)


def _untagged(fragment: Column, by: str = "") -> Column:
    return let(fragment, lambda f: F.when(f.contains("<"), F.regexp_replace(f, TAG, by)).otherwise(f))


def raw_text(fragment: Column) -> Column:
    """Text of a fragment as it stands."""
    return unescape(_untagged(fragment))


def text(fragment: Column) -> Column:
    """Text of a fragment with whitespace collapsed; a missing element has the empty text."""
    return _shown(fragment, "")


def _shown(fragment: Column, by: str) -> Column:
    """Text of a fragment with its tags replaced. Words without markup between single spaces, as most are, stay as they are."""
    return let(fragment, lambda f: F.when(f.rlike(_WORDS), f).otherwise(_read(f, by)))


def _read(fragment: Column, by: str = "") -> Column:
    """Text of a fragment that is not plain words."""
    return F.coalesce(collapse(unescape(_untagged(fragment, by))), F.lit(""))


def spaced_text(fragment: Column) -> Column:
    """Like ``text``, but the texts of neighbouring elements are kept apart by a space."""
    return _shown(fragment, " ")


def _condition(having: str) -> str:
    """``name="value"`` in any quoting, or with the last quote left out a value that begins so; other patterns as they are.

    The name must be a whole one: ``id`` is not found in ``data-id``.
    """
    got = re.fullmatch(r'([a-z]+)="(.*?)("?)', having)
    if not got:
        return rf"(?<=\s){having}"
    name, value, closed = got.groups()
    single, bare = value.replace('[^"]', "[^']"), value.replace('[^"]', "[^\\s\"'>]")
    ends = ('"', "'", r"(?=[\s/>])") if closed else ("", "", "")
    return rf"""\s{name}\s*=\s*(?:"{value}{ends[0]}|'{single}{ends[1]}|{bare}{ends[2]})"""


def _opening(tag: str, having: str) -> str:
    """An opening tag. Its first character stands alone: a page is searched for one character twice as fast as for the whole name."""
    condition = rf"(?=[^>]*{_condition(having)})" if having else ""
    return rf"<(?:{tag})\b{condition}[^>]*>"


def _element(tag: str, having: str) -> str:
    """From an opening tag to the first close of its tag; text is passed over in runs, not by the character. The inside is a group."""
    return rf"(?is){_opening(tag, having)}((?:[^<]+|<(?!/{tag}\s*>))*+)</{tag}\s*>"


def _held(own: str, but: str = "") -> str:
    """Pattern of what an element holds: all up to a close or an opening of its tag that no close follows.

    Elements of the tag itself are passed over, up to ``NESTED`` deep, if their close is written plainly and their opening
    does not match ``but``.
    """
    other = rf"[^<]+|<(?!{own}\b|/{own}\s*>)"
    held = rf"(?:{other})*+"
    for _ in range(NESTED):
        held = rf"(?:{other}|{f'(?!{but})' if but else ''}<{own}\b{held}(?-i:</{own}>))*+"
    return held


def _whole(tag: str, having: str, ends: str, *, but: str = "") -> str:
    """Pattern of an opening tag and what its element holds, followed by ``ends(own tag)``.

    Of an element that a pattern cannot follow, only the opening tag is found, without its last character.
    """
    own = tag if tag.isalnum() else r"\1"
    opening = (_opening(tag, having) if tag.isalnum() else _opening(tag, having).replace("(?:", "(", 1)).removesuffix(">")
    return rf"(?is){opening}(?=>)(?:>{_held(own, but)}{ends.format(own=own)})?+"


def _held_by(element: Column) -> Column:
    """The inside of what ``_whole`` found: all after the end of the opening tag."""
    return F.substr(element, F.position(F.lit(">"), element) + 1)


def _cut(element: Column) -> Column:
    """``struct<open, inner>`` of what ``_whole`` found."""
    return F.struct(F.concat(F.substring_index(element, ">", 1), F.lit(">")).alias("open"), _held_by(element).alias("inner"))


def has(html: Column, tag: str, having: str) -> Column:
    """Whether there is an opening tag that matches ``having``."""
    return html.rlike(rf"(?is){_opening(tag, having)}")


def elements(html: Column, tag: str, having: str = "") -> Column:
    """Whole elements whose opening tag matches ``having``; for tags that do not nest in themselves."""
    return F.regexp_extract_all(html, F.lit(_element(tag, having)), 0)


def element(html: Column, tag: str, having: str = "") -> Column:
    """The first of ``elements``, NULL if there is none; the search ends at it."""
    return blank_to_null(F.regexp_extract(html, _element(tag, having), 0))


def element_text(html: Column, tag: str, having: str = "") -> Column:
    """``text(inner(element(...)))`` with one search."""
    def inside(found: Column) -> Column:
        return F.when(found.contains("</"), F.regexp_replace(found, r"</[^>]*\z", "")).otherwise(found)  # ``inner`` drops an open close, too

    return text(let(F.regexp_extract(html, _element(tag, having), 1), inside))


def opening_tag(html: Column, tag: str, having: str = "") -> Column:
    """The first of ``opening_tags``, NULL if there is none."""
    return blank_to_null(F.regexp_extract(html, rf"(?is){_opening(tag, having)}", 0))


def opening_tags(html: Column, tag: str, having: str = "") -> Column:
    return F.regexp_extract_all(html, F.lit(rf"(?is){_opening(tag, having)}"), 0)


def inner(element: Column) -> Column:
    """An element without its own tags."""
    return F.regexp_replace(element, r"(?s)^<[^>]*>|</[^>]*>\z", "")


def _at_close(tail: Column, tag: Column, *, rest: bool = False, flat: bool = False) -> Column:
    """``struct<inner>``, with ``rest`` also ``rest``: ``tail`` cut at the close of an element of ``tag`` opened just before it.

    ``flat`` first tries whether the element holds none of its own tag and ends at the first close, which leaves the
    rest of the page alone; the result is the same.
    """

    def cut(x: Column) -> Column:
        def step(state: Column, piece: Column) -> Column:
            opened = F.size(F.regexp_extract_all(piece, F.concat(F.lit("(?is)<"), x["tag"], F.lit(r"\b")), 0))
            inside = F.struct((state["depth"] + opened - 1).alias("depth"), (state["taken"] + 1).alias("taken"))
            return F.when(state["depth"] > 0, inside).otherwise(state)

        def joined(items: Column) -> Column:
            return F.call_function("array_join", items, F.concat(F.lit("</"), x["tag"], F.lit(">")))

        def parts(n: Column) -> Column:
            inner = joined(F.slice(x["pieces"], F.lit(1), n)).alias("inner")
            after = [joined(F.slice(x["pieces"], n + 1, F.size(x["pieces"]))).alias("rest")] if rest else []
            return F.struct(inner, *after)

        start = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("taken"))
        return let(F.aggregate(x["pieces"], start, step, lambda s: s["taken"]), parts)

    closing, opening = F.concat(F.lit("(?is)</"), tag, F.lit(r"\s*>")), F.concat(F.lit("(?is)<"), tag, F.lit(r"\b"))

    def counted(text: Column) -> Column:
        return let(F.struct(F.split(text, closing, -1).alias("pieces"), tag.alias("tag")), cut)

    def whole(text: Column) -> Column:
        inside = F.get(F.split(text, closing, 2), F.lit(0))
        plain = lambda x: F.when(F.size(F.regexp_extract_all(x, opening, 0)) == 0, F.struct(x.alias("inner"))).otherwise(counted(text))
        return let(inside, plain)

    return let(tail, whole) if flat else counted(tail)


def containers(html: Column, tag: str, having: str, lead: str = "", *, flat: bool = True) -> Column:
    """``array<struct<open, inner>>`` of elements that may hold others of their own tag.

    The end is found by counting openings and closings of that one tag, which survives unclosed
    elements of other tags inside. ``tag`` may be a pattern for several tags; ``lead`` is a pattern that
    must follow the opening tag and is reported with it. ``flat`` is for elements that seldom hold their own tag.
    """
    pattern = rf"(?is){_opening(tag, having)}{lead}"

    def counted(page: Column) -> Column:
        opens = F.regexp_extract_all(page, F.lit(pattern), 0)
        tails = let(F.split(page, pattern, -1), lambda parts: F.slice(parts, F.lit(2), F.size(parts)))
        return F.zip_with(opens, tails, lambda o, t: F.struct(o.alias("open"), _at_close(t, _own_tag(o, tag), flat=flat)["inner"].alias("inner")))

    if lead or not tag.isalnum():
        return let(html, counted)
    opening = _opening(tag, having)  # the next such opening ends an element too
    whole = _whole(tag, having, rf"(?=</{{own}}\s*>|\z|{opening.replace('{', '{{').replace('}', '}}')})", but=opening)

    def read(page: Column) -> Column:
        unclear = lambda e: ~e.contains(">")
        return let(F.regexp_extract_all(page, F.lit(whole), 0), lambda found: F.when(F.exists(found, unclear), counted(page)).otherwise(F.transform(found, _cut)))

    return let(html, read)


def _own_tag(opening: Column, tag: str) -> Column:
    return F.lit(tag) if tag.isalnum() else F.regexp_extract(opening, f"^<({ANY_TAG})", 1)


def _split_at(html: Column, tag: str, having: str, read: Callable[[Column, Column, Column], Column]) -> Column:
    """``read(head, tail, tag)`` around the first such opening, NULL if the page has none; one search of the page."""
    parts = F.split(html, rf"(?is){_opening(tag, having)}", 2)

    def around(x: Column) -> Column:
        head, tail = F.get(x["parts"], F.lit(0)), F.get(x["parts"], F.lit(1))
        opening = F.substring(x["html"], F.length(head) + 1, F.lit(32))  # long enough for the name of any tag
        return F.when(F.size(x["parts"]) > 1, read(head, tail, _own_tag(opening, tag)))

    return let(F.struct(html.alias("html"), parts.alias("parts")), around)


def container(html: Column, tag: str, having: str) -> Column:
    """Inner HTML of the first such element, NULL if the page has none."""
    def read(page: Column) -> Column:
        counted = lambda: _split_at(page, tag, having, lambda _head, tail, own: _at_close(tail, own)["inner"])
        found = F.regexp_extract(page, _whole(tag, having, r"(?=</{own}\s*>|\z)"), 0)
        return let(found, lambda e: F.when(e.contains(">"), _held_by(e)).when(e != "", counted()))

    return let(html, read)


def without_container(html: Column, tag: str, having: str) -> Column:
    """The page without the first such element, cut out by its place."""
    def read(page: Column) -> Column:
        counted = lambda: _split_at(page, tag, having, lambda head, tail, own: F.concat(head, F.lit(" "), _at_close(tail, own, rest=True)["rest"]))

        def cut_out(x: Column) -> Column:
            return F.concat(F.substr(page, F.lit(1), x["at"] - 1), F.lit(" "), F.substr(page, x["at"] + F.length(x["all"])))

        # no text like that of the first such element can stand ahead of it
        cut = lambda e: let(F.struct(e.alias("all"), F.position(e, page).alias("at")), cut_out)
        found = F.regexp_extract(page, _whole(tag, having, r"(?:</{own}\s*>|\z)"), 0)
        return let(found, lambda e: F.when(e.contains(">"), cut(e)).when(e != "", counted()).otherwise(page))

    return let(html, read)


def pieces(html: Column, opening: str) -> Column:
    """What follows each match of ``opening`` up to the next one: table rows, cells and the like."""
    return F.regexp_extract_all(html, F.lit(rf"{opening}((?:[^<]+|<(?!{opening.removeprefix('(?is)<')}))*+)"), 1)


def language_spans(html: Column, css_class: str, group: Callable[[Column], Column] | None = None) -> Column:
    """``array<struct<lang, text>>`` of the language spans of a class, separators stripped.

    ``group`` takes some of them by their languages, such as ``leading_group``, before any text is read.
    """
    spans = containers(html, "span", f'class="{css_class}"')
    lang = lambda span: attribute(span["open"], "lang").alias("lang")
    text_of = lambda span: _name_text(span["inner"]).alias("text")
    if group is None:
        return F.transform(spans, lambda s: F.struct(lang(s), text_of(s)))
    return F.transform(group(F.transform(spans, lambda s: F.struct(lang(s), s["inner"].alias("inner")))), lambda s: F.struct(s["lang"].alias("lang"), text_of(s)))


def _name_text(fragment: Column) -> Column:
    """``text`` without a leading separator and stripped. Plain words without a separator, as most names are, stay as they are."""
    bare = lambda t: F.when(t.startswith("/"), F.regexp_replace(t, r"(?U)^/\s*", "")).otherwise(t)
    return let(fragment, lambda f: F.when(f.rlike(_NAME), f).otherwise(strip(let(_read(f), bare))))


def leading_group(spans: Column) -> Column:
    """The spans before the first repetition of a language; spans without one stay in."""

    def cut(all_spans: Column) -> Column:
        languages = F.filter(
            F.transform(all_spans, lambda s, i: F.struct(s["lang"].alias("lang"), i.alias("i"))),
            lambda x: F.coalesce(x["lang"], F.lit("")) != "",
        )
        repeated = let(
            F.array_sort(languages),
            lambda order: F.transform(F.filter(order, lambda x, k: (k > 0) & (F.get(order, k - 1)["lang"] == x["lang"])), lambda x: x["i"]),
        )
        return F.slice(all_spans, F.lit(1), F.coalesce(F.array_min(repeated), F.size(all_spans)))

    return let(spans, cut)


def localized(spans: Column) -> Column:
    """Language spans as a language map; a later span of a language replaces an earlier one."""

    def by(all_spans: Column, lang: str) -> Column:
        return F.try_element_at(F.filter(all_spans, lambda s: s["lang"] == lang), F.lit(-1))["text"]

    return let(spans, lambda s: placeholder_rule(by(s, "en"), by(s, "ja"), by(s, "ja-Latn")))


def canonical_link(html: Column) -> Column:
    return attribute(opening_tag(html, "link", 'rel="canonical"'), "href")


def plain_notes(fragment: Column) -> Column:
    """Line breaks kept, tags dropped, ends stripped; an empty text is NULL."""
    return blank_to_null(strip(unescape(_untagged(F.regexp_replace(fragment, LINE_BREAK, "\n")))))
