"""Mining per-track credits from freeform notes.

A notes text is one row, and everything up to the per-track credit rows is worked out inside that
row with array expressions: no shuffle, no window, and a third of all lines under one album costs no
more than those lines themselves. The only exchange is the semi join against the known tracks.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sleevework.functions.core import computed, group, let, positions, sections
from sleevework.functions.roles import has_role_keyword, normalize_role, normalize_role_once
from sleevework.functions.text import is_blank, lines, notes_name_key, strip
from sleevework.functions.tracks import inline_groups, parse_track_set, split_names

# The shapes of a numbered header, a range header and a role line.
NUMBERED_HEADER = r"(?U)^\s*(\d+)\.\s"
RANGE_HEADER = r"(?iU)^\s*(?:tracks?\s+)?(M?-?\d[\dM~,\s.-]*?)\s*(?:-\s+\S.*)?$"
HEADER_START = r"(?iU)^\s*(?:tracks?\s+)?M?-?\d"  # how both kinds of headers begin
ROLE_BY = r"(?iU)^\s*([^:]{1,40}?)\s+by\s+(.+)$"
ROLE_COLON = r"(?iU)^\s*([^:]{1,40}?):\s*(.+)$"

Backend = Callable[[DataFrame, DataFrame], DataFrame]


def header_tracks(line: Column) -> Column:
    """Tracks announced by a header line, NULL for any other line."""
    number = F.regexp_extract(line, NUMBERED_HEADER, 1).try_cast("bigint")
    numbered = F.filter(F.array(number), lambda n: n.isNotNull())
    ranges = let(parse_track_set(F.regexp_extract(line, RANGE_HEADER, 1)), lambda t: F.when(F.size(t) > 0, t))
    header = F.when(line.rlike(NUMBERED_HEADER), numbered).when(line.rlike(RANGE_HEADER), ranges)
    return F.when(line.rlike(HEADER_START), header)


def role_line(line: Column) -> Column:
    """``struct<phrase, value>`` of a line that credits somebody, NULL for any other line."""

    def shape(pattern: str) -> Column:
        # the phrase of a match is never empty
        return let(group(line, pattern, 1), lambda phrase: F.when(phrase.isNotNull(), F.struct(phrase.alias("phrase"), group(line, pattern, 2).alias("value"))))

    # the patterns are tried on lines that hold their fixed part only
    by, colon = F.when(F.lower(line).contains("by"), shape(ROLE_BY)), F.when(line.contains(":"), shape(ROLE_COLON))
    parts = F.coalesce(by, colon)
    return let(parts, lambda p: F.when(has_role_keyword(p["phrase"]), p))


def parsed_lines(notes: Column) -> Column:
    """``array<struct<pos, line, header, role>>``; at most one of header and role is set."""

    def parse(line: Column, i: Column) -> Column:
        blank = is_blank(line)
        header = F.when(~blank, header_tracks(line))
        return let(
            header,
            lambda h: F.struct(
                i.alias("pos"),
                line.alias("line"),
                h.alias("header"),
                F.when(~blank & h.isNull(), role_line(line)).alias("role"),
            ),
        )

    return F.transform(lines(notes), parse)


def note_blocks(notes: Column) -> Column:
    """``array<struct<context, lines>>``.

    Every line that is not a role line opens a block: a header gives it tracks, a blank or prose line
    gives it none. The role lines up to the next opener share the block's context.
    """

    def split(parsed: Column) -> Column:
        openers = positions(parsed, lambda x: x["role"].isNull())
        starts = F.array_distinct(F.concat(F.array(F.lit(1)), openers))
        blocks = F.transform(
            sections(parsed, starts),
            lambda b: F.struct(F.get(b, F.lit(0))["header"].alias("context"), b.alias("lines")),
        )
        return F.when(F.size(parsed) > 0, blocks)

    return let(parsed_lines(notes), split)


def explode_lines(notes: DataFrame, key: str = "album_id", text: str = "notes") -> DataFrame:
    """(key, pos, line) in document order, positions from 0."""
    return notes.select(key, F.posexplode(lines(F.col(text))).alias("pos", "line"))


def block_context(notes: DataFrame, key: str = "album_id", text: str = "notes") -> DataFrame:
    """(key, pos, line, kind, context, phrase, value): each line with the tracks in force at it."""
    blocks = notes.select(key, F.explode(note_blocks(F.col(text))).alias("b"))
    rows = blocks.select(key, F.col("b.context").alias("context"), F.explode("b.lines").alias("l"))
    kind = (
        F.when(F.col("l.role").isNotNull(), "role")
        .when(F.col("l.header").isNotNull(), "header")
        .when(is_blank(F.col("l.line")), "blank")
        .otherwise("prose")
    )
    return rows.select(key, "l.pos", "l.line", kind.alias("kind"), "context", "l.role.phrase", "l.role.value")


def _role_rows(notes: DataFrame, key: str, text: str) -> DataFrame:
    """Only the role lines, exploded; blocks without any are cut before the explode."""
    credited = F.transform(
        note_blocks(F.col(text)),
        lambda b: F.struct(b["context"].alias("context"), F.filter(b["lines"], lambda x: x["role"].isNotNull()).alias("roles")),
    )
    blocks = notes.select(key, F.explode(F.filter(credited, lambda b: F.size(b["roles"]) > 0)).alias("b"))
    rows = blocks.select(key, F.col("b.context").alias("context"), F.explode("b.roles").alias("l"))
    return rows.select(key, "l.pos", "context", "l.role.phrase", "l.role.value")


def _named(groups: Column) -> Column:
    """``array<struct<names array, tracks array>>``; groups whose names all fall away credit nobody."""
    named = F.transform(groups, lambda g: F.struct(split_names(g["names"]).alias("names"), g["tracks"].alias("tracks")))
    return F.filter(named, lambda g: F.size(g["names"]) > 0)


def _attribution(value: Column, context: Column) -> Column:
    """``struct<inline, groups>`` of a role line's value: its inline groups if there are any, or else all of it for the context."""

    def choose(groups: Column) -> Column:
        whole = F.when(context.isNotNull(), F.array(F.struct(value.alias("names"), context.alias("tracks"))))
        return F.struct((F.size(groups) > 0).alias("inline"), _named(F.when(F.size(groups) > 0, groups).otherwise(whole)).alias("groups"))

    return let(inline_groups(value), choose)


def attributed(notes: DataFrame, key: str = "album_id", text: str = "notes") -> DataFrame:
    """(key, track, pos, grp, phrase, names, inline): one row per credited track and group of names.

    A role line without inline groups and without a context credits nobody: precision first. ``inline`` tells
    whether the line names its tracks itself.
    """
    roles = computed(_role_rows(notes, key, text), "a", _attribution(F.col("value"), F.col("context")))
    rows = roles.select(key, "pos", "phrase", F.col("a.inline").alias("inline"), F.posexplode("a.groups").alias("grp", "g"))
    return rows.select(key, F.explode("g.tracks").alias("track"), "pos", "grp", "phrase", F.col("g.names").alias("names"), "inline")


def emit(notes: DataFrame, key: str = "album_id", text: str = "notes", *, use_context: bool = True) -> DataFrame:
    """(key, track, pos, grp, phrase, names) of ``attributed``; without context only the lines that name their tracks."""
    rows = attributed(notes, key, text)
    return (rows if use_context else rows.where("inline")).drop("inline")


def valid_tracks_only(credits: DataFrame, tracks: DataFrame, key: str = "album_id") -> DataFrame:
    """Keep credits of tracks the album has; numbers are pooled over its discs.

    The track list is reduced before its shuffle, so repeated numbers of one huge album collapse on
    the map side, and the join reuses the partitioning of that reduction.
    """
    known = tracks.select(key, F.col("number").cast("bigint").alias("track")).where("track is not null").distinct()
    return credits.join(known, [key, "track"], "left_semi")


def refs(names: Column) -> Column:
    """Unlinked artist references, named under the language of their script."""
    return F.transform(
        names,
        lambda n: F.struct(
            F.create_map(notes_name_key(n), n).alias("names"),
            F.lit(None).cast("bigint").alias("id"),
            F.lit(None).cast("string").alias("link"),
        ),
    )


def make_credit(emitted: DataFrame) -> DataFrame:
    """Normalized role, stripped verbatim label, one reference per name."""
    phrase = F.col("phrase")
    return emitted.withColumns({"role": normalize_role(phrase), "role_raw": strip(phrase), "artists": refs(F.col("names"))}).drop("phrase")


def mine_credits(notes: DataFrame, tracks: DataFrame) -> DataFrame:
    """The whole of it: notes(album_id, notes) and tracks(album_id, number) to credit rows."""
    return make_credit(valid_tracks_only(emit(notes), tracks))


def mine_inline_credits(notes: DataFrame, tracks: DataFrame) -> DataFrame:
    """A stricter backend for contrast: inline groups only, block context ignored."""
    return make_credit(valid_tracks_only(emit(notes, use_context=False), tracks))


BACKENDS: dict[str, Backend] = {"rules": mine_credits, "inline_only": mine_inline_credits}
#: Backends that keep some of the same attributed rows; one reading of the notes serves them all.
SELECTIONS: dict[Backend, Callable[[], Column]] = {mine_credits: lambda: F.lit(True), mine_inline_credits: lambda: F.col("inline")}


def run_backends(notes: DataFrame, tracks: DataFrame, backends: Mapping[str, Backend] | None = None) -> DataFrame:
    """Credits of several named backends side by side, labelled ``backend``.

    The notes are parsed once for all backends that are selections of the same rows, each row then repeated for the
    backends that keep it; any other backend runs by itself.
    """
    chosen = BACKENDS if backends is None else backends
    runs = [run(notes, tracks).withColumn("backend", F.lit(name)) for name, run in chosen.items() if run not in SELECTIONS]
    labels = [F.when(SELECTIONS[run](), F.lit(name)) for name, run in chosen.items() if run in SELECTIONS]
    if labels:
        known = make_credit(valid_tracks_only(attributed(notes), tracks))
        kept = F.filter(F.array(*labels), lambda name: name.isNotNull())
        runs.insert(0, known.select(*[c for c in known.columns if c != "inline"], F.explode(kept).alias("backend")))
    out = runs[0]
    for more in runs[1:]:
        out = out.unionByName(more)
    return out


def enrich(albums: DataFrame, credits: DataFrame | None = None) -> DataFrame:
    """(album_id, n_credits): every album, also those no backend found anything for."""
    if credits is None:
        return albums.select("album_id", F.lit(0).cast("bigint").alias("n_credits"))
    counts = credits.groupBy("album_id").agg(F.count(F.lit(1)).alias("n"))
    return albums.join(counts, "album_id", "left").select("album_id", F.coalesce("n", F.lit(0)).alias("n_credits"))


def _credits_by_track(notes: Column, numbers: Column) -> Column:
    """``map<track, array<credit>>`` of one album row, tracks ascending, credits in notes order."""

    def credits_of_line(context: Column, line: Column) -> Column:
        def credits_of_group(g: Column) -> Column:
            made = F.struct(
                normalize_role_once(line["role"]["phrase"]).alias("role"),
                strip(line["role"]["phrase"]).alias("role_raw"),
                refs(g["names"]).alias("artists"),
            )
            # built once per group, repeated per track
            return let(made, lambda c: F.transform(F.array_intersect(g["tracks"], numbers), lambda t: F.struct(t.alias("track"), c.alias("credit"))))

        return F.flatten(F.transform(F.coalesce(_attribution(line["role"]["value"], context)["groups"], F.array()), credits_of_group))

    def credits_of_block(block: Column) -> Column:
        roles = F.filter(block["lines"], lambda x: x["role"].isNotNull())
        return F.flatten(F.transform(roles, lambda line: credits_of_line(block["context"], line)))

    def gather(found: Column) -> Column:
        heads = F.filter(
            F.transform(found, lambda c, i: F.when((i == 0) | (F.get(found, i - 1)["track"] != c["track"]), i + 1)),
            lambda p: p.isNotNull(),
        )
        entry = lambda part: F.struct(
            F.get(part, F.lit(0))["track"].alias("track"),
            F.transform(part, lambda c: c["credit"]).alias("credits"),
        )
        return F.map_from_entries(F.transform(sections(found, heads), entry))

    def ordered(found: Column) -> Column:
        # maps cannot be compared, so the order is settled on the plain fields before them
        index = F.array_sort(F.transform(found, lambda c, i: F.struct(c["track"].alias("track"), i.alias("i"))))
        return F.transform(index, lambda x: F.get(found, x["i"]))

    found = F.flatten(F.transform(F.coalesce(note_blocks(notes), F.array()), credits_of_block))
    return let(let(found, ordered), gather)


def assemble_enrichment(albums: DataFrame, notes: str = "notes", numbers: str = "track_numbers") -> DataFrame:
    """(album_id, track_credits): the nested overlay, built inside each album row without a shuffle."""
    overlay = _credits_by_track(F.col(notes), F.col(numbers))
    return computed(albums.select("album_id", notes, numbers), "track_credits", overlay).select("album_id", "track_credits")


def is_empty(track_credits: Column) -> Column:
    return ~F.exists(F.map_values(track_credits), lambda credits: F.size(credits) > 0)
