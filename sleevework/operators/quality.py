"""Comparing sources with a golden table: field diffs, scorecards, coverage, credit matching.

Everything is keyed by (album, field) or (album, track), so one very large album still spreads over
all tasks; counts are combined on the map side before any shuffle by source or backend.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator, Sequence
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sleevework.functions.core import let
from sleevework.functions.dates import iso
from sleevework.functions.localized import default_text
from sleevework.functions.loose_json import as_text, is_kind, name_text
from sleevework.functions.text import casefold, normalize_value, percent

SCORED = ("match", "mismatch", "missing")  # statuses of fields the golden has
LINK_STEPS = 4
IN_ORDER_CREDITS = 10_000  # a (keys, role) of up to so many credits is matched by one task, in memory at a time
ALBUM_FIELDS = ("title", "catalog", "release_date", "classification")


# -- canonical records -----------------------------------------------------------------------------


def _track_field(disc: Column, track: Column) -> Column:
    return F.format_string("disc%d.track%d.title", disc, track)


def _record(pairs: Sequence[tuple[str, Column]], tracks: Column) -> Column:
    fields = F.array(*[F.struct(F.lit(name).alias("field"), value.alias("value")) for name, value in pairs])
    return F.concat(fields, F.coalesce(tracks, F.array().cast("array<struct<field:string,value:string>>")))


def _explode_record(df: DataFrame, record: Column) -> DataFrame:
    rows = df.select("album_id", F.posexplode(record).alias("pos", "r"))
    return rows.select("album_id", "r.field", "r.value", (F.col("pos") + 1).alias("ord"))


def canonical(albums: DataFrame) -> DataFrame:
    """Album documents to (album_id, field, value, ord); tracks by 1-based disc and track ordinal."""
    tracks = F.flatten(
        F.transform(
            "discs",
            lambda disc, d: F.transform(
                disc["tracks"],
                lambda track, t: F.struct(_track_field(d + 1, t + 1).alias("field"), default_text(track["titles"]).alias("value")),
            ),
        )
    )
    values = (default_text(F.col("titles")), F.col("catalog"), iso(F.col("release_date")), F.col("classification"))
    return _explode_record(albums, _record(list(zip(ALBUM_FIELDS, values)), tracks))


def canonical_external(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """The same shape from third-party JSON text; anything absent or of a wrong type is NULL."""

    def part(value: Column, name: str) -> Column:
        return F.try_variant_get(value, f"$.{name}", "variant")

    def items(value: Column) -> Column:
        return F.when(is_kind(value, "ARRAY"), F.try_variant_get(value, "$", "array<variant>"))

    def track_row(track: Column, d: Column, t: Column) -> Column:
        name = F.when(is_kind(track, "OBJECT"), part(track, "names")).otherwise(track)
        return F.struct(_track_field(d + 1, t + 1).alias("field"), name_text(name).alias("value"))

    def disc_rows(disc: Column, d: Column) -> Column:
        tracks = F.when(is_kind(disc, "OBJECT"), items(part(disc, "tracks")))
        rows = F.transform(tracks, lambda track, t: track_row(track, d, t))
        return F.coalesce(rows, F.array().cast("array<struct<field:string,value:string>>"))

    doc = F.col("_doc")
    values = (name_text(F.coalesce(part(doc, "name"), part(doc, "names"))), *[as_text(part(doc, f)) for f in ALBUM_FIELDS[1:]])
    record = _record(list(zip(ALBUM_FIELDS, values)), F.flatten(F.transform(items(part(doc, "discs")), disc_rows)))
    return _explode_record(payloads.select("album_id", F.try_parse_json(payload).alias("_doc")), record)


# -- field scores ----------------------------------------------------------------------------------


def _status(golden: Column, source: Column) -> Column:
    """Outcome for two normalized values."""
    return (
        F.when(golden.isNull() & source.isNull(), "absent")
        .when(golden.isNull(), "extra")
        .when(source.isNull(), "missing")
        .when(golden == source, "match")
        .otherwise("mismatch")
    )


def score(sources: DataFrame, golden: DataFrame, everywhere: bool = False) -> DataFrame:
    """(source, album_id, field, golden, value, status, golden_ord, ord).

    A source is scored on the albums it has; on those, every golden field counts. Normalized values
    are compared, raw ones reported. With ``everywhere`` the golden fields of albums that no source has are
    there too, once, without source and status, and all rows stay dealt by (album, field) for what follows.
    """
    if everywhere:
        both = _met_where_dealt(sources, golden)
    else:
        present = sources.select("source", "album_id").distinct()
        expected = golden.select("album_id", "field", F.col("value").alias("golden"), F.col("ord").alias("golden_ord")).join(present, "album_id")
        both = expected.join(sources, ["source", "album_id", "field"], "full_outer")
    # normalized after the rows have met, once per row, so that the shuffle carries the raw values only
    both = both.withColumns({"_golden": normalize_value(F.col("golden")), "_value": normalize_value(F.col("value"))})
    status = _status(F.col("_golden"), F.col("_value"))
    if everywhere:
        status = F.when(~F.col("_nowhere"), status)
    return both.select("source", "album_id", "field", "golden", "value", status.alias("status"), "golden_ord", "ord")


def _met_where_dealt(sources: DataFrame, golden: DataFrame) -> DataFrame:
    """(source, album_id, field, golden, value, golden_ord, ord, _nowhere) of all golden and source rows.

    Both are dealt by (album, field) once. A source row takes the golden rows of its field, a golden row the
    sources of its album that lack the field; rows with a null in their key meet no others.
    """
    present = sources.select("source", "album_id").distinct().groupBy("album_id").agg(F.collect_list(F.struct("source")).alias("present"))
    expected = golden.select("album_id", "field", F.col("value").alias("golden"), F.col("ord").alias("golden_ord")).join(present, "album_id", "left")
    kinds = {f.name: f.dataType for f in (*sources.schema.fields, *expected.schema.fields)}
    empty = lambda *names: [F.lit(None).cast(kinds[n]).alias(n) for n in names]
    mine = expected.select("album_id", "field", F.lit(True).alias("_golden_row"), "golden", "golden_ord", "present", *empty("source", "value", "ord"))
    theirs = sources.select("album_id", "field", F.lit(False).alias("_golden_row"), *empty("golden", "golden_ord", "present"), "source", "value", "ord")
    alone = F.col("album_id").isNull() | F.col("field").isNull() | (~F.col("_golden_row") & F.col("source").isNull())
    parts = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = mine.unionByName(theirs).repartition(parts, "album_id", "field").withColumn("_alone", F.when(alone, F.monotonically_increasing_id()))
    key = Window.partitionBy("album_id", "field", "_alone")
    known = F.collect_list(F.when(F.col("_golden_row"), F.struct("golden", "golden_ord"))).over(key)
    found = F.collect_set("source").over(key)
    rows = rows.select("*", known.alias("_known"), found.alias("_found"))
    cell = lambda golden, golden_ord, source: F.struct(golden.alias("golden"), golden_ord.alias("golden_ord"), source.alias("source"))
    nothing = cell(F.lit(None).cast(kinds["golden"]), F.lit(None).cast(kinds["golden_ord"]), F.col("source"))
    own = F.when(F.col("_alone").isNotNull() | (F.size("_known") == 0), F.array(nothing)).otherwise(F.transform("_known", lambda k: cell(k["golden"], k["golden_ord"], F.col("source"))))
    lacking = F.filter("present", lambda p: p["source"].isNull() | ~F.array_contains("_found", p["source"]))
    unmet = F.transform(lacking, lambda p: cell(F.col("golden"), F.col("golden_ord"), p["source"]))
    nowhere = F.array(cell(F.col("golden"), F.col("golden_ord"), F.lit(None).cast(kinds["source"])))
    cells = F.when(~F.col("_golden_row"), own).when(F.col("present").isNull(), nowhere).otherwise(unmet)
    nowhere_row = F.col("_golden_row") & F.col("present").isNull()
    return rows.select("album_id", "field", "value", "ord", nowhere_row.alias("_nowhere"), F.explode(cells).alias("c")).select("album_id", "field", "value", "ord", "_nowhere", "c.*")


def _tally() -> list[Column]:
    return [
        F.count_if(F.col("status") == "match").alias("matches"),
        F.count_if(F.col("status").isin(*SCORED)).alias("scored"),
    ]


def agreement(scores: DataFrame) -> DataFrame:
    return scores.groupBy("source", "album_id").agg(*_tally())


def scorecard(scores: DataFrame) -> DataFrame:
    """One row per source: matches, scored fields and their whole percentage."""
    totals = scores.groupBy("source").agg(*_tally())
    return totals.withColumn("agreement", percent(F.col("matches"), F.col("scored")))


def nway_diff(scores: DataFrame, names: Sequence[str], golden: DataFrame | None = None) -> DataFrame:
    """One row per album and field with the golden value and one value/status pair per source.

    With ``golden`` (album_id, field, value, ord) its fields drive the diff: albums that no source has are there too,
    with empty cells. ``rank_place`` and ``rank_ord`` order golden fields first (place 0), then extras as the
    sources bring them up.
    """
    rows = scores.select("source", "album_id", "field", "golden", "value", "status", "golden_ord", "ord")
    if golden is not None:
        kinds = {f.name: f.dataType for f in rows.schema.fields}
        given = {"golden": F.col("value"), "golden_ord": F.col("ord")}
        column = lambda c: given.get(c, F.lit(None)) if c not in ("album_id", "field") else F.col(c)
        # rows of no source, added ahead of the one grouping that makes the diff
        rows = rows.unionByName(golden.select(*[column(c).cast(kinds[c]).alias(c) for c in rows.columns]))
    cells = []
    for place, name in enumerate(names):
        mine = F.col("source") == name
        cells += [F.max(F.when(mine, F.col("value"))).alias(f"{name}_value"), F.max(F.when(mine, F.col("status"))).alias(f"{name}_status")]
    place = F.array_position(F.array(*map(F.lit, names)), F.col("source"))
    first_extra = F.min(F.struct(place.cast("bigint").alias("place"), F.col("ord").cast("bigint").alias("ord")))
    golden_ord = F.min("golden_ord").cast("bigint")
    rank = F.struct(F.when(golden_ord.isNull(), first_extra["place"]).otherwise(0).alias("place"), F.coalesce(golden_ord, first_extra["ord"]).alias("ord"))
    diff = rows.groupBy("album_id", "field").agg(F.max("golden").alias("golden"), *cells, rank.alias("rank"))
    return diff.select("*", F.col("rank.place").alias("rank_place"), F.col("rank.ord").alias("rank_ord")).drop("rank")


def distinct_in_first_seen_order(rows: DataFrame, name: str, order: str) -> DataFrame:
    return rows.groupBy(name).agg(F.min(order).alias("first_seen")).orderBy("first_seen", name)


# -- enrichment coverage and matching --------------------------------------------------------------


def coverage(albums: DataFrame, tracks: DataFrame, credits: DataFrame | None) -> DataFrame:
    """(album_id, available, tracks_with_credits, total_tracks, total_credits).

    Credits are counted per (album, track) before they meet the tracks; credits of tracks the album
    does not have are left out. Without a backend, coverage is not available.
    """
    if credits is None:
        zero = F.lit(0).cast("bigint")
        return albums.select("album_id", F.lit(False).alias("available"), *[zero.alias(c) for c in ("tracks_with_credits", "total_tracks", "total_credits")])
    known = tracks.where("number is not null").select("album_id", F.col("number").cast("bigint").alias("track")).distinct()
    counted = credits.groupBy("album_id", "track").agg(F.count(F.lit(1)).alias("n"))
    per_album = known.join(counted, ["album_id", "track"], "left").groupBy("album_id").agg(
        F.count("n").alias("tracks_with_credits"), F.count(F.lit(1)).alias("total_tracks"), F.sum("n").alias("total_credits")
    )
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("tracks_with_credits", "total_tracks", "total_credits")]
    return albums.select("album_id").join(per_album, "album_id", "left").select("album_id", F.lit(True).alias("available"), *counts)


def _match_key(names: Column) -> Column:
    """Distinct casefolded non-empty names, sorted: the part of a credit that matching looks at."""
    folded = F.filter(F.transform(F.coalesce(names, F.array().cast("array<string>")), casefold), lambda n: n != "")
    return F.sort_array(F.array_distinct(folded))  # no entry is null here


def _run_starts(batch: pa.RecordBatch, columns: Sequence[str]) -> pa.Array:
    """The rows at which one of the columns differs from the row before, with the first one."""
    differs = np.zeros(batch.num_rows, dtype=bool)
    differs[:1] = True
    for column in map(batch.column, columns):
        here, before = column.slice(1), column.slice(0, max(0, batch.num_rows - 1))
        unequal = pc.fill_null(pc.not_equal(here, before), False).to_numpy(zero_copy_only=False)
        differs[1:] |= unequal | (here.is_null().to_numpy(zero_copy_only=False) != before.is_null().to_numpy(zero_copy_only=False))
    return pa.array(np.flatnonzero(differs))


def _match_in_order(keys: Sequence[str]):
    """Greedy matching over Arrow batches sorted by (keys, role, part, is_golden, ord, key).

    Keeps one queue of produced credits per name of the current part, in order; golden credits only
    pass by. Nameless credits queue under the empty name. Linear in the rows, in memory the produced credits of one
    part. Gives (keys..., matched, produced, golden) per part.
    """
    group = [*keys, "role", "part"]

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, queues, used, matched, wanted = None, {}, [], 0, 0
        for batch in batches:
            done = []
            starts = _run_starts(batch, group)
            owns = zip(*[batch.column(c).take(starts).to_pylist() for c in group])
            ends = [*starts.to_pylist()[1:], batch.num_rows]
            is_golden = batch.column("is_golden").to_pylist()
            keys_column = batch.column("key")
            names, bounds = keys_column.values.to_pylist(), keys_column.offsets.to_pylist()
            row = 0
            for own, end in zip(owns, ends):
                if own != current:
                    if current is not None:
                        done.append((*current, matched, len(used), wanted))
                    current, queues, used, matched, wanted = own, {}, [], 0, 0
                if not used and is_golden[row]:  # golden credits alone
                    wanted += end - row
                    row = end
                for row in range(row, end):
                    mine = names[bounds[row]:bounds[row + 1]] or ("",)
                    if not is_golden[row]:
                        for name in mine:
                            queues.setdefault(name, deque()).append(len(used))
                        used.append(False)
                        continue
                    wanted += 1
                    first = None
                    for queue in (queues[n] for n in mine if n in queues):
                        while queue and used[queue[0]]:
                            queue.popleft()
                        if queue and (first is None or queue[0] < first):
                            first = queue[0]
                    if first is not None:
                        used[first] = True
                        matched += 1
                row = end
            yield result(batch, done)
        if current is not None:
            yield result(batch, [(*current, matched, len(used), wanted)])

    def result(batch: pa.RecordBatch, parts: list) -> pa.RecordBatch:
        arrays = [pa.array([p[i] for p in parts], type=batch.schema.field(k).type) for i, k in enumerate(keys)]
        counts = [pa.array([p[i] for p in parts], type=pa.int64()) for i in (-3, -2, -1)]
        return pa.RecordBatch.from_arrays([*arrays, *counts], names=[*keys, "matched", "produced", "golden"])

    return match


def connected_parts(keys: DataFrame, group: Sequence[str], steps: int = LINK_STEPS) -> DataFrame:
    """(group..., key, part) for distinct (group..., key: array of names): keys that a chain of shared names links have one part.

    Every name starts as its own part; in each step a key takes the least part of its names and a name the least of
    its keys, so a part spreads over ``steps`` shared names in each direction. A group in which two names of a
    key still differ after that has chains that are longer; it stays together as the part NULL. So parts never
    cut a chain, and all is one lazy plan without a loop on the driver.
    """
    group = list(group)
    linked = keys.select(*group, "key", F.explode("key").alias("name")).withColumn("part", F.col("name"))
    for _ in range(steps):
        for side in ("key", "name"):
            linked = linked.withColumn("part", F.min("part").over(Window.partitionBy(*group, side)))
    ends = linked.groupBy(*group, "key").agg(F.min("part").alias("part"), F.max("part").alias("other"))
    open_groups = ends.where("part <> other").select(*group).distinct().withColumn("open", F.lit(True))
    return ends.join(open_groups, group, "left").select(*group, "key", F.when(F.col("open").isNull(), F.col("part")).alias("part"))


def entangled_in_order(produced_and_golden: DataFrame, entangled_keys: DataFrame, group: Sequence[str]) -> DataFrame:
    """The credits that have to be matched in order, dealt by group and part, in order within each."""
    parts = connected_parts(entangled_keys, group)
    rows = produced_and_golden.join(parts, [*group, "key"])  # keys are unique on the right
    return rows.repartition(*group, "part").sortWithinPartitions(*group, "part", "is_golden", "ord", "key").select(*group, "part", "is_golden", "key")


def match_credits(produced: DataFrame, golden: DataFrame, keys: Sequence[str] = ("album_id", "track")) -> DataFrame:
    """(keys..., matched, produced, golden) for credits (keys..., ord, role, names array).

    ``ord`` is a number, a text or an array of numbers. Both inputs are read several times: hand in tables, or
    results that were written. Never hand in two plans that share unwritten steps: the reuse of exchanges was seen
    to double the rows of such a self-join (Spark 4.1.2).

    Golden credits in order each take the first free produced credit of the same role that shares a
    name (or is nameless like itself). A name that occurs only in one-name credits makes its credits
    interchangeable, so the number of matches is the smaller of the two counts: plain counting, combined
    on the map side. Credits entangled through a credit with several names are matched in order. Credits that no
    chain of shared names connects never compete, so each connected part is a stream of its own.

    All this pays for large groups only. A (keys, role) of at most ``IN_ORDER_CREDITS`` credits is matched in order as
    one stream, after one shuffle of the credits and without the shuffles that look for shared names and parts.
    """
    keys = list(keys)
    group = [*keys, "role"]
    columns = [*group, "ord", "names"]
    credits = produced.select(*columns, F.lit(False).alias("is_golden")).unionByName(golden.select(*columns, F.lit(True).alias("is_golden")))
    types = {f.name: f.dataType.simpleString() for f in credits.schema.fields}
    schema = ", ".join(f"{k} {types[k]}" for k in keys) + ", matched bigint, produced bigint, golden bigint"

    # large groups are at most one for each IN_ORDER_CREDITS credits, so their keys are few at any size
    large = credits.groupBy(*group).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > IN_ORDER_CREDITS).select(*group)
    is_keyed = reduce(and_, [F.col(c).isNotNull() for c in group])  # no join finds a group with a null key: it is counted
    shape = [*group, "ord", _match_key(F.col("names")).alias("key"), "is_golden"]
    small = credits.where(is_keyed).join(F.broadcast(large), group, "left_anti").select(*shape)
    both = credits.join(F.broadcast(large), group, "left_semi").unionByName(credits.where(~is_keyed)).select(*shape)

    # a small group is one stream: whatever its names, the credits of one (keys, role) never meet those of another
    streams = small.withColumn("part", F.lit(None).cast("string")).repartition(*group).sortWithinPartitions(*group, "is_golden", "ord", "key")
    whole = streams.select(*group, "part", "is_golden", "key").mapInArrow(_match_in_order(keys), schema)

    # one row per (group, key) from here on, however many credits repeat it
    counted = both.groupBy(*group, "key").agg(F.count_if("is_golden").alias("g"), F.count_if(~F.col("is_golden")).alias("p"))
    shared = counted.where(F.size("key") > 1).select(*group, F.explode("key").alias("name")).select(*group, F.array("name").alias("key"))
    marked = counted.join(shared.distinct().withColumn("shared", F.lit(True)), [*group, "key"], "left")
    is_entangled = F.col("shared").isNotNull() | (F.size("key") > 1)
    zero = F.lit(0).cast("bigint")
    simple_matches = F.when(is_entangled, zero).otherwise(F.least("g", "p"))
    simple = marked.select(*keys, simple_matches.alias("matched"), F.col("p").alias("produced"), F.col("g").alias("golden"))

    ordered = entangled_in_order(both, marked.where(is_entangled).select(*group, "key"), group)
    in_order = ordered.mapInArrow(_match_in_order(keys), schema).select(*keys, "matched", zero.alias("produced"), zero.alias("golden"))

    parts = whole.unionByName(simple).unionByName(in_order)
    return parts.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("matched", "produced", "golden")])


def with_prf(scores: DataFrame) -> DataFrame:
    """Precision (1 if nothing was produced), recall (1 if nothing was to be found) and F1."""
    m, p, g = (F.col(c).cast("double") for c in ("matched", "produced", "golden"))
    precision = F.when(p == 0, F.lit(1.0)).otherwise(m / F.nullif(p, F.lit(0.0)))
    recall = F.when(g == 0, F.lit(1.0)).otherwise(m / F.nullif(g, F.lit(0.0)))
    f1 = let(precision + recall, lambda s: F.when(s == 0, F.lit(0.0)).otherwise(2 * precision * recall / F.nullif(s, F.lit(0.0))))
    return scores.withColumns({"precision": precision, "recall": recall, "f1": f1})


def score_backends(produced: DataFrame, golden: DataFrame, backends: Sequence[str], albums: DataFrame | None = None) -> DataFrame:
    """(backend, album_id, matched, produced, golden); albums nobody credits count with zeros."""
    labels = F.explode(F.array(*map(F.lit, backends))).alias("backend")
    per_track = match_credits(produced, golden.select("*", labels), ["backend", "album_id", "track"])
    rows = per_track.select("backend", "album_id", "matched", "produced", "golden")
    if albums is not None:
        zero = F.lit(0).cast("bigint")
        rows = rows.unionByName(albums.select(labels, "album_id", *[zero.alias(c) for c in ("matched", "produced", "golden")]))
    return rows.groupBy("backend", "album_id").agg(*[F.sum(c).alias(c) for c in ("matched", "produced", "golden")])


def rank_backends(scores: DataFrame) -> DataFrame:
    """Per album and, with NULL album_id, per backend over all albums: counts summed, then ratios."""
    sets = [[F.col("backend"), F.col("album_id")], [F.col("backend")]]
    summed = scores.groupingSets(sets, "backend", "album_id").agg(
        *[F.sum(c).alias(c) for c in ("matched", "produced", "golden")], F.grouping_id().alias("over_all")
    )
    return with_prf(summed).withColumn("over_all", F.col("over_all") > 0)

