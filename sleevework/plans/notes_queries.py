"""Queries over the notes operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sleevework.functions.tracks import inline_groups
from sleevework.operators import notes as N
from sleevework.plans import duck
from sleevework.plans.registry import CHECK_VIEWS, notes_view, query, view

# The same work written as joins and windows, for checking only.
CHECK_VIEWS["x_lines"] = """
select album_id, u.pos - 1 as pos, u.line as line
from (select album_id, string_split(notes, chr(10)) as parts from v_notes where notes is not null) n,
  unnest(n.parts) with ordinality as u(line, pos)
where not (u.line = '' and u.pos = len(n.parts))
"""
CHECK_VIEWS["x_headers"] = f"""
select album_id, pos, line,
  case when regexp_matches(line, '^\\s*\\d+\\.\\s') then [cast(regexp_extract(line, '^\\s*(\\d+)\\.\\s', 1) as bigint)]
    when trim(line) <> '' and len({duck.track_set("regexp_extract(line, '(?i)^\\s*(?:tracks?\\s+)?(M?-?\\d[\\dM~,\\s.-]*?)\\s*(?:-\\s+\\S.*)?$', 1)")}) > 0
    then {duck.track_set("regexp_extract(line, '(?i)^\\s*(?:tracks?\\s+)?(M?-?\\d[\\dM~,\\s.-]*?)\\s*(?:-\\s+\\S.*)?$', 1)")} end as header
from x_lines
"""
CHECK_VIEWS["x_phrases"] = """
select *, regexp_matches(line, '(?i)^\\s*[^:]{1,40}?\\s+by\\s+.+$') as is_by,
  regexp_extract(line, '(?i)^\\s*([^:]{1,40}?)\\s+by\\s+(.+)$', 1) as by_phrase, regexp_extract(line, '(?i)^\\s*([^:]{1,40}?)\\s+by\\s+(.+)$', 2) as by_value,
  regexp_extract(line, '(?i)^\\s*([^:]{1,40}?):\\s*(.+)$', 1) as co_phrase, regexp_extract(line, '(?i)^\\s*([^:]{1,40}?):\\s*(.+)$', 2) as co_value
from x_headers
"""
CHECK_VIEWS["x_roles"] = f"""
select album_id, pos, line, header, case when ok then phrase end as phrase, case when ok then value end as value,
  case when trim(line) = '' then 'blank' when header is not null then 'header' when ok then 'role' else 'prose' end as kind
from (
  select *, header is null and phrase <> '' and value <> '' and {duck.credit_word('phrase')} as ok
  from (select *, case when is_by then by_phrase else co_phrase end as phrase, case when is_by then by_value else co_value end as value from x_phrases) a
) b
"""
CHECK_VIEWS["x_context"] = """
select *, first_value(header) over (partition by album_id, blk order by pos) as context
from (
  select *, sum(case when kind <> 'role' then 1 else 0 end) over (partition by album_id order by pos rows unbounded preceding) as blk
  from x_roles
) t
"""
CHECK_VIEWS["x_groups"] = f"""
select album_id, pos, phrase, value, context,
  list_filter(list_transform(range(1, len(ns) + 1), lambda i: {{'names': ns[i], 'tracks': {duck.track_set('rs[i]')}}}), lambda g: len(g.tracks) > 0) as found
from (
  select *, regexp_extract_all(value, '([^()]*?)\\(([^()]+)\\)', 1) as ns, regexp_extract_all(value, '([^()]*?)\\(([^()]+)\\)', 2) as rs
  from x_context where kind = 'role'
) t
"""
CHECK_VIEWS["x_attributed"] = f"""
select album_id, pos, phrase, u.grp, {duck.names('u.g.names')} as names, u.g.tracks as tracks, len(found) > 0 as inline
from (select *, case when len(found) > 0 then found when context is not null then [{{'names': value, 'tracks': context}}] else [] end as gs from x_groups) t,
  unnest(t.gs) with ordinality as u(g, grp)
"""
CHECK_VIEWS["x_emitted"] = """
select album_id, u.track, pos, phrase, names, inline, rank() over (partition by album_id, pos order by grp) as g
from (select * from x_attributed where len(names) > 0) t, unnest(t.tracks) as u(track)
"""
CHECK_VIEWS["x_emitted_grp"] = """
select album_id, track, pos, dense_rank() over (partition by album_id, pos order by g) - 1 as grp, phrase, names, inline from x_emitted
"""
CHECK_VIEWS["x_credits"] = f"""
select album_id, track, pos, grp, {duck.role_case('phrase')} as role, trim(phrase) as role_raw, names, inline
from x_emitted_grp e where exists (select 1 from v_tracks t where t.album_id = e.album_id and t.number = e.track)
"""


def _notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return notes_view(spark, sf_dir)


def _tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "v_tracks").select("album_id", "number")


def _big(*names: str) -> list[Column]:
    return [F.col(n).cast("bigint").alias(n) for n in names]


def _sorted_text(tracks: Column) -> Column:
    return F.array_join(F.array_sort(tracks), ",")


@query("n1_explode_lines", "select album_id, pos, line from x_lines")
def explode_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.explode_lines(_notes(spark, sf_dir)).select("album_id", *_big("pos"), "line")


@query("n1_document_lines", """
select doc_id, u.pos - 1 as pos, md5(u.line) as line_md5
from (select doc_id, string_split_regex(text, '\\r\\n|[\\n\\r\\x0b\\x0c\\x1c\\x1d\\x1e\\x{85}\\x{2028}\\x{2029}]') as parts from documents) d,
  unnest(d.parts) with ordinality as u(line, pos)
where not (u.line = '' and u.pos = len(d.parts))
""")
def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = N.explode_lines(view(spark, sf_dir, "v_documents"), "doc_id", "text")
    return rows.select("doc_id", *_big("pos"), F.md5("line").alias("line_md5"))


@query("n2_header_tracks", f"select album_id, pos, {duck.numbers('header')} as tracks from x_roles where kind = 'header'")
def header_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = N.explode_lines(_notes(spark, sf_dir)).select("album_id", *_big("pos"), N.header_tracks(F.col("line")).alias("t"))
    return rows.where("t is not null").select("album_id", "pos", _sorted_text(F.col("t")).alias("tracks"))


@query("n3_role_line", "select album_id, pos, phrase, value from x_roles where kind = 'role'")
def role_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.col("line")
    rows = N.explode_lines(_notes(spark, sf_dir)).where(N.header_tracks(line).isNull())
    return rows.select("album_id", *_big("pos"), N.role_line(line).alias("r")).where("r is not null").select("album_id", "pos", "r.phrase", "r.value")


@query("n4_block_context", f"select album_id, pos, kind, {duck.numbers('context')} as tracks from x_context")
def block_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = N.block_context(_notes(spark, sf_dir))
    return rows.select("album_id", *_big("pos"), "kind", _sorted_text(F.col("context")).alias("tracks"))


@query("n5_inline_groups", f"""
select album_id, pos, u.grp - 1 as grp, u.g.names as names, {duck.numbers('u.g.tracks')} as tracks
from x_groups t, unnest(t.found) with ordinality as u(g, grp)
""")
def inline_group_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = N.block_context(_notes(spark, sf_dir)).where("kind = 'role'")
    groups = rows.select("album_id", *_big("pos"), F.posexplode(inline_groups(F.col("value"))).alias("grp", "g"))
    return groups.select("album_id", "pos", *_big("grp"), "g.names", _sorted_text(F.col("g.tracks")).alias("tracks"))


@query("n6_emit", "select album_id, track, pos, grp, phrase, array_to_string(names, '|') as names from x_emitted_grp")
def emit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = N.emit(_notes(spark, sf_dir))
    return rows.select("album_id", "track", *_big("pos", "grp"), "phrase", F.array_join("names", "|").alias("names"))


@query("n7_valid_tracks_only", "select album_id, track, pos, grp from x_credits")
def valid_tracks_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = N.valid_tracks_only(N.emit(_notes(spark, sf_dir)), _tracks(spark, sf_dir))
    return rows.select("album_id", "track", *_big("pos", "grp"))


def flat_credits(credits: DataFrame) -> DataFrame:
    name = lambda a: F.get(F.map_values(a["names"]), F.lit(0))
    language = lambda a: F.get(F.map_keys(a["names"]), F.lit(0))
    return credits.select(
        "album_id", "track", *_big("pos", "grp"), "role", "role_raw",
        F.array_join(F.transform("artists", name), "|").alias("names"),
        F.array_join(F.transform("artists", language), "|").alias("languages"),
    )


@query("n8_make_credit", f"""
select album_id, track, pos, grp, role, role_raw, array_to_string(names, '|') as names,
  array_to_string(list_transform(names, lambda n: case when {duck.cjk('n')} then 'Japanese' else 'English' end), '|') as languages
from x_credits
""")
def make_credit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_credits(N.mine_credits(_notes(spark, sf_dir), _tracks(spark, sf_dir)))


# album rows that carry their own track numbers: 1 .. album_id % 6, as in a nested album document


def _own_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbers = F.when(F.col("album_id") % 6 > 0, F.sequence(F.lit(1).cast("bigint"), F.col("album_id") % 6)).otherwise(F.array().cast("array<bigint>"))
    return _notes(spark, sf_dir).withColumn("track_numbers", numbers)


CHECK_VIEWS["x_own_credits"] = f"""
select album_id, track, row_number() over (partition by album_id, track order by pos, grp) - 1 as ord, {duck.role_case('phrase')} as role, trim(phrase) as role_raw, names
from x_emitted_grp where track between 1 and album_id % 6
"""


@query("n9_assemble_enrichment", "select album_id, track, ord, role, role_raw, array_to_string(names, '|') as names from x_own_credits")
def assemble_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = N.assemble_enrichment(_own_tracks(spark, sf_dir))
    tracks = docs.select("album_id", F.explode("track_credits").alias("track", "credits"))
    rows = tracks.select("album_id", "track", F.posexplode("credits").alias("ord", "c"))
    names = F.transform("c.artists", lambda a: F.get(F.map_values(a["names"]), F.lit(0)))
    return rows.select("album_id", "track", *_big("ord"), "c.role", "c.role_raw", F.array_join(names, "|").alias("names"))


@query("n10_is_empty", "select o_orderkey as album_id, o_orderkey not in (select album_id from x_own_credits) as empty from orders")
def is_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = N.assemble_enrichment(_own_tracks(spark, sf_dir))
    return docs.select("album_id", F.coalesce(N.is_empty(F.col("track_credits")), F.lit(True)).alias("empty"))


CHECK_VIEWS["x_backend_credits"] = """
select backend, album_id, track, pos, grp, role, names
from x_credits cross join (values ('rules'), ('inline_only')) b(backend) where backend = 'rules' or inline
"""


@query("n11_run_backends", "select backend, album_id, track, pos, grp, role, array_to_string(names, '|') as names from x_backend_credits")
def run_backends(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = N.run_backends(_notes(spark, sf_dir), _tracks(spark, sf_dir))
    return rows.select("backend", "album_id", "track", *_big("pos", "grp"), "role", F.array_join("names", "|").alias("names"))


@query("n11_enrich", """
select o.album_id, count(c.album_id) as n_credits, cast(0 as bigint) as n_without_backend
from v_notes o left join x_credits c on c.album_id = o.album_id group by o.album_id
""")
def enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    notes = _notes(spark, sf_dir)
    albums = notes.select("album_id")
    counted = N.enrich(albums, N.mine_credits(notes, _tracks(spark, sf_dir)))
    without = N.enrich(albums).withColumnRenamed("n_credits", "n_without_backend")
    return counted.join(without, "album_id")


@query("flagship_track_credits", "select album_id, track, role, role_raw, n.name as artist from x_credits c, unnest(c.names) as n(name)")
def track_credits(spark: SparkSession, sf_dir: str) -> DataFrame:
    credits = N.mine_credits(_notes(spark, sf_dir), _tracks(spark, sf_dir))
    return credits.select("album_id", "track", "role", "role_raw", F.explode("names").alias("artist"))


