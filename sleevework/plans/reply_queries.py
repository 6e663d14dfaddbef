"""Queries over prompts, requests and replies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sleevework.functions.core import computed
from sleevework.operators import replies as R
from sleevework.plans.quality_queries import album_documents
from sleevework.plans.registry import CHECK_VIEWS, by_key, notes_view, query, view

CHECK_VIEWS["x_tracklists"] = """
select a.album_id, string_agg(concat(split_part(split_part(g.field, 'track', 2), '.', 1), '. ', g.value), chr(10) order by g.ord) as tracklist
from v_albums a join v_golden g on g.album_id = a.album_id and g.field like 'disc%' group by a.album_id
"""


@query("n12_prompt_table", "select album_id, tracklist from x_tracklists")
def prompt_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.prompt_table(album_documents(spark, sf_dir))


_TEMPLATES = """case album_id % 4 when 0 then 'T:{tracklist} N:{notes}' when 1 then '{notes} and {{literal}}' when 2 then 'no {mood}' else 'open { brace' end"""
CHECK_VIEWS["x_rendered"] = """
select t.album_id, case t.album_id % 4 when 0 then 'T:' || tracklist || ' N:' || coalesce(notes, '') when 1 then coalesce(notes, '') || ' and {literal}' end as text,
  case when t.album_id % 4 > 1 then 'invalid template' end as error
from x_tracklists t join v_notes n on n.album_id = t.album_id
"""


def _prompt_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    prompts = R.prompt_table(album_documents(spark, sf_dir))
    return prompts.join(notes_view(spark, sf_dir), "album_id")


@query("n13_render_template", "select album_id, text, error from x_rendered")
def render_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    rendered = R.render_template(F.expr(_TEMPLATES), F.col("tracklist"), F.col("notes"))
    return _prompt_inputs(spark, sf_dir).select("album_id", rendered.alias("r")).select("album_id", "r.text", "r.error")


def _prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    user = R.render_template(F.lit(R.DEFAULT_TEMPLATE), F.col("tracklist"), F.col("notes"))["text"]
    return _prompt_inputs(spark, sf_dir).select("album_id", R.messages(F.lit("Extract credits."), user).alias("messages"))


_BODY = (
    "model string, temperature bigint, messages array<struct<content:string>>, response_format struct<type:string,json_schema:struct<schema:struct<type:string>>>, "
    "tools array<struct<function:struct<parameters:struct<type:string>>>>, tool_choice struct<function:struct<name:string>>"
)


@query("n14_request_rows", """
select m.mode, t.album_id, 'gpt-4o-mini' as model, cast(0 as bigint) as temperature, 'Extract credits.' as system, 'Tracklist:' || chr(10) || tracklist || chr(10) || chr(10) || 'Notes:' || chr(10) || coalesce(notes, '') as user_text,
  case m.mode when 'tool' then null else m.mode end as format, case m.mode when 'tool' then 'emit_enrichment' end as tool, case when m.mode <> 'json_object' then 'object' end as schema_type
from x_tracklists t join v_notes n on n.album_id = t.album_id cross join (values ('json_object'), ('json_schema'), ('tool')) m(mode)
""")
def request_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = R.request_rows(_prompts(spark, sf_dir), R.OUTPUT_MODES)
    # each body is read back once
    read = computed(rows, "body", F.from_json("body", _BODY))
    return read.select(
        "mode", "album_id", "body.model", "body.temperature",
        F.get("body.messages", F.lit(0))["content"].alias("system"), F.get("body.messages", F.lit(1))["content"].alias("user_text"),
        F.col("body.response_format.type").alias("format"), F.col("body.tool_choice.function.name").alias("tool"),
        F.coalesce(F.col("body.response_format.json_schema.schema.type"), F.get("body.tools", F.lit(0))["function"]["parameters"]["type"]).alias("schema_type"),
    )


CHECK_VIEWS["x_validated"] = """
select album_id, attempt, reply, shape, case when shape = 0 then 'not JSON' when shape = 1 then 'track key is no number' when shape in (3, 4, 7) then 'wrong shape' end as reason from v_replies
"""


@query("n15_validate_replies", "select album_id, cast(attempt as bigint) as attempt, reason from x_validated")
def validate_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = R.validate_replies(by_key(view(spark, sf_dir, "v_replies"), "album_id"))
    return rows.select("album_id", F.col("attempt").cast("bigint").alias("attempt"), "reason")


@query("n15_reply_credits", """
select album_id, cast(attempt as bigint) as attempt, cast(c.track as bigint) as track, cast(c.ord as bigint) as ord, c.role, c.role_raw,
  case when c.n is null then '' else concat(c.n, album_id, case when shape = 5 then '|' else '' end) end as names
from v_replies join (values (5, 2, 0, 'composer', 'Music', null), (5, 2, 1, 'vocalist', 'Vocals', 'B'), (8, 1, 0, 'composer', 'Composed by', 'A')) c(s, track, ord, role, role_raw, n) on c.s = shape
""")
def reply_credits(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = R.validate_replies(by_key(view(spark, sf_dir, "v_replies"), "album_id")).where("reason is null")
    names = F.array_join(F.transform("artists", lambda a: F.coalesce(F.get(F.map_values(a["names"]), F.lit(0)), F.lit(""))), "|")
    rows = R.reply_credits(valid)
    return rows.select("album_id", *[F.col(c).cast("bigint").alias(c) for c in ("attempt",)], "track", F.col("ord").cast("bigint").alias("ord"), "role", "role_raw", names.alias("names"))


@query("n16_settle_replies", """
select album_id, case when min(attempt) filter (where reason is null) is not null then 'accepted' when max(attempt) <= 1 then 'requeue' else 'exhausted' end as state,
  cast(max(attempt) as bigint) as attempts, cast(min(attempt) filter (where reason is null) as bigint) as accepted_attempt
from x_validated where not (attempt = 2 and album_id % 2 = 0) group by album_id
""")
def settle_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _settled(spark, sf_dir).select("album_id", "state", *[F.col(c).cast("bigint").alias(c) for c in ("attempts", "accepted_attempt")])


def _settled(spark: SparkSession, sf_dir: str) -> DataFrame:
    # every other album has made one attempt only so far
    replies = by_key(view(spark, sf_dir, "v_replies"), "album_id").where("not (attempt = 2 and album_id % 2 = 0)")
    return R.settle_replies(R.validate_replies(replies), max_retries=1)


@query("n16_requeue", """
select album_id, cast(3 as bigint) as n_messages, concat('Your previous response was invalid (', reason, '). Respond with ONLY JSON matching the schema.') as last_message
from x_validated where attempt = 1 and album_id % 2 = 0 and reason is not null
""")
def requeue(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = R.requeue(_settled(spark, sf_dir), _prompts(spark, sf_dir))
    return rows.select("album_id", F.size("messages").cast("bigint").alias("n_messages"), F.element_at("messages", -1)["content"].alias("last_message"))
