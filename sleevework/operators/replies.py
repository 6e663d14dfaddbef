"""Prompt and request tables for a language-model backend, and validation of its replies.

Nothing here calls an endpoint: requests go out as rows (one JSON body per album, ready for batch
inference) and replies come back as rows.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sleevework.functions.core import computed, deduplicate, let
from sleevework.functions.localized import to_text
from sleevework.functions.loose_json import is_kind
from sleevework.functions.roles import normalize_role

# Output modes, the tool, the default model and template, and the texts sent with them.
OUTPUT_MODES = ("json_object", "json_schema", "tool")
TOOL_NAME = "emit_enrichment"
TOOL_DESCRIPTION = "Return per-track credits."
CORRECTION = ("Your previous response was invalid (", "). Respond with ONLY JSON matching the schema.")
DEFAULT_MODEL = "gpt-4o-mini"
DEFAULT_TEMPLATE = "Tracklist:\n{tracklist}\n\nNotes:\n{notes}"
DEFAULT_SYSTEM_PROMPT = (
    "Read the notes of a music album and list who did what on which track. Answer with JSON only, shaped as "
    '{"track_credits": {"<track number>": [{"role_raw": "<role as written>", "artists": [{"names": {"English": "<name>"}}]}]}}. '
    "Track numbers are those of the tracklist. Leave out credits that are not tied to a track; with none left, "
    'answer {"track_credits": {}}.'
)
_NAMES = {"type": "object", "additionalProperties": {"type": "string"}}
_ARTIST = {"type": "object", "properties": {"names": _NAMES}, "required": ["names"]}
_CREDIT = {"type": "object", "properties": {"role_raw": {"type": "string"}, "artists": {"type": "array", "items": _ARTIST}}, "required": ["role_raw"]}
REPLY_SCHEMA = {"type": "object", "properties": {"track_credits": {"type": "object", "additionalProperties": {"type": "array", "items": _CREDIT}}}}


def tracklist(discs: Column) -> Column:
    """``n. title`` lines of the numbered tracks in disc and track order."""
    tracks = F.filter(F.flatten(F.transform(discs, lambda d: d["tracks"])), lambda t: t["number"].isNotNull())
    return F.array_join(F.transform(tracks, lambda t: F.concat(t["number"].cast("string"), F.lit(". "), to_text(t["titles"]))), "\n")


def prompt_table(albums: DataFrame) -> DataFrame:
    return albums.select("album_id", tracklist(F.col("discs")).alias("tracklist"))


def render_template(template: Column, tracklist_text: Column, notes: Column) -> Column:
    """``struct<text, error>``: placeholders filled in, doubled braces made single.

    Inserted texts are never searched for placeholders themselves. Any other placeholder, or a brace
    without its partner, is an error.
    """
    tokens = F.regexp_extract_all(template, F.lit(r"\{\{|\}\}|\{[^{}]*\}|[^{}]+|[{}]"), 0)

    def fill(token: Column) -> Column:
        return (
            F.when(token == "{tracklist}", tracklist_text)
            .when(token == "{notes}", F.coalesce(notes, F.lit("")))
            .when(token == "{{", F.lit("{"))
            .when(token == "}}", F.lit("}"))
            .when(~token.rlike("[{}]"), token)
        )

    def result(parts: Column) -> Column:
        bad = F.exists(parts, lambda p: p.isNull())
        return F.struct(F.when(~bad, F.array_join(parts, "")).alias("text"), F.when(bad, F.lit("invalid template")).alias("error"))

    return let(F.transform(tokens, fill), result)


def messages(system: Column, user: Column) -> Column:
    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    return F.array(message("system", system), message("user", user))


def corrective_message(reason: Column) -> Column:
    content = F.concat(F.lit(CORRECTION[0]), reason, F.lit(CORRECTION[1]))
    return F.struct(F.lit("user").alias("role"), content.alias("content"))


def _body(mode: str, model: str) -> Column:
    """The JSON request body around ``messages`` in one of the output modes."""
    schema = F.parse_json(F.lit(json.dumps(REPLY_SCHEMA)))
    fields = [F.lit(model).alias("model"), F.col("messages"), F.lit(0).alias("temperature")]
    if mode == "json_schema":
        wanted = F.struct(F.lit("enrichment").alias("name"), schema.alias("schema"), F.lit(False).alias("strict"))
        fields.append(F.struct(F.lit("json_schema").alias("type"), wanted.alias("json_schema")).alias("response_format"))
    elif mode == "tool":
        function = F.struct(F.lit(TOOL_NAME).alias("name"), F.lit(TOOL_DESCRIPTION).alias("description"), schema.alias("parameters"))
        fields.append(F.array(F.struct(F.lit("function").alias("type"), function.alias("function"))).alias("tools"))
        fields.append(F.struct(F.lit("function").alias("type"), F.struct(F.lit(TOOL_NAME).alias("name")).alias("function")).alias("tool_choice"))
    else:
        fields.append(F.struct(F.lit("json_object").alias("type")).alias("response_format"))
    return F.to_json(F.struct(*fields))


def request_rows(prompts: DataFrame, mode: str | Sequence[str] = "json_object", model: str = DEFAULT_MODEL) -> DataFrame:
    """(album_id, body) from (album_id, messages): JSON request bodies in one of the output modes.

    With a sequence of modes (album_id, mode, body), one row for each of them from one reading of the prompts.
    """
    modes = (mode,) if isinstance(mode, str) else tuple(mode)
    for m in modes:
        if m not in OUTPUT_MODES:
            raise ValueError(f"unknown output mode {m}")
    if isinstance(mode, str):
        return prompts.select("album_id", _body(mode, model).alias("body"))
    bodies = F.array(*[F.struct(F.lit(m).alias("mode"), _body(m, model).alias("body")) for m in modes])
    once = computed(prompts.select("album_id", "messages"), "messages", F.col("messages"))
    return once.select("album_id", F.explode(bodies).alias("r")).select("album_id", "r.mode", "r.body")


# -- replies ---------------------------------------------------------------------------------------


def _all(items: Column, test) -> Column:
    return F.coalesce(F.forall(items, test), F.lit(False))


def _part(value: Column, name: str) -> Column:
    return F.try_variant_get(value, f"$.{name}", "variant")


def _items(value: Column) -> Column:
    return F.try_variant_get(value, "$", "array<variant>")


def _values(value: Column) -> Column:
    return F.map_values(F.try_variant_get(value, "$", "map<string,variant>"))


def _is_artist(artist: Column) -> Column:
    names = _part(artist, "names")
    return is_kind(artist, "OBJECT") & is_kind(names, "OBJECT") & _all(_values(names), lambda n: is_kind(n, "STRING"))


def _is_credit(credit: Column) -> Column:
    artists = _part(credit, "artists")
    fits = artists.isNull() | (is_kind(artists, "ARRAY") & _all(_items(artists), _is_artist))
    return is_kind(credit, "OBJECT") & is_kind(_part(credit, "role_raw"), "STRING") & fits


def reply_problem(doc: Column) -> Column:
    """Why a parsed reply cannot be used; NULL for a good one."""
    found = _part(doc, "track_credits")
    fits = found.isNull() | (is_kind(found, "OBJECT") & _all(_values(found), lambda v: is_kind(v, "ARRAY") & _all(_items(v), _is_credit)))
    tracks = F.map_keys(F.try_variant_get(found, "$", "map<string,variant>"))
    numeric = found.isNull() | _all(tracks, lambda k: F.trim(k).try_cast("bigint").isNotNull())
    return F.when(doc.isNull(), "not JSON").when(~is_kind(doc, "OBJECT") | ~fits, "wrong shape").when(~numeric, "track key is no number")


def validate_replies(replies: DataFrame) -> DataFrame:
    """The replies (album_id, attempt, reply) with ``reason``: NULL for a valid reply."""
    parsed = replies.withColumn("_doc", F.try_parse_json("reply"))
    return parsed.withColumn("reason", reply_problem(F.col("_doc"))).drop("_doc")


_CREDITS = "map<string,array<struct<role_raw:string,artists:array<struct<names:map<string,string>>>>>>"


def reply_credits(valid: DataFrame) -> DataFrame:
    """(album_id, attempt, track, ord, role, role_raw, artists) of valid replies; roles are normalized here."""
    doc = F.from_json("reply", f"struct<track_credits:{_CREDITS}>")
    entries = F.transform(F.map_entries(doc["track_credits"]), lambda e: F.struct(F.trim(e["key"]).cast("bigint").alias("track"), e["value"].alias("credits")))
    # "1" and "01" are the same track; the later entry counts
    tracks = valid.select("album_id", "attempt", F.explode(deduplicate(entries, lambda e, _i: e["track"], keep="last")).alias("e"))
    rows = tracks.select("album_id", "attempt", "e.track", F.posexplode("e.credits").alias("ord", "c"))
    artists = F.transform(
        F.coalesce("c.artists", F.array()),
        lambda a: F.struct(a["names"].alias("names"), F.lit(None).cast("bigint").alias("id"), F.lit(None).cast("string").alias("link")),
    )
    return rows.select("album_id", "attempt", "track", "ord", normalize_role(F.col("c.role_raw")).alias("role"), "c.role_raw", artists.alias("artists"))


def settle_replies(validated: DataFrame, max_retries: int = 1) -> DataFrame:
    """(album_id, state, attempts, accepted_attempt, reply, reasons) per album.

    The first valid attempt is accepted. Otherwise the album is due for another request (``requeue``)
    until its attempts are used up (``exhausted``). ``reasons`` is bounded by the attempts allowed.
    """
    allowed = validated.where(F.col("attempt") <= max_retries + 1)
    once = allowed.groupBy("album_id", "attempt").agg(F.min_by(F.struct("reply", "reason"), F.struct("reason", "reply")).alias("r"))
    good = F.col("r.reason").isNull()
    per_album = once.groupBy("album_id").agg(
        F.max("attempt").alias("attempts"),
        F.min(F.when(good, F.struct("attempt", "r.reply"))).alias("hit"),
        F.array_sort(F.collect_list(F.when(~good, F.struct("attempt", "r.reason")))).alias("failed"),
    )
    state = F.when(F.col("hit").isNotNull(), "accepted").when(F.col("attempts") <= max_retries, "requeue").otherwise("exhausted")
    return per_album.select(
        "album_id", state.alias("state"), "attempts", F.col("hit.attempt").alias("accepted_attempt"), F.col("hit.reply").alias("reply"),
        F.transform("failed", lambda f: f["reason"]).alias("reasons"),
    )


def requeue(settled: DataFrame, prompts: DataFrame) -> DataFrame:
    """(album_id, messages) of the next request of every album due for one: one correction per failure."""
    due = settled.where(F.col("state") == "requeue").select("album_id", "reasons")
    corrected = F.concat("messages", F.transform("reasons", corrective_message))
    return prompts.join(due, "album_id").select("album_id", corrected.alias("messages"))
