"""Queries over the scalar functions: dates, languages, roles, ranges, names, JSON values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sleevework.functions import dates, localized, loose_json, roles, text, tracks
from sleevework.plans import duck
from sleevework.plans.registry import CHECK_VIEWS, by_key, notes_view, query, table, view


def _parts(date: Column) -> list[Column]:
    return [date[p].cast("bigint").alias(p) for p in ("year", "month", "day")]


def _date_rows(spark: SparkSession, sf_dir: str, parse) -> DataFrame:
    return view(spark, sf_dir, "v_dates").select("id", parse(F.col("raw")).alias("d")).select("id", *_parts(F.col("d")))


# How each shape of v_dates reads: y, m, d are the true parts; id % 12 tells the shape.
CHECK_VIEWS["x_iso_dates"] = """
select id, case when id % 12 in (0, 1, 2, 9) then y end as year,
  case id % 12 when 0 then m when 1 then m when 9 then 2 end as month, case id % 12 when 0 then d when 9 then 31 end as day
from v_dates
"""
CHECK_VIEWS["x_text_dates"] = """
select id, case when id % 12 in (2, 3, 4) then y end as year, case when id % 12 in (3, 4) then m end as month,
  case when id % 12 = 3 then d end as day
from v_dates
"""
CHECK_VIEWS["x_link_dates"] = """
select id, case when id % 12 in (5, 10) then y end as year, case when id % 12 in (5, 10) then m end as month,
  case when id % 12 in (5, 10) then d end as day
from v_dates
"""
CHECK_VIEWS["x_any_dates"] = """
select i.id, coalesce(l.year, i.year, t.year) as year, coalesce(l.month, i.month, t.month) as month, coalesce(l.day, i.day, t.day) as day
from x_iso_dates i join x_text_dates t on i.id = t.id join x_link_dates l on l.id = i.id
"""
_AS_BIGINT = "select id, cast(year as bigint) as year, cast(month as bigint) as month, cast(day as bigint) as day from "


@query("v1_parse_partial_date", _AS_BIGINT + "x_iso_dates")
def parse_partial_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _date_rows(spark, sf_dir, dates.parse_partial_date)


@query("v2_partial_date", _AS_BIGINT + "x_any_dates")
def partial_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _date_rows(spark, sf_dir, dates.partial_date)


@query(
    "v2b_release_date",
    """select id, cast(case when id % 12 in (5, 10) then y when id % 4 <> 0 then y end as bigint) as year,
         cast(case when id % 12 in (5, 10) then m end as bigint) as month, cast(case when id % 12 in (5, 10) then d end as bigint) as day
       from v_dates""",
)
def release_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    href = F.when(F.col("raw").startswith("/") | F.col("raw").startswith("?"), F.col("raw"))
    label = F.when(F.col("id") % 4 != 0, F.col("y").cast("string"))
    return view(spark, sf_dir, "v_dates").select("id", dates.release_date(href, label).alias("d")).select("id", *_parts(F.col("d")))


@query("v3_parse_text_date", _AS_BIGINT + "x_text_dates")
def parse_text_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _date_rows(spark, sf_dir, dates.parse_text_date)


@query(
    "v4_validate_date",
    """select id, case when id % 2 = 0 then m else 13 - m % 3 end between 1 and 12
           and (d % 7 = 0 or (d + 3 between 1 and 31 and id % 5 <> 0) or false) as valid
       from v_dates where not (id % 5 = 0 and id % 2 = 0)
       union all
       select id, d % 7 = 0 as valid from v_dates where id % 5 = 0 and id % 2 = 0""",
)
def validate_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = view(spark, sf_dir, "v_dates")
    month = F.when(F.col("id") % 2 != 0, 13 - F.col("m") % 3).when(F.col("id") % 5 != 0, F.col("m"))
    day = F.when(F.col("d") % 7 != 0, F.when(F.col("id") % 5 == 0, 32).otherwise(F.col("d") + 3))
    return df.select("id", dates.is_valid_date(F.col("y"), month, day).alias("valid"))


@query(
    "v5_precision",
    "select id, case when day is not null then 'day' when month is not null then 'month' when year is not null then 'year' end as grain from x_any_dates",
)
def precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "v_dates").select("id", dates.precision(dates.partial_date(F.col("raw"))).alias("grain"))


@query(
    "v6_iso",
    """select id, printf('%04d', year) || case when month is null then '' else printf('-%02d', month) end
         || case when day is null then '' else printf('-%02d', day) end as iso from x_any_dates""",
)
def iso(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "v_dates").select("id", dates.iso(dates.partial_date(F.col("raw"))).alias("iso"))


CHECK_VIEWS["x_localized"] = f"""
select id, case when en <> '' then en end as english, case when {duck.cjk('ja')} then ja end as japanese,
  case when romaji <> '' and romaji <> en then romaji end as romaji
from v_localized
"""


def _localized(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = localized.placeholder_rule(F.col("en"), F.col("ja"), F.col("romaji"))
    return view(spark, sf_dir, "v_localized").select("id", rule.alias("t"))


@query("p5_placeholder_rule", "select id, english, japanese, romaji from x_localized")
def placeholder_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = {"english": "English", "japanese": "Japanese", "romaji": "Romaji"}
    return _localized(spark, sf_dir).select("id", *[F.col("t")[k].alias(n) for n, k in names.items()])


@query("v7_default_text", "select id, coalesce(english, romaji, japanese) as best from x_localized")
def default_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _localized(spark, sf_dir).select("id", localized.default_text(F.col("t")).alias("best"))


@query(
    "v7b_prefer",
    """select id, coalesce(japanese, romaji, english) as ja_first, coalesce(english, romaji, japanese) as german_first,
         coalesce(english, romaji, japanese, '') as shown from x_localized""",
)
def prefer(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("t")
    return _localized(spark, sf_dir).select(
        "id",
        localized.prefer(t, "Japanese", "Romaji").alias("ja_first"),
        localized.prefer(t, "German").alias("german_first"),
        localized.to_text(t).alias("shown"),
    )


@query(
    "v8_has_cjk",
    f"""select cast(doc_id as varchar) as id, {duck.cjk('text')} as cjk, case when {duck.cjk('text')} then 'Japanese' else 'English' end as label from documents
        union all select concat('p', id), {duck.cjk('ja')}, case when {duck.cjk('ja')} then 'Japanese' else 'English' end from v_localized""",
)
def has_cjk(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), "text")
    parts = view(spark, sf_dir, "v_localized").select(F.concat(F.lit("p"), "id").alias("id"), F.col("ja").alias("text"))
    both = docs.unionByName(parts)
    return both.select("id", text.has_cjk(F.col("text")).alias("cjk"), text.name_key(F.col("text")).alias("label"))


_ROLE_COUNTS = f"select role_raw, {duck.role_case('role_raw')} as role, count(*) as n from v_credit_labels group by all"


@query("v9_normalize_role", _ROLE_COUNTS)
def normalize_role(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = view(spark, sf_dir, "v_credit_labels")
    return labels.groupBy("role_raw", roles.normalize_role(F.col("role_raw")).alias("role")).agg(F.count(F.lit(1)).alias("n"))


@query("v9_normalize_role_by_table", _ROLE_COUNTS)
def normalize_role_by_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    # labels are counted first, so the join sees one row per distinct label
    counted = view(spark, sf_dir, "v_credit_labels").groupBy("role_raw").agg(F.count(F.lit(1)).alias("n"))
    return roles.normalize_role_by_table(counted, "role_raw", roles.role_rules(spark)).select("role_raw", "role", "n")


@query("v10_has_role_keyword", f"select album_id, pos, {duck.credit_word('line')} as has_word from x_lines")
def has_role_keyword(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = notes_view(spark, sf_dir).select("album_id", F.posexplode(text.lines(F.col("notes"))).alias("pos", "line"))
    return lines.select("album_id", F.col("pos").cast("bigint").alias("pos"), roles.has_role_keyword(F.col("line")).alias("has_word"))


@query(
    "v11_parse_track_set",
    f"select album_id, number, partkey, suppkey, raw, {duck.numbers(duck.track_set('raw'))} as tracks from v_ranges",
)
def parse_track_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = F.array_join(F.array_sort(tracks.parse_track_set(F.col("raw"))), ",")
    ranges = by_key(view(spark, sf_dir, "v_ranges"), "album_id")
    return ranges.select("album_id", "number", "partkey", "suppkey", "raw", found.alias("tracks"))


@query(
    "v11_track_set_rejects",
    """select album_id, number, partkey, suppkey, case suppkey % 9 when 6 then concat(number + 3, ' ~ ', number) when 7 then concat(number, '~', 501 + number) else concat('14~', 14 + number) end as token,
         case suppkey % 9 when 6 then 'backwards' else 'too wide' end as reason
       from v_ranges where suppkey % 9 in (6, 7) or suppkey % 9 = 4 and number > case when suppkey % 2 = 0 then 500 else 3 end
       union all select album_id, number, partkey, suppkey, 'M01~12', 'too wide' from v_ranges where suppkey % 9 = 4 and suppkey % 2 = 1
       union all select album_id, number, partkey, suppkey, '27~31', 'too wide' from v_ranges where suppkey % 9 = 4 and suppkey % 2 = 1
       union all select album_id, number, partkey, suppkey, raw, 'too wide' from v_ranges where suppkey % 9 = 8 and suppkey % 2 = 1""",
)
def track_set_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every second supplier believes ranges of 3 at most, the others the usual width."""
    ranges = by_key(view(spark, sf_dir, "v_ranges"), "album_id")
    widest = F.when(F.col("suppkey") % 2 == 1, 3).otherwise(tracks.WIDEST_RANGE)
    rejects = ranges.select("album_id", "number", "partkey", "suppkey", F.explode(tracks.track_set_rejects(F.col("raw"), widest)).alias("r"))
    return rejects.select("album_id", "number", "partkey", "suppkey", "r.token", "r.reason")


@query("v12_split_names", f"select album_id, pos, array_to_string({duck.names('line')}, '|') as names from x_lines")
def split_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = notes_view(spark, sf_dir).select("album_id", F.posexplode(text.lines(F.col("notes"))).alias("pos", "line"))
    return lines.select("album_id", F.col("pos").cast("bigint").alias("pos"), F.array_join(tracks.split_names(F.col("line")), "|").alias("names"))


@query(
    "v13_normalize_value",
    "select source, album_id, field, nullif(lower(trim(regexp_replace(value, '\\s+', ' ', 'g'))), '') as norm from v_source",
)
def normalize_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "v_source").select("source", "album_id", "field", text.normalize_value(F.col("value")).alias("norm"))


# Names and plain values in every shape the tolerant readers must survive.
_NAME_SHAPES = """case id % 9
  when 0 then to_json(named_struct('v', raw)) when 1 then '{"v": 17}' when 2 then '{"v": "  "}' when 3 then '{}' when 4 then '{"v": null}'
  when 5 then to_json(named_struct('v', named_struct('Romaji', concat('R', raw), 'en', raw)))
  when 6 then to_json(named_struct('v', named_struct('ja', concat('J', raw), 'English', '')))
  when 7 then to_json(named_struct('v', named_struct('Deutsch', 5, 'Korean', concat('K', raw))))
  else '{broken' end"""


@query(
    "v14_name_text",
    """select id, case id % 9 when 0 then raw end as plain,
         case id % 9 when 0 then raw when 5 then concat('R', raw) when 6 then concat('J', raw) when 7 then concat('K', raw) end as name
       from v_dates""",
)
def name_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    payload = F.try_variant_get(F.try_parse_json(F.expr(_NAME_SHAPES)), "$.v", "variant")
    df = view(spark, sf_dir, "v_dates").select("id", payload.alias("v"))
    return df.select("id", loose_json.as_text(F.col("v")).alias("plain"), loose_json.name_text(F.col("v")).alias("name"))


@query(
    "v15_percent",
    """select o_orderkey as id, case when o_custkey % 9 = 0 then 'n/a' else
         concat(cast(cast(round_even(100.0 * cast(o_orderkey % 9 as double) / (o_custkey % 9), 0) as bigint) as varchar), '%') end as pct
       from orders""",
)
def percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), text.percent(F.col("o_orderkey") % 9, F.col("o_custkey") % 9).alias("pct")
    )


_CONTENT_SHAPES = """case conv_id % 4 when 0 then to_json(named_struct('c', text))
  when 1 then concat('{"c": [', to_json(named_struct('type', 'text', 'text', text)), ', 5, {"type": "image"}, ', to_json(named_struct('text', role)), ']}')
  when 2 then '{"c": 7}' else '{}' end"""


@query(
    "v16_content_text",
    "select conv_id, turn, md5(case conv_id % 4 when 0 then text when 1 then text || role else '' end) as content_md5 from conversations",
)
def content_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    payload = F.try_variant_get(F.try_parse_json(F.expr(_CONTENT_SHAPES)), "$.c", "variant")
    df = table(spark, sf_dir, "conversations").select("conv_id", "turn", payload.alias("c"))
    return df.select("conv_id", "turn", F.md5(loose_json.content_text(F.col("c"))).alias("content_md5"))
