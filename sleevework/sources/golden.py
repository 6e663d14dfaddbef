"""Golden documents: typed JSON that must fit its schema exactly, on every level."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sleevework.functions.core import let
from sleevework.functions.loose_json import is_kind
from sleevework.functions.roles import ROLES

# The shapes of the documents. NOT NULL marks what has to be there.
REF = "struct<names:map<string,string> NOT NULL,id:bigint,link:string>"
PARTIAL_DATE = "struct<year:int NOT NULL,month:int,day:int>"
TRACK = "struct<titles:map<string,string> NOT NULL,number:int,length:string>"
CREDIT = f"struct<role:string NOT NULL,role_raw:string NOT NULL,artists:array<{REF}>>"
ALBUM_SCHEMA = (
    f"id bigint NOT NULL, link string, titles map<string,string> NOT NULL, catalog string, release_date {PARTIAL_DATE}, classification string, "
    f"cover_small string, cover_full string, discs array<struct<number:int,name:string,tracks:array<{TRACK}>>>, "
    f"credits array<{CREDIT}>, notes string, release_event {REF}"
)
ARTIST_SCHEMA = (
    f"id bigint NOT NULL, link string, names map<string,string> NOT NULL, aliases array<string>, type string, birthdate {PARTIAL_DATE}, notes string, "
    f"members array<{REF}>, units array<{REF}>"
)
PRODUCT_SCHEMA = f"id bigint NOT NULL, link string, names map<string,string> NOT NULL, type string, notes string, franchises array<{REF}>, organizations array<{REF}>"
ORGANIZATION_SCHEMA = "id bigint NOT NULL, link string, names map<string,string> NOT NULL, type string, notes string"
EVENT_SCHEMA = f"id bigint NOT NULL, link string, names map<string,string> NOT NULL, type string, start_date {PARTIAL_DATE}, end_date {PARTIAL_DATE}, notes string"
SEARCH_HIT = f"struct<id:bigint NOT NULL,link:string,titles:map<string,string> NOT NULL,catalog:string,release_date:{PARTIAL_DATE}>"
SEARCH_SCHEMA = f"query string NOT NULL, albums array<{SEARCH_HIT}>"
ENRICHMENT_SCHEMA = f"album_id bigint, track_credits map<string,array<{CREDIT}>>"

# Numbers in bounds, words out of a vocabulary, and fields that need another one, by field name.
BOUNDS = {"month": (1, 12), "day": (1, 31)}
VOCABULARY = {"role": ROLES}
NEEDS = {"day": "month"}
_WHOLE = {"bigint": (-(2**63), 2**63 - 1), "int": (-(2**31), 2**31 - 1)}


def _said(path: Column, reason: str) -> Column:
    return F.array(F.struct(path.alias("path"), F.lit(reason).alias("reason")))


def _unless(fits: Column, path: Column, reason: str) -> Column:
    nothing = F.array().cast(PROBLEMS)
    return F.when(F.coalesce(fits, F.lit(False)), nothing).otherwise(_said(path, reason))


PROBLEMS = "array<struct<path:string,reason:string>>"
KEYS = "map<string,struct<_:variant>>"  # an object read for its keys: no entry is turned into another value


def _part(value: Column, kind: T.DataType, path: Column, name: str) -> Column:
    """The problems of a VARIANT that is neither absent nor null, as ``array<struct<path, reason>>``."""
    if isinstance(kind, T.StructType):
        return _object(value, kind, path)
    if isinstance(kind, T.ArrayType):
        items = F.try_variant_get(value, "$", "array<variant>")
        inside = F.transform(items, lambda x, i: _item(x, kind.elementType, F.concat(path, F.lit("["), i.cast("string"), F.lit("]")), name))
        return F.coalesce(F.flatten(inside), _said(path, "wrong type"))
    if isinstance(kind, T.MapType):
        entries = F.map_entries(F.try_variant_get(value, "$", "map<string,variant>"))
        inside = F.transform(entries, lambda e: _item(e["value"], kind.valueType, F.concat(path, F.lit("."), e["key"]), name))
        return F.coalesce(F.flatten(inside), _said(path, "wrong type"))
    if isinstance(kind, T.StringType):
        found = _unless(is_kind(value, "STRING"), path, "wrong type")
        if name in VOCABULARY:
            known = F.try_variant_get(value, "$", "string").isin(*VOCABULARY[name])
            return F.when(is_kind(value, "STRING"), _unless(known, path, "unknown word")).otherwise(found)
        return found
    low, high = _WHOLE[kind.simpleString()]
    number = F.try_variant_get(value, "$", "bigint")
    found = F.when(is_kind(value, "BIGINT"), _unless(number.between(low, high), path, "wrong type")).otherwise(_said(path, "wrong type"))
    if name in BOUNDS:
        return F.when(is_kind(value, "BIGINT"), _unless(number.between(*BOUNDS[name]), path, "out of bounds")).otherwise(found)
    return found


def _item(value: Column, kind: T.DataType, path: Column, name: str) -> Column:
    """The problems of an entry of a list or mapping, where null is no value."""
    return let(F.struct(value.alias("v"), path.alias("p")), lambda x: F.when(x["v"].isNull() | F.is_variant_null(x["v"]), _said(x["p"], "wrong type")).otherwise(_part(x["v"], kind, x["p"], name)))


def _judge(field: T.StructField, here: Column) -> Callable[[Column], Column]:
    """The problems of a field's value; lists and mappings may be absent but not null."""
    nothing = F.array().cast(PROBLEMS)
    may_be_null = field.nullable and not isinstance(field.dataType, (T.ArrayType, T.MapType))
    null = nothing if may_be_null else _said(here, "wrong type")
    absent = nothing if field.nullable else _said(here, "missing")
    return lambda v: F.when(v.isNull(), absent).when(F.is_variant_null(v), null).otherwise(_part(v, field.dataType, here, field.name))


def _object(value: Column, kind: T.StructType, path: Column) -> Column:
    """The problems of a VARIANT that should be an object; it is taken apart once, for all its fields."""
    parts = F.try_variant_get(value, "$", f"struct<{','.join(f'`{f.name}`:variant' for f in kind.fields)}>")
    keys = F.map_keys(F.try_variant_get(value, "$", KEYS))
    at = lambda name: F.concat(path, F.when(path != "", ".").otherwise(""), name)

    def inside(x: Column) -> Column:
        unknown = F.array_sort(F.array_except(x["keys"], F.array(*[F.lit(f.name) for f in kind.fields])))
        found = [F.transform(unknown, lambda k: F.struct(at(k).alias("path"), F.lit("unknown field").alias("reason")))]
        for field in kind.fields:
            here = at(F.lit(field.name))
            found.append(_judge(field, here)(x["parts"][field.name]))
            if field.name in NEEDS:
                there = lambda name: F.try_variant_get(x["parts"][name], "$", "bigint").isNotNull()
                found.append(_unless(~there(field.name) | there(NEEDS[field.name]), here, f"needs {NEEDS[field.name]}"))
        return F.when(x["parts"].isNotNull(), F.concat(*found)).otherwise(_said(path, "wrong type"))

    return let(F.struct(keys.alias("keys"), parts.alias("parts")), inside)


def document_problems(text: Column, schema: str) -> Column:
    """``array<struct<path, reason>>`` of a JSON text: empty for a document that fits its schema on every level.

    The schema is closed: a key that it does not name, on any level, is a problem, like a missing or null value
    that has to be there, a wrong type, a number out of bounds or a word outside its vocabulary. Everything is
    found in one pass over the row, in the order of the schema.
    """
    struct = T._parse_datatype_string(schema)
    broken = _said(F.lit(""), "not JSON")
    return let(F.try_parse_json(text), lambda doc: F.when(doc.isNull(), broken).otherwise(_part(doc, struct, F.lit(""), "")))


def golden_findings(texts: DataFrame, schema: str, value: str = "value") -> DataFrame:
    """The other columns with (path, reason), one row per problem."""
    rest = [c for c in texts.columns if c != value]
    return texts.select(*rest, F.explode(document_problems(F.col(value), schema)).alias("problem")).select(*rest, "problem.path", "problem.reason")


def golden_problems(texts: DataFrame, schema: str, value: str = "value") -> DataFrame:
    """The input with ``problem``: NULL for a fitting document, else all that does not fit."""
    named = F.transform(document_problems(F.col(value), schema), lambda p: F.concat(p["reason"], F.when(p["path"] != "", F.concat(F.lit(" "), p["path"])).otherwise("")))
    return texts.withColumn("problem", F.nullif(F.array_join(named, "; "), F.lit("")))


def golden_documents(texts: DataFrame, schema: str, value: str = "value") -> DataFrame:
    """(doc): documents of the schema. A text that does not fit fails the job, as it should."""
    checked = golden_problems(texts, schema, value)
    fitting = F.when(F.col("problem").isNotNull(), F.raise_error(F.concat(F.lit("golden document: "), "problem")).cast("string")).otherwise(F.col(value))
    return checked.select(F.from_json(fitting, T._parse_datatype_string(schema), {"mode": "FAILFAST"}).alias("doc"))


def scan_golden(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Documents of a folder of JSON files, one whole document per file."""
    return golden_documents(spark.read.text(path, wholetext=True), schema)
