"""Queries over the integrity checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sleevework.operators import checks as D
from sleevework.operators import notes as N
from sleevework.plans.registry import notes_view, query, table, view


@query("d1_min_rows", """
select w.section, coalesce(c.n, 0) as n, w.floor from (values ('1-URGENT', 1000000000000), ('5-LOW', 1), ('9-NONE', 1)) w(section, floor)
left join (select o_orderpriority as section, count(*) as n from orders group by 1) c on c.section = w.section where coalesce(c.n, 0) < w.floor
""")
def min_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("section"))
    return D.min_rows(entries, {"1-URGENT": 1_000_000_000_000, "5-LOW": 1, "9-NONE": 1})


@query("d2_well_formed", """
select album_id, concat_ws(', ', case when title is null then 'no title' end, case when catalog is null then 'no catalog' end,
  case when classification not in ('F', 'O') then 'kind' end) as problems
from v_albums where title is null or catalog is null or classification not in ('F', 'O')
""")
def well_formed(spark: SparkSession, sf_dir: str) -> DataFrame:
    albums = view(spark, sf_dir, "v_albums")
    rows = D.well_formed(albums, ["title", "catalog"], {"kind": F.col("classification").isin("F", "O")})
    return rows.select("album_id", "problems")


@query("d3_unique_keys", "select l_orderkey, cast(l_linenumber as bigint) as l_linenumber, count(*) as n from lineitem group by 1, 2 having count(*) > 1")
def unique_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"))
    return D.unique_keys(rows, ["l_orderkey", "l_linenumber"])


@query("d4_orphans", """
select distinct key from (select l_orderkey as key from lineitem union all select o_custkey from orders) t
where key not in (select o_orderkey from orders where o_orderstatus = 'F')
""")
def orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    stored = [table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("key")), orders.select(F.col("o_custkey").alias("key"))]
    return D.orphans(stored, orders.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("key")))


@query("d5_completeness", """
select o_orderkey as key, case when s.size is null then 'missing' else 'empty' end as problem
from orders left join (select l_orderkey, max(case when l_linenumber > 2 then 1 else 0 end) as size from lineitem group by 1) s on l_orderkey = o_orderkey
where s.size is null or s.size = 0
""")
def completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"))
    stored = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("key"), F.when(F.col("l_linenumber") > 2, 1).otherwise(0).alias("length"))
    return D.completeness(listed, stored, F.col("length"))


@query("d6_set_equality", """
select coalesce(a.key, b.key) as key, case when b.key is null then 'left' else 'right' end as side
from (select distinct l_orderkey as key from lineitem where l_linenumber <> 1) a full outer join (select distinct o_orderkey as key from orders where o_orderkey % 9 <> 0) b on a.key = b.key
where a.key is null or b.key is null
""")
def set_equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = table(spark, sf_dir, "lineitem").where("l_linenumber <> 1").select(F.col("l_orderkey").alias("key"))
    right = table(spark, sf_dir, "orders").where("o_orderkey % 9 <> 0").select(F.col("o_orderkey").alias("key"))
    return D.set_difference(left, right, ["key"])


@query("d7_foreign_key", """
select album_id, track, count(*) as n from x_emitted_grp e
where not exists (select 1 from v_tracks t where t.album_id = e.album_id and t.number = e.track) group by album_id, track
""")
def foreign_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    tracks = view(spark, sf_dir, "v_tracks").select("album_id", F.col("number").alias("track"))
    return D.foreign_key(N.emit(notes_view(spark, sf_dir)).select("album_id", "track"), tracks, ["album_id", "track"])
