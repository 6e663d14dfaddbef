"""The registered queries of the corpus operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sleevework.llm import backoff_lm, bestfit, exact_dedup, fill_in_middle, minhash_dedup, mixing, packing, prefix_trie, rule_quality, sharding, substring_dedup, tool_calls, topk

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _draw(modulus: int):
    return F.pmod(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")), F.lit(modulus))


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents"))


def op2_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = tool_calls.calls_of_turns(_table(spark, sf_dir, "conversations"))
    linked = tool_calls.link_tool_calls(calls, results, tool_calls.SAMPLE_TOOLS)
    return linked.withColumn("problems", F.array_join("problems", "; "))


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_words(_table(spark, sf_dir, "documents"), 20).drop("kept_text")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_table(spark, sf_dir, "documents"), 40)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = rule_quality.learn(docs, _table(spark, sf_dir, "labels"), _draw(5) != 0)
    marked = rule_quality.scored(docs.select("doc_id", "text"), model, name="score")
    return marked.select("doc_id", F.coalesce(_draw(5) == 0, F.lit(True)).alias("held_out"), "score", (F.col("score") >= rule_quality.THRESHOLD).cast("int").alias("predicted"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).drop("source", "repeats")


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(_table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), TOKENIZER, 1024)


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = backoff_lm.score_texts(_table(spark, sf_dir, "documents"), _draw(10) != 0)
    return scored.select("doc_id", F.coalesce(_draw(10) == 0, F.lit(True)).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(*prefix_trie.rebuilt(_table(spark, sf_dir, "conversations")))


def op12_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bestfit.best_fit(_table(spark, sf_dir, "documents"), WORD_TOKENIZER, 4096)


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle.fill_in_middle(_table(spark, sf_dir, "documents"))
    rebuilt = fill_in_middle.restored(F.col("form"), F.col("output"))
    hashes = [F.sha2(F.encode(text, "UTF-8"), 256).alias(name) for text, name in ((F.col("output"), "output_sha256"), (rebuilt, "restored_sha256"))]
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *hashes)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_exact_dedup, op2_tool_calls, op3_top_k, op4_substring_dedup, op5_sharding, op6_quality, op7_mixing, op8_near_dedup, op9_packing, op10_lm_score, op11_prefix_trie, op12_best_fit, op13_fill_in_middle)
}

_BARE = "regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', '', 'g')"
CHECKS: dict[str, str] = {
    "op1_exact_dedup": f"""
with d as (select doc_id, length(coalesce(text, '')) as n, {_BARE} as bare from documents),
g as (select bare, count(*) as group_size, first(doc_id order by n desc, doc_id) as keep_id from d group by bare)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(bare) as text_sha256 from d join g using (bare)""",
    "op2_tool_calls": """
with t as (select conv_id, turn, role, coalesce(text, '') as text, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as w,
  len(coalesce(text, '')) - len(replace(coalesce(text, ''), chr(10), '')) + 1 as l from conversations),
c as (select conv_id, 'c' || turn as call_id, 'c' || (turn - 2) as parent_id, turn as position,
  case w % 3 when 0 then 'search' when 1 then 'lookup' else 'browse' end as name,
  case w % 3 when 0 then '{"limit":' || w || ',"query":' || to_json(text) || ',"strict":' || (w % 2 = 0)::varchar || '}'
    when 1 then '{"lines":' || l || ',"mode":"' || case when l = 2 then 'brief' else 'short' end || '","query":' || to_json(text) || '}' end as arguments,
  case w % 3 when 0 then case when w < 1 then 'minimum limit' when w > 60 then 'maximum limit' else '' end
    when 1 then array_to_string(list_filter([case when l > 3 then 'maximum lines' end, case when l = 2 then 'value mode' end], lambda x: x is not null), '; ')
    else 'not a JSON object' end as problems
  from t where role = 'assistant'),
r as (select conv_id, 'c' || (turn - 1) as call_id, turn as position, text as content from t where role = 'user' and turn > 0),
a as (select conv_id, call_id, min(position) as position, arg_min(content, position) as content, count(*) as n_results from r group by all),
e as (select c.conv_id, c.call_id, c.position, c.name, c.arguments, c.problems,
  c.position - 2 in (select position from c x where x.conv_id = c.conv_id) as linked from c),
d as (select *, count(*) over (partition by conv_id, run order by position) - 1 as depth from
  (select *, sum(case when linked then 0 else 1 end) over (partition by conv_id, position % 2 order by position) as run_, position % 2 as odd,
    conv_id || ':' || (position % 2) || ':' || sum(case when linked then 0 else 1 end) over (partition by conv_id, position % 2 order by position) as run from e)),
j as (select coalesce(d.conv_id, a.conv_id) as conv_id, coalesce(d.call_id, a.call_id) as call_id,
  case when d.call_id is null then 'orphan' when a.call_id is null then 'unanswered' else 'linked' end as status,
  name, arguments, problems, content, coalesce(n_results, 0) as n_results, case when d.call_id is null then 0 else 1 end::bigint as n_calls, depth,
  case when d.call_id is null then 2 else 0 end as late, coalesce(depth, 0) as dp, coalesce(d.position, a.position) as pos
  from d full join a on d.conv_id = a.conv_id and d.call_id = a.call_id)
select conv_id, call_id, status, name, arguments, problems, content, n_results, n_calls, depth,
  row_number() over (partition by conv_id order by late, dp, pos, call_id) - 1 as call_order from j""",
    "op3_top_k": """
with v as (select distinct vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as e from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id as query_id, c.vec_id, list_inner_product(q.e, c.e)::bigint as score from v q join v c on len(q.e) = len(c.e) and q.vec_id <> c.vec_id where q.vec_id % 50 = 0),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id)::integer as rank from s)
select query_id, rank, vec_id, score from r where rank <= 5""",
    "op11_prefix_trie": """
with t as (select conv_id, coalesce(role, '') as role, coalesce(text, '') as text, row_number() over (partition by conv_id order by turn nulls first,
    unhex(sha256(octet_length(coalesce(role, '')::blob) || ':' || coalesce(role, '') || coalesce(text, '')))) - 1 as place from conversations where conv_id is not null),
c as (select distinct conv_id, conv_id - conv_id % 20 as base, xor(4294967295, list_reduce(list_concat([4294967295], list_transform(string_split(conv_id::varchar, ''), lambda ch: ascii(ch)::bigint)),
    lambda a, b: list_reduce(list_concat([xor(a, b)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda p, q: xor(p >> 1, (p & 1) * 3988292384)))) % 4 as h from t),
r as (select c.conv_id, place, 0 as late, role, text from c join t on t.conv_id = c.base and place < h union all select conv_id, place, 1, role, text from c join t using (conv_id) where place >= h),
s as (select c.conv_id, coalesce(list({'role': r.role, 'text': r.text} order by late, place) filter (where r.conv_id is not null), []) as path from c left join r using (conv_id) group by c.conv_id),
m as (select conv_id, len(path) as size, unnest(range(0, len(path) + 1)) as depth, path from s),
n as (select depth, path[1:depth] as path, min(conv_id) as conv_id, count(*) as n_convs, coalesce(sha256(string_agg(conv_id::varchar, ',' order by conv_id) filter (where size = depth)), sha256('')) as ends_sha256
  from m group by depth, path[1:depth]),
k as (select depth - 1 as depth, path[1:depth - 1] as path, count(*) as n_children from n where depth > 0 group by all),
w as (select n.*, coalesce(n_children, 0) as n_children, case when n.depth = 0 then 0 else (n_convs - 1) * len(regexp_extract_all(n.path[-1].text, '[^\\x20\\x09-\\x0D]+')) end as worth
  from n left join k on k.depth = n.depth and k.path = n.path),
u as (select depth, path[1:depth] as path, sum(worth)::bigint as saved_tokens, sum((n_children = 0)::int)::bigint as n_leaves
  from (select unnest(range(0, depth + 1)) as depth, path, worth, n_children from w) group by all)
select w.conv_id, w.depth::bigint as depth, p.conv_id as parent_conv_id, w.n_convs, w.n_children, u.n_leaves, u.saved_tokens, w.ends_sha256
from w join u on u.depth = w.depth and u.path = w.path left join w p on p.depth = w.depth - 1 and p.path = w.path[1:w.depth - 1]""",
    "op13_fill_in_middle": """
with d as (select doc_id, coalesce(text, '') as t, sha256('1:' || coalesce(doc_id::varchar, '')) as s from documents),
h as (select *, length(t)::bigint as n, ('0x' || s[1:8])::bigint as h1, ('0x' || s[9:16])::bigint as h2, ('0x' || s[17:24])::bigint as h3, ('0x' || s[25:32])::bigint as h4 from d),
c as (select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
  case when n = 0 or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 90 then 'plain' when h4 % 100 < 20 then 'spm' else 'psm' end as form from h),
p as (select *, substr(t, 1, a) as pre, substr(t, a + 1, b - a) as mid, substr(t, b + 1) as suf from c)
select doc_id, n, form, case when form <> 'plain' then a end as prefix_chars, case when form <> 'plain' then b - a end as middle_chars,
  sha256(case form when 'plain' then t when 'psm' then '<P>' || pre || '<S>' || suf || '<M>' || mid else '<S>' || suf || '<P>' || pre || '<M>' || mid end) as output_sha256,
  sha256(t) as restored_sha256 from p""",
}
