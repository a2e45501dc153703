"""The operators of this folder as registered queries over the sample tables, with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.llm import (chat, crf, decontaminate, linerules, minmax, packing, prefixtrie, quality, repair, termscan, topk, windows,
                          wrappers)
from tickwise.llm.frames import shared_path, stored

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op4_exact_top_k", """with q as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as c from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.vec_id as query_id, b.vec_id, list_sum(list_transform(range(1, len(a.c) + 1), lambda i: a.c[i] * b.c[i]))::bigint as score
  from q a join q b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
select query_id, rank::int as rank, vec_id, score from r where rank <= 5""")
def exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = topk.quantize(table(spark, folder, "embeddings"))
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), k=5)


@query("op10_token_files")
def token_files(spark: SparkSession, folder: str) -> DataFrame:
    files = shared_path(spark, "token-ids")
    repair.write_ids(table(spark, folder, "documents"), files)
    return repair.digests(spark, files)


@query("op6_packing")
def packing_query(spark: SparkSession, folder: str) -> DataFrame:
    placed = packing.pack_documents(table(spark, folder, "documents"))
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@query("op7_minmax_near_dedup", """with recursive w as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w from documents),
s as (select doc_id, unnest(list_distinct(case when len(w) >= 2 then list_transform(range(1, len(w)), lambda i: w[i] || chr(32) || w[i + 1])
  else w end)) as s from w),
n as (select doc_id, count(*) as n from s group by doc_id),
f as (select s.*, n.n from s join n using (doc_id)),
p as (select a.doc_id as a, b.doc_id as b from f a join f b on a.s = b.s and a.doc_id <> b.doc_id and 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 80 * (a.n + b.n - count(*))),
r(doc_id, reached) as (select doc_id, doc_id from documents union select r.doc_id, p.b from r join p on r.reached = p.a)
select d.doc_id, coalesce(n.n, 0) as n_shingles, c.component_id, d.doc_id = c.component_id as kept
from documents d left join n using (doc_id) join (select doc_id, min(reached) as component_id from r group by doc_id) c using (doc_id)""")
def near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minmax.near_duplicates(table(spark, folder, "documents"), shingle=2)


@query("op9_chat_format")
def chat_format(spark: SparkSession, folder: str) -> DataFrame:
    said = "<|im_end|><|im_start|>assistant ok"
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    turns = table(spark, folder, "conversations").select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text").unionByName(extra)
    return chat.read_digests(stored(chat.format_conversations(turns), "windows"))


@query("op8_toxicity_crf")
def toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = crf.fit(docs, table(spark, folder, "labels").where(~held_out))
    scored = crf.score(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"),
                         "n_toxic_words", "span_starts", "span_ends")


@query("op2_quality")
def quality_query(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "source", "lang")
    return quality.judge(docs, table(spark, folder, "labels")).drop("text")


@query("op3_main_text")
def main_text_query(spark: SparkSession, folder: str) -> DataFrame:
    return wrappers.main_text(table(spark, folder, "pages"))


@query("op1_decontamination")
def decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op5_substring_dedup")
def substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return windows.repeated_passages(table(spark, folder, "documents"))


@query("op11_term_scan", """with recursive doc as (
  select row_number() over () as d, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as w from documents),
s as (select count(*) filter (len(w) > 0) as n_docs, sum(len(w))::bigint as length from doc),
item as (select row_number() over () as i, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as w from benchmark),
it as (select i, item_id, t, count(*) as times from (select i, item_id, unnest(w) as t from item) group by i, item_id, t),
tf as (select d, t, count(*) as tf from (select d, unnest(w) as t from doc) where t in (select t from it) group by d, t),
wt as (select t, floor(1000 * ln((2 * n_docs + 2)::double / (2 * count(*) + 1)::double))::bigint as w from tf, s group by t, n_docs),
p as (select tf.d, t, wt.w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * len(doc.w) * n_docs) // length))) as part
  from tf join wt using (t) join doc using (d), s),
sc as (select i, item_id, d, sum(times * part)::bigint as score from it join p using (t) group by i, item_id, d),
r as (select i, item_id, doc_id, score, row_number() over (partition by i order by score desc, doc_id) as rank from sc join doc using (d)
  where score > 0 and doc_id is not null)
select item_id, rank::int as rank, doc_id, score from r where rank <= 20""")
def term_scan(spark: SparkSession, folder: str) -> DataFrame:
    return termscan.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"), k=20)


@query("op12_prefix_trie", """with own as (
  select conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')} order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as own
  from conversations where conv_id is not null group by conv_id),
h as (select *, xor(list_reduce(list_prepend(4294967295::ubigint, flatten(list_transform(string_split(conv_id::varchar, ''),
    lambda c: [ascii(c)::ubigint, 0, 0, 0, 0, 0, 0, 0]))),
    lambda a, b: case when xor(a, b) & 1 = 1 then xor(xor(a, b) >> 1, 3988292384::ubigint) else xor(a, b) >> 1 end), 4294967295::ubigint) % 6 as h from own),
b as (select h.conv_id, list_concat(coalesce(o.own, [])[1:h.h::bigint], h.own[h.h::bigint + 1:]) as seq
  from h left join own o on o.conv_id = h.conv_id - h.conv_id % 100),
m as (select conv_id as c, len(seq) as length, d, seq[1:d] as pre, seq[d].t as last from (select conv_id, seq, unnest(range(0, len(seq) + 1)) as d from b)),
n as (select d, pre, min(c) as conv_id, count(*) as n_convs, max(coalesce(length(last), 0)) as size,
  string_agg(c::varchar, ',' order by c) filter (length = d) as ends from m group by d, pre),
mn as (select m.c, m.d, m.length, n.conv_id, n.n_convs, n.size from m join n on m.d = n.d and m.pre = n.pre),
k as (select p.conv_id, p.d, count(*) as n_children from mn x join mn p on p.c = x.c and p.d = x.d - 1 where x.c = x.conv_id group by p.conv_id, p.d),
o as (select mn.c, mn.d, case when mn.d = 0 then 0 else (mn.n_convs - 1) * mn.size end as own, k.n_children is null as leaf
  from mn left join k on k.conv_id = mn.c and k.d = mn.d where mn.c = mn.conv_id),
t as (select mn.conv_id, mn.d, count(*) filter (o.leaf) as n_leaves, coalesce(sum(o.own), 0)::bigint as saved_tokens
  from mn left join o on o.c = mn.c and o.d >= mn.d group by mn.conv_id, mn.d)
select n.conv_id, n.d::bigint as depth, p.conv_id as parent_conv_id, n.n_convs, coalesce(k.n_children, 0) as n_children, t.n_leaves, t.saved_tokens,
  sha256(coalesce(n.ends, '')) as ends_sha256
from n join t on t.conv_id = n.conv_id and t.d = n.d left join k on k.conv_id = n.conv_id and k.d = n.d
left join mn p on p.c = n.conv_id and p.d = n.d - 1""")
def prefix_trie_query(spark: SparkSession, folder: str) -> DataFrame:
    return prefixtrie.prefix_trie(table(spark, folder, "conversations"))


@query("op13_line_rules", rf"""with d as (
  select row_number() over () as r, doc_id, coalesce(text, '') as t from documents),
w as (select *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') as w,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines from d),
c as (select *, list_filter(list_distinct(lines), lambda x: regexp_matches(x, '{linerules.SENTENCE_END.replace("'", "''")}')
    and not regexp_matches(x, '{linerules.NAVIGATION}')
    and 10 * length(regexp_replace(x, '[^{linerules.MARKS[1:-1]}]', '', 'g')) <= length(x)
    and not regexp_matches(x, '{linerules.BOILERPLATE}')) as clean from w),
g as (select r, unnest(range(1, len(w) - 3)) as i, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) as g from w),
f as (select r, i from (select r, i, count(*) over (partition by r, g) as n from g) where n > 1),
q as (select r, sum(least(5, coalesce(following - i, 5)))::bigint as n_repeat_words
  from (select r, i, lead(i) over (partition by r order by i) as following from f) group by r),
x as (select doc_id, len(w) as n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) as word_chars,
  length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as n_symbols, len(lines) - len(list_distinct(lines)) as n_dup_lines,
  coalesce(n_repeat_words, 0) as n_repeat_words, len(lines) as n_lines, len(lines) - len(clean) as n_removed_lines,
  coalesce(list_sum(list_transform(clean, lambda l: length(regexp_replace(l, '[\x20\x09-\x0D]', '', 'g')))), 0)::bigint as kept_chars
  from c left join q using (r)),
y as (select *, n_words < {linerules.MIN_WORDS} or 100 * n_repeat_words > {linerules.MAX_REPEATED} * n_words as base_failed from x)
select *, not base_failed and 100 * (word_chars - kept_chars) <= {linerules.MAX_LOST} * word_chars as kept from y""")
def line_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = linerules.judge_lines(table(spark, folder, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines",
                         "n_removed_lines", "kept_chars")
