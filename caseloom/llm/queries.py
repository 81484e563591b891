"""The operators on the test tables: name -> query, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.llm import (
    bpe, chat, collocations, html_text, hyperminhash, lexical_scan, licences, packing, quality_rules, resampling, suffix_dedup, topk, warc,
)
from caseloom.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
VOCABULARY = "word_bpe_49k.json"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages"))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(table(spark, sf_dir, "pages"))


def op3_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_licences(table(spark, sf_dir, "documents"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest_documents(table(spark, sf_dir, "documents"), vocabulary_path())


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(table(spark, sf_dir, "documents"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary_path())


def op8_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyperminhash.near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85)


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op10_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_lexical_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_scan.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def op12_chat_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat.digest(chat.format_conversations(turns.unionByName(own)))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), longest=3, least=10, percent=50, top=2000)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_warc, op2_html_text, op3_licences, op4_bpe, op5_quality_rules, op6_suffix_dedup, op7_packing, op8_hyperminhash,
        op9_topk, op10_resampling, op11_lexical_scan, op12_chat_template, op13_collocations, pipeline,
    )
}

SQL: dict[str, str] = {
    "op8_hyperminhash": """
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') as w
  from documents),
shingles as (
  select distinct doc_id, case when len(w) >= 3 then w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] else array_to_string(w, ' ') end as s
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) as i from words where len(w) > 0)),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
common as (
  select a.doc_id as a, b.doc_id as b, count(*) as c
  from shingles a join shingles b on a.s = b.s and a.doc_id > b.doc_id group by 1, 2),
links as (
  select a, b from common join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * c >= 85 * (x.n + y.n - c)),
sides as (select a, b from links union all select b, a from links),
reach(a, b) as (select a, b from sides union select r.a, s.b from reach r join sides s on r.b = s.a),
least as (select a, min(b) as b from reach group by a)
select d.doc_id, coalesce(n, 0)::bigint as n_shingles, least(d.doc_id, coalesce(l.b, d.doc_id)) as component_id,
       d.doc_id <= coalesce(l.b, d.doc_id) as kept
from documents d left join sizes z on z.doc_id = d.doc_id left join least l on l.a = d.doc_id""",
    "op9_topk": """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as v
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
scored as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
  from v q join v c on q.vec_id % 20 = 0 and q.vec_id <> c.vec_id),
ranked as (
  select query_id, row_number() over (partition by query_id order by score desc, vec_id)::integer as "rank", vec_id, score from scored)
select query_id, "rank", vec_id, score from ranked where "rank" <= 20""",
    "op11_lexical_scan": """
with terms as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as t
  from documents),
wanted as (
  select distinct item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term
  from benchmark),
totals as (select count(*) filter (len(t) > 0)::bigint as n, sum(len(t))::bigint as l from terms),
sizes as (select doc_id, 10 + (90 * len(t) * totals.n) // l as m from terms, totals where len(t) > 0),
tf as (
  select doc_id, term, count(*) as tf from (select doc_id, unnest(t) as term from terms) where term in (select term from wanted) group by all),
weights as (
  select term, floor(1000 * ln((2 * n + 2)::double / (2 * count(*) + 1)::double))::bigint as w from tf, totals group by term, n),
scored as (
  select item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::bigint as score
  from wanted join tf using (term) join weights using (term) join sizes using (doc_id) group by all),
ranked as (
  select item_id, row_number() over (partition by item_id order by score desc, doc_id)::integer as "rank", doc_id, score
  from scored where score > 0)
select item_id, "rank", doc_id, score from ranked where "rank" <= 10""",
    "op12_chat_template": """
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
guarded as (
  select *, length(replace(replace(replace(replace(replace(replace(replace(replace(replace(text, '\\', '\\\\'),
    '<s>', '<\\s>'), '</s>', '<\\/s>'), '[INST]', '[\\INST]'), '[/INST]', '[\\/INST]'), '<<SYS>>', '<\\<SYS>>'),
    '<</SYS>>', '<\\</SYS>>'), '<|role|>', '<\\|role|>'), '<|text|>', '<\\|text|>')) as size
  from turns)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  sum(size + case role when 'user' then 18 when 'assistant' then 7 when 'system' then 18 else 23 + length(role) end)::bigint
    as formatted_chars
from guarded group by conv_id""",
    "op13_collocations": """
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) as piece
  from documents),
words as (select lang, regexp_extract_all(piece, '[^\\x20\\x09]+') as w from pieces),
totals as (select lang, sum(len(w))::bigint as n from words group by lang),
places as (select lang, k, w, unnest(range(1, len(w) - k + 2)) as i from words, (values (1), (2), (3)) s(k) where len(w) >= k),
phrases as materialized (
  select lang, k, array_to_string(w[i : i + k - 1], ' ') as phrase, count(*) as f from places group by all),
candidates as materialized (select lang, k, phrase, f as a, string_split(phrase, ' ') as w from phrases where k > 1 and f >= 10),
cuts as materialized (
  select c.lang, c.k, c.phrase, c.a, c.c, x.f as l, y.f as r, (1000000::hugeint * c.a * c.a) // (x.f::hugeint * y.f) as score
  from (
    select *, array_to_string(w[1 : c], ' ') as x, array_to_string(w[c + 1 : k], ' ') as y
    from (select *, unnest(range(1, k)) as c from candidates)) c
  join phrases x on x.lang = c.lang and x.phrase = c.x
  join phrases y on y.lang = c.lang and y.phrase = c.y),
weakest as (select * from cuts qualify row_number() over (partition by lang, k, phrase order by score, c) = 1),
longer as (
  select lang, array_to_string(w[i : i + 1], ' ') as phrase, max(a) as longer
  from (select *, unnest([1, 2]) as i from candidates where k = 3) group by all),
kept as (
  select w.* from weakest w left join longer g on w.k = 2 and g.lang = w.lang and g.phrase = w.phrase
  where g.longer is null or 100 * g.longer < 50 * w.a),
ranked as (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase) as "rank" from kept)
select lang, "rank", phrase, a::bigint as a, l::bigint as l, r::bigint as r, n, score::bigint as score
from ranked join totals using (lang) where "rank" <= 2000""",
}
