"""The registered queries of the subpackage, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.chat import CONVERSATION_SCHEMAS, SCHEMA_COLUMNS, link_tool_calls, messages_as_calls
from tidemark.llm.decontaminate import benchmark_leaks
from tidemark.llm.gif import encode_gifs, gif_features
from tidemark.llm.hard_negatives import mine_hard_negatives, quantised
from tidemark.llm.lm import lm_scores
from tidemark.llm.near_dup import near_duplicates
from tidemark.llm.packing import pack
from tidemark.llm.prefix_trie import spliced_trie
from tidemark.llm.repeats import repeated_bytes
from tidemark.llm.token_store import token_file_round_trip
from tidemark.llm.toxicity import learn_toxicity, score_toxicity
from tidemark.llm.urls import judge_urls
from tidemark.llm.warc import warc_round_trip

#: From this score on a document counts as toxic.
TOXIC = 0.3


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents on two-word shingles."""
    return near_duplicates(_table(spark, sf_dir, "documents"), width=2, percent=80)


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items, with the items."""
    return benchmark_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated 100-byte strings removed from all documents."""
    return repeated_bytes(_table(spark, sf_dir, "documents"), length=100)


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on the URLs of all pages."""
    return judge_urls(_table(spark, sf_dir, "pages"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' tokens, written to binary files and read back."""
    return token_file_round_trip(_table(spark, sf_dir, "documents"), tokenizer="word_bpe_49k.json", end_id=2)


def op6_gif_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All texts as GIF columns, decoded again, with colour features."""
    return gif_features(encode_gifs(_table(spark, sf_dir, "documents"))).drop("frames", "error")


def op7_tool_call_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations as linked, ordered and validated tool calls."""
    calls, results = messages_as_calls(_table(spark, sf_dir, "conversations"))
    return link_tool_calls(calls, results, spark.createDataFrame(CONVERSATION_SCHEMAS, SCHEMA_COLUMNS))


def op8_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    return pack(_table(spark, sf_dir, "documents"), tokenizer="byte_bpe_50k.json", end_id=0, capacity=2048)


def op9_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents; those with crc32(doc_id) mod 4 = 2 are held out."""
    docs = _table(spark, sf_dir, "documents")
    model = learn_toxicity(docs, _table(spark, sf_dir, "labels"), folds=4, test=2)
    found = score_toxicity(docs, model)
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    return found.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= TOXIC).cast("int").alias("predicted"), "passages")


def op10_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model scores of all documents; those with crc32(doc_id) mod 7 = 2 are held out."""
    return lm_scores(_table(spark, sf_dir, "documents"), folds=7, test=2)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all conversations, rebuilt on the openings that five of them share."""
    return spliced_trie(_table(spark, sf_dir, "conversations")).drop("digest")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives for the positives of all vectors whose id is divisible by 100."""
    return mine_hard_negatives(quantised(_table(spark, sf_dir, "embeddings")))


def op13_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as WARC transactions, written and read back."""
    return warc_round_trip(_table(spark, sf_dir, "pages")).drop("record_id", "uri", "error")


LOWER_SQL = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS_SQL = f"regexp_extract_all({LOWER_SQL.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+')"

OP1_SQL = f"""
with recursive w as (select doc_id, {WORDS_SQL} as ws from documents),
s as (select distinct doc_id, unnest(case when len(ws) = 0 then [] when len(ws) < 2 then [ws] else [ws[i:i+1] for i in range(1, len(ws))] end) as g from w),
n as (select w.doc_id, count(s.g) as k from w left join s using (doc_id) group by 1),
c as (select a.doc_id as x, b.doc_id as y, count(*) as k from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
l as (select x, y from c join n p on p.doc_id = x join n q on q.doc_id = y where 100 * c.k >= 80 * (p.k + q.k - c.k)),
e as (select x as u, y as v from l union select y, x from l),
r(u, v) as (select doc_id, doc_id from documents union select r.u, e.v from r join e on r.v = e.u)
select n.doc_id, cast(n.k as bigint) as n_shingles, min(r.v) as component_id, n.doc_id = min(r.v) as kept
from n join r on r.u = n.doc_id group by n.doc_id, n.k
"""

OP7_SQL = """
with t as (select conv_id, turn, role, text, 'c' || conv_id || '-' || turn as id from conversations),
c as (select conv_id, turn, id as call_id, case role when 'user' then 'respond' else 'configure' end as tool, text,
             case when turn > 0 then 'c' || conv_id || '-' || greatest(0, turn - 2) end as parent from t where role in ('user', 'system')),
r as (select conv_id, 'c' || conv_id || '-' || (turn - 1) as call_id, arg_min(text, turn) as content, count(*) as n_results from t where role = 'assistant' group by 1, 2),
lv as (with recursive v(conv_id, call_id, level) as (
    select conv_id, call_id, 0 from c where parent is null or parent not in (select call_id from c)
    union all select c.conv_id, c.call_id, v.level + 1 from v join c on c.conv_id = v.conv_id and c.parent = v.call_id) select * from v),
e as (select conv_id, call_id, list_sort(list_filter([
    case when length(text) < 1 or (tool = 'respond' and length(text) > 300) then 'text out of bounds' end,
    case when tool = 'configure' and turn > 0 then 'turn out of bounds' end], lambda x: x is not null)) as errors from c)
select c.conv_id, c.call_id, c.tool, cast(lv.level as bigint) as level, case when r.call_id is null then 'missing' else 'linked' end as status,
       cast(coalesce(n_results, 0) as bigint) as n_results, len(errors) = 0 as valid, array_to_string(errors, '; ') as errors,
       '{"arguments":{"text":' || to_json(text) || ',"turn":' || turn || '},"id":' || to_json(c.call_id) || case when r.call_id is null then '' else ',"result":' || to_json(content) end || ',"tool":' || to_json(c.tool) || '}' as record
from c join lv using (conv_id, call_id) join e using (conv_id, call_id) left join r using (conv_id, call_id)
union all
select r.conv_id, r.call_id, null, null, 'orphan', cast(n_results as bigint), false, 'no call', '{"id":' || to_json(r.call_id) || ',"result":' || to_json(content) || '}'
from r anti join c using (conv_id, call_id)
"""

CRC32_SQL = """xor(list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(range(1, length({0}) + 1), lambda i: list_concat([ascii({0}[i:i])::bigint], [-1, -1, -1, -1, -1, -1, -1, -1]::bigint[])))),
    lambda x, y: case when y >= 0 then xor(x, y) else xor(x >> 1, (x & 1) * 3988292384) end), 4294967295::bigint)"""

OP11_SQL = f"""
with o as (select conv_id, role, text, row_number() over (partition by conv_id order by turn nulls first, sha256(strlen(role) || ':' || role || text)) as pos
      from (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null)),
c as (select conv_id, conv_id - conv_id % 5 as base, {CRC32_SQL.format("s")} % 9 as h from (select distinct conv_id, conv_id::varchar as s from o)),
b as (select c.conv_id, 0 as part, o.pos, o.role, o.text from c join o on o.conv_id = c.base and o.pos <= c.h
      union all select c.conv_id, 1, o.pos, o.role, o.text from c join o on o.conv_id = c.conv_id and o.pos > c.h),
r as (select conv_id, row_number() over (partition by conv_id order by part, pos) as d, list({{'r': role, 't': text}}) over (partition by conv_id order by part, pos rows between unbounded preceding and current row) as k,
             strlen(text) as n from b),
p as (select conv_id, d, sha256(k::varchar) as k, n from r union all select conv_id, 0, 'root', 0 from c),
m as (select k, d as depth, min(conv_id) as conv_id, count(*) as n_convs, (count(*) - 1) * any_value(n) as saved from p group by k, d),
u as (select m.k, q.k as up from m join p as q on q.conv_id = m.conv_id and q.d = m.depth - 1),
ch as (select up as k, count(*) as n_children from u group by up),
s as (select a.k, sum(case when ch.k is null then 1 else 0 end) as n_leaves, sum(m.saved) as saved_tokens
      from m left join ch on ch.k = m.k join p as a on a.conv_id = m.conv_id and a.d <= m.depth group by a.k),
l as (select conv_id, max(d) as d from p group by conv_id),
e as (select p.k, sha256(string_agg(p.conv_id::varchar, ',' order by p.conv_id)) as ends from p join l using (conv_id, d) group by p.k)
select m.conv_id, m.depth::bigint as depth, v.conv_id as parent_conv_id, m.n_convs, coalesce(ch.n_children, 0)::bigint as n_children,
       s.n_leaves::bigint as n_leaves, s.saved_tokens::bigint as saved_tokens, coalesce(e.ends, sha256('')) as ends_sha256
from m join s using (k) left join u using (k) left join m as v on v.k = u.up left join ch on ch.k = m.k left join e on e.k = m.k
"""

OP12_SQL = """
with r as materialized (select row_number() over () as n, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                  list_transform(embedding, lambda x: floor(256 * x::double)) as v
           from embeddings where vec_id is not null and label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.n as a, b.n as b, a.vec_id as anchor_id, b.vec_id, a.label = b.label as same, list_inner_product(a.v, b.v)::bigint as score
      from r as a join r as b on a.n <> b.n where a.vec_id % 100 = 0),
p as (select * from s where same qualify row_number() over (partition by a order by score desc, vec_id) <= 5)
select p.anchor_id, p.vec_id as positive_id, row_number() over (partition by p.a, p.b order by s.score desc, s.vec_id)::int as rank, s.vec_id as negative_id,
       p.score as positive_score, s.score as negative_score
from p join s on s.a = p.a and not s.same and 80 * p.score <= 100 * s.score and s.score <= p.score
qualify row_number() over (partition by p.a, p.b order by s.score desc, s.vec_id) <= 5
"""

OP13_SQL = """
with p as (select page_id, strlen(coalesce(html, ''))::bigint as n, coalesce(html, '') as body, sha1(coalesce(html, '')) as h from pages),
m as (select n, body, max(page_id) as top from p group by n, body)
select p.page_id, p.n as payload_bytes, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           ((('0x' || substr(h, 5 * (i // 4) + 1, 5))::int >> (15 - 5 * (i % 4)))::int & 31) + 1, 1)), '') as payload_digest,
       case when p.page_id = m.top then 'response' else 'revisit' end as record_type, case when p.page_id <> m.top then m.top end as refers_to
from p join m using (n, body)
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_minhash_near_dedup, op2_benchmark_decontamination, op3_suffix_array_dedup, op4_url_filter, op5_token_files, op6_gif_media, op7_tool_call_linking,
        op8_pattern_packing, op9_toxic_segments, op10_deleted_interpolation, op11_prefix_trie, op12_hard_negatives, op13_warc_transactions
    )
}

ORACLE_SQL: dict[str, str] = {
    "op1_minhash_near_dedup": OP1_SQL,
    "op7_tool_call_linking": OP7_SQL,
    "op11_prefix_trie": OP11_SQL,
    "op12_hard_negatives": OP12_SQL,
    "op13_warc_transactions": OP13_SQL,
}
