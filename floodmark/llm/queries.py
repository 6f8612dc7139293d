"""The registered queries of this subpackage and their SQL checks."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from floodmark.llm import (
    bpe, decontaminate, language, near_dedup, paragraphs, personal, prefix_trie, quality, secrets, shards, token_counts, urls, whitening,
)
from floodmark.llm.scratch import Scratch

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLE: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def register(fn):
        LLM_QUERIES[name] = fn
        if sql is not None:
            LLM_ORACLE[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_WORDS = r"""list_filter(string_split_regex(coalesce({text}, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"""

_OP1_SQL = f"""
with recursive w as (
  select doc_id, {_WORDS.format(text="translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} as w
  from documents),
s as (
  select doc_id, case when len(w) = 0 then []::varchar[] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) end as s
  from w),
e as (select doc_id, len(s) as n, unnest(s) as x from s),
l as (
  select a.doc_id as a, b.doc_id as b from e a join e b on a.x = b.x and a.doc_id <> b.doc_id
  group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 85 * (a.n + b.n - count(*))),
r as (select a, b from l union select r.a, l.b from r join l on r.b = l.a),
c as (select a, min(b) as low from r group by a)
select doc_id, len(s)::bigint as n_shingles, least(coalesce(low, doc_id), doc_id) as component_id,
  coalesce(low, doc_id) >= doc_id as kept
from s left join c on c.a = s.doc_id
"""


@_query("op1_minhash_near_dedup", _OP1_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


_OP3_SQL = """
with h as (
  select doc_id, coalesce(strlen(text), 0)::bigint as n_bytes,
    ('0x' || substr(md5(coalesce(doc_id::varchar, '') || ':' || md5(coalesce(text, ''))), 1, 15))::bigint as h
  from documents),
u as (select h, sum(n_bytes)::bigint as bytes from h group by h),
t as (select h, bytes, d, h >> (60 - d) as p from u, range(0, 61) r(d)),
s as (select d, p, sum(bytes)::bigint as shard_bytes, count(*) as n from t group by d, p),
f as (
  select t.h, min(t.d) as d from t join s using (d, p)
  where shard_bytes <= 1000000 or n = 1 or t.d = 60 group by t.h),
r as (select *, row_number() over (partition by doc_id, h) - 1 as i from h)
select doc_id, n_bytes, case when f.d = 0 then '' else lpad(bin(r.h >> (60 - f.d)), f.d::int, '0') end as shard,
  f.d::int as depth,
  case when shard_bytes > 1000000 then i // greatest(1, 1000000 // greatest(n_bytes, 1)) else 0 end::bigint as part,
  shard_bytes
from r join f on f.h = r.h join s on s.d = f.d and s.p = r.h >> (60 - f.d)
"""


_EITHER = "|".join(
    "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in name) for name in ("password", "passwd", "secret", "token", "api_?key")
)
_ASSIGN_SQL = """({names})["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)""".replace("\\\\", "\\").format(names=_EITHER)


def _spans_sql(kind: str, rank: int, pattern: str, test: str) -> str:
    """Matches of a pattern with their places; `test` on the match m."""
    return f"""
select doc_id, {rank} as rank, '{kind}' as kind, m, s, s + length(m) as e from (
  select doc_id, f[i] as m,
    (list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(f[1:i-1], lambda x: length(x))), 0))::bigint as s
  from (select doc_id, f, g, unnest(range(1, len(f) + 1)) as i from (
    select doc_id, regexp_extract_all(text, '{pattern}') as f, string_split_regex(text, '{pattern}') as g
    from (select doc_id, coalesce(text, '') as text from documents) t) x) y) z
where {test}"""


_ALLOWED_SQL = " and ".join(f"not regexp_matches(m, '{p}')" for p in (
    "^[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$", "^sha(1|256|384|512)-", "EXAMPLE", "^(0123456789|1234567890)"))
_OP2_SQL = f"""
with base as ({_spans_sql("assign", 1, _ASSIGN_SQL, f"length(regexp_extract(m, '{_ASSIGN_SQL}', 2)) >= 6")}
  union all {_spans_sql("access", 2, "AKIA[A-Z0-9]+", "length(m) >= 20")}
  union all {_spans_sql("hex", 3, "[0-9a-f]+", "length(m) >= 24")}),
runs as (
  select r.* from ({_spans_sql("entropy", 4, "[A-Za-z0-9+/_=-]+", "length(m) >= 20")}) r
  where {_ALLOWED_SQL} and len(list_distinct(string_split(m, ''))) > 1),
ends as (
  select r.doc_id, r.s as rs, r.m, b.s, b.e from runs r join base b on b.doc_id = r.doc_id and b.s < r.e and r.s < b.e
  union all select doc_id, s, m, e, e from runs),
gaps as (
  select doc_id, rs, m, s as e,
    coalesce(max(e) over (partition by doc_id, rs order by s, e rows between unbounded preceding and 1 preceding), rs) as s from ends),
open as (select doc_id, 4 as rank, 'entropy' as kind, s, e, substr(m, (s - rs + 1)::bigint, (e - s)::bigint) as m from gaps where e - s >= 20),
parts as (select *, unnest(range(1, length(m) - 18)) as j from open),
counts as (
  select doc_id, s, j, c, count(*) as n from (select doc_id, s, j, unnest(string_split(substr(m, j, 20), '')) as c from parts) x group by all),
bits as (
  select doc_id, s, max(h) as h from (select doc_id, s, j, -sum(n / 20 * log2(n / 20)) as h from counts group by all) x group by doc_id, s),
spans as (
  select doc_id, rank, kind, s, e from base union all
  select doc_id, rank, kind, s, e from open join bits using (doc_id, s)
  where round(h, 9) >= case {" ".join(f"when regexp_matches(m, '{p}') then {b}" for p, b in secrets.CLASSES.items())} end),
listed as (
  select doc_id, count(*) filter (where rank = 1) as n_assign, count(*) filter (where rank = 2) as n_access, count(*) filter (where rank = 3) as n_hex,
    string_agg(kind || ':' || s || ':' || e, ',' order by s, rank) filter (where rank < 4) as base,
    string_agg(kind || ':' || s || ':' || e, ',' order by s, rank) as spans
  from spans group by doc_id)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
  sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from documents left join listed using (doc_id)
"""


@_query("op2_secret_scan", _OP2_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.find_secrets(table(spark, sf_dir, "documents")))


@_query("op3_extendible_sharding", _OP3_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.assign_shards(table(spark, sf_dir, "documents"))


@_query("op4_substring_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraphs.repeated_paragraphs(table(spark, sf_dir, "documents"))


@_query("op5_language_id")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


@_query("op6_url_filter")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages"))


@_query("op7_pii")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.digest(personal.find_personal_data(table(spark, sf_dir, "documents")))


RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@_query("op8_byte_level_bpe")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN, arrays=False)


@_query("op9_benchmark_decontamination")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_OP10_SQL = f"""
with w as (
  select doc_id, source, {_WORDS.format(text="text")} as w, coalesce(text, '') as text,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as lines
  from documents),
p as (select doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as x from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from w) a),
q as (select doc_id, i, count(*) over (partition by doc_id, x) as n from p),
r as (select doc_id, count(distinct k) as n from (select doc_id, unnest([i, i + 1, i + 2]) as k from q where n > 1) a group by doc_id),
m as (
  select w.doc_id, source, len(w)::bigint as n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols, (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
    coalesce(r.n, 0)::bigint as n_repeat_words
  from w left join r using (doc_id)),
f as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from m),
h as (select source, count(*) as d, count(*) filter (where base_failed) as b from f group by source),
v as (select avg(b / d) as m, var_pop(b / d) as v from h),
s as (select m, greatest(1, least(1000, coalesce(m * (1 - m) / nullif(v, 0) - 1, 1000))) as s from v),
g as (select source, (b + m * s) / (d + s) as rate from h, s)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, round(rate, 9) as host_rate,
  not base_failed and rate <= 0.8 as kept
from f join g on f.source is not distinct from g.source
"""


@_query("op10_quality_rules", _OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Rounded, as the last digits depend on the order of sums.
    rows = quality.quality_rules(table(spark, sf_dir, "documents"))
    return rows.withColumn("host_rate", F.round("host_rate", 9))


_CRC_SQL = """list_reduce(list_concat([4294967295::bigint], flatten(list_transform(string_split(conv_id::varchar, ''),
  lambda c: list_transform(range(8), lambda b: (ord(c)::bigint >> b) & 1)))),
  lambda a, b: xor(a >> 1, xor(a & 1, b) * 3988292384::bigint))"""
_OP11_SQL = f"""
with t as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text,
    sha256(strlen(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, '')) as x
  from conversations where conv_id is not null),
o as (
  select conv_id, x, len({_WORDS.format(text="text")})::bigint as words,
    row_number() over (partition by conv_id order by turn nulls first, role, x) as p
  from t),
h as (select conv_id, 3 - {_CRC_SQL} % 4 as h from (select distinct conv_id from t) x),
r as (
  select h.conv_id, p, x, words from h join o on o.conv_id = h.conv_id - h.conv_id % 20 and p <= h
  union all select conv_id, p, x, words from h join o using (conv_id) where p > h),
d as (select conv_id, x, words, row_number() over (partition by conv_id order by p) as d from r),
k as (
  select conv_id, d, words,
    sha256(string_agg(x, '' order by d) over (partition by conv_id order by d rows between unbounded preceding and current row)) as node
  from d),
a as (
  select conv_id, d, words, node, coalesce(lag(node) over (partition by conv_id order by d), '') as parent from k
  union all select conv_id, 0, 0, '', null from h),
n as (select node, d as depth, min(conv_id) as conv_id, min(parent) as parent, count(*) as n, min(words) as words from a group by node, d),
c as (select parent as node, count(*) as children from n where parent is not null group by parent),
v as (select n.*, coalesce(children, 0) as children from n left join c using (node)),
s as (
  select a.node, count(*) filter (where v.children = 0) as leaves, sum((v.n - 1) * v.words)::bigint as saved
  from v join a on a.conv_id = v.conv_id and a.d <= v.depth group by a.node),
l as (select conv_id, arg_max(node, d) as node from a group by conv_id),
e as (select node, sha256(string_agg(conv_id::varchar, ',' order by conv_id)) as ends from l group by node)
select v.conv_id, v.depth, p.conv_id as parent_conv_id, v.n as n_convs, v.children as n_children, leaves as n_leaves,
  saved as saved_tokens, coalesce(ends, sha256('')) as ends_sha256
from v join s using (node) left join e using (node) left join v p on p.node = v.parent
"""


@_query("op11_conversation_prefix_trie", _OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = prefix_trie.turn_records(table(spark, sf_dir, "conversations"))
    return prefix_trie.prefix_trie(prefix_trie.with_shared_heads(records))


@_query("op12_embedding_whitening")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return rows.withColumn("deviation", F.col("deviation").cast("long"))


@_query("op13_token_counts")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A cache of this run alone: every distinct text is a miss, encoded once and stored.
    scratch = Scratch(spark)
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), path, f"{scratch.base}/token_counts", scratch=scratch)
