"""The registered queries of this subpackage: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from knockwork.llm import bytebpe, decontam, fixity, htmlwrap, langid, quality, simhash, substr, tokencount, toxicity

#: Vocabulary and limit of the token counts.
WORD_BPE = "word_bpe_49k.json"
TOKEN_LIMIT = 2048
#: Ranks of the byte-level encoding.
BYTE_BPE = "byte_bpe_50k.tiktoken"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE), TOKEN_LIMIT)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmlwrap.main_text(_table(spark, sf_dir, "pages"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substr.digests(_table(spark, sf_dir, "documents"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.judge(_table(spark, sf_dir, "documents"))


def op8_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a WARC record, audited against a replica in which each page whose id is divisible by 97 has a byte changed."""
    pages = _table(spark, sf_dir, "pages")
    replica = pages.withColumn("html", F.when(F.col("page_id") % 97 == 0, F.overlay("html", F.lit("x"), F.lit(1))).otherwise(F.col("html")))
    return fixity.compare_archives(fixity.archive(pages), fixity.archive(replica)).withColumnRenamed("key", "page_id")


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bytebpe.encode_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), public_tokenizers.PATTERN, runs=bytebpe.RUNS)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_token_counts": op2_token_counts,
    "op3_decontamination": op3_decontamination,
    "op4_html_text": op4_html_text,
    "op5_simhash": op5_simhash,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_language": op7_language,
    "op8_warc_fixity": op8_warc_fixity,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_toxicity": op10_toxicity,
}

ORACLE_SQL: dict[str, str] = {
    "op1_quality_rules": r"""
with d as (select row_number() over () as rid, doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
c as (select *, len(ws) as n, length(array_to_string(ws, '')) as chars, length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as symbols,
  string_split(t, chr(10)) as lines, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as said from d),
triples as (select rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] as k from (select rid, ws, unnest(range(1, n - 1)) as i from c)),
again as (select rid, i from (select *, count(*) over (partition by rid, k) as times from triples) where times > 1),
covered as (select rid, count(distinct p) as n_repeat from (select rid, unnest([i, i + 1, i + 2]) as p from again) group by 1),
f as (select c.*, coalesce(n_repeat, 0) as n_repeat, len(said) - len(list_distinct(said)) as dup, n < 50 or 100 * coalesce(n_repeat, 0) > 50 * n as failed from c left join covered using (rid))
select doc_id, n::bigint as n_words, chars::bigint as word_chars, symbols::bigint as n_symbols, dup::bigint as n_dup_lines, n_repeat::bigint as n_repeat_words, failed as base_failed,
  not (failed or symbols > n or chars < 2 * n or chars > 20 * n or list_max(list_transform(ws, lambda x: length(x))) > 2000
    or 2 * length(regexp_replace(t, '[^\p{L}]', '', 'g')) < chars or 2 * dup > len(lines)
    or 2 * len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)$'))) > len(lines)
    or 10 * len(list_filter(lines, lambda x: regexp_matches(x, '^[ \t]*[-*•]'))) > 9 * len(lines)
    or (n >= 200 and 20 * len(list_distinct(ws)) < n)) as kept
from f
""",
    "op3_decontamination": r"""
with b as (select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from benchmark),
w as (select distinct item_id, array_to_string(ws[i : i + 12], ' ') as k, least(13, len(ws)) as size from (select item_id, ws, unnest(range(1, greatest(len(ws) - 11, 2))) as i from b where len(ws) > 0)),
d as (select row_number() over () as rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from documents),
p as (select rid, i, size, array_to_string(ws[i : i + size - 1], ' ') as k from (select rid, ws, size, unnest(range(1, len(ws) - size + 2)) as i from d, (select distinct size from w))),
m as (select distinct rid, i, size, item_id from p join w using (k, size)),
h as (select rid, count(distinct pos) as n_hit from (select rid, unnest(range(i, i + size)) as pos from m) group by 1),
t as (select rid, count(distinct item_id) as n_items, array_to_string(list_sort(list(distinct item_id::varchar)), ',') as items from m group by 1),
freq as (select word, count(*) as n from (select unnest(ws) as word from d) group by 1),
one as (select distinct k, string_split(k, ' ') as wl from w),
places as (select k, word, coalesce(n, 0) * 100 + off as rarity from (select k, unnest(wl) as word, unnest(range(1, len(wl) + 1)) as off from one) left join freq using (word)),
rarest as (select k, arg_min(word, rarity) as w1 from places group by 1),
second as (select k, arg_min(word, rarity) as w2 from places join rarest using (k) where word <> w1 group by 1),
q as (select k, w1, coalesce(w2, w1) as w2, list_distinct(wl) as kinds from rarest left join second using (k) join one using (k)),
near as (select rid, ws[i] as w1, ws[greatest(1, i - 12) : i + 12] as around from (select rid, ws, unnest(range(1, len(ws) + 1)) as i from d) where ws[i] in (select w1 from rarest)),
close as (select distinct rid, k from near join q using (w1) where list_contains(around, w2) and len(list_intersect(list_distinct(around), kinds)) >= 0.8 * len(kinds)),
found as (select rid, count(distinct item_id) as n_near from (select rid, item_id from m union all select rid, item_id from close join w using (k)) group by 1)
select doc_id, len(ws)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(items, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(ws) as contaminated, coalesce(n_near, 0)::bigint as n_near
from d left join h using (rid) left join t using (rid) left join found using (rid)
""",
    "op6_substring_dedup": r"""
with d as (select row_number() over () as rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
p as (select rid, doc_id, i, md5(array_to_string(ws[i : i + 49], ' ')) as k from (select rid, doc_id, ws, unnest(range(1, len(ws) - 48)) as i from d)),
r as (select rid, i from (select *, min(doc_id) over (partition by k) as least_id from p) where doc_id > least_id),
gone as (select distinct rid, unnest(range(i, i + 50)) as pos from r),
words as (select rid, unnest(range(1, len(ws) + 1)) as pos, unnest(ws) as word from d),
kept as (select rid, string_agg(word, ' ' order by pos) as said from words anti join gone using (rid, pos) group by 1),
n as (select rid, count(*) as n_removed from gone group by 1)
select doc_id, len(ws)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed, sha256(coalesce(said, '')) as kept_sha256
from d left join kept using (rid) left join n using (rid)
""",
    "op8_warc_fixity": r"""
with written as (
  select distinct page_id, floor(page_id / 1024.0)::bigint as segment,
    'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10)
    || 'WARC-Record-ID: <urn:record:' || page_id || '>' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10)
    || 'Content-Type: text/html; charset=utf-8' || chr(13) || chr(10) || 'Content-Length: ' || strlen(coalesce(html, ''))
    || chr(13) || chr(10) || chr(13) || chr(10) || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) as record,
    coalesce(page_id % 97 = 0 and length(html) > 0 and html[1] <> 'x', false) as damaged
  from pages
), hashed as (select page_id, segment, strlen(record)::bigint as n_bytes, sha256(record) as sha256, damaged from written)
select segment, row_number() over w - 1 as record_no, page_id,
  coalesce(sum(n_bytes) over (partition by segment order by page_id, sha256 rows between unbounded preceding and 1 preceding), 0)::bigint as "offset",
  n_bytes, sha256, damaged, false as moved
from hashed window w as (partition by segment order by page_id, sha256)
""",
}
