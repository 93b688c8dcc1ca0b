"""Queries of this package over the given tables, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from andenlake.llm import (bpe, ffd_packing, langid, line_dedup, lm_score, merkle,
                           merkle_sql, multi_index, packing, quality_cascade, secret_scan, simhash,
                           suffix_dedup, whitening)
from andenlake.llm.shared import documents


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: the documents labelled as of good quality."""
    labels = documents(spark, sf_dir, "labels")
    return lm_score.score(documents(spark, sf_dir), labels.filter("quality = 1"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(documents(spark, sf_dir))


def op3_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = documents(spark, sf_dir, "embeddings")
    return multi_index.search(vectors, vectors.filter(F.col("vec_id") % 20 == 0))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.counted(secret_scan.scan(documents(spark, sf_dir)))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.linked_lines(documents(spark, sf_dir))


def op7_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(suffix_dedup.remove(documents(spark, sf_dir)))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(documents(spark, sf_dir))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_cascade.judge(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.proofs(documents(spark, sf_dir))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(documents(spark, sf_dir, "embeddings"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ffd_packing.pack(documents(spark, sf_dir))


QUERIES = {
    "op1_lm_score": op1_lm_score,
    "op2_language_id": op2_language_id,
    "op3_multi_index": op3_multi_index,
    "op4_simhash": op4_simhash,
    "op5_secret_scan": op5_secret_scan,
    "op6_line_dedup": op6_line_dedup,
    "op7_suffix_array": op7_suffix_array,
    "op8_bpe": op8_bpe,
    "op9_quality_rules": op9_quality_rules,
    "op10_packing": op10_packing,
    "op11_merkle": op11_merkle,
    "op12_whitening": op12_whitening,
    "op13_packing": op13_packing,
}
SQL: dict[str, str] = {
    "op11_merkle": merkle_sql.proofs(),
    "op9_quality_rules": r"""
with d as (
  select doc_id, coalesce(text, '') as text,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                     lambda x: x <> '') as words,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
  from documents),
windows as (
  select doc_id, i, words[i] || chr(1) || words[i + 1] || chr(1) || words[i + 2] as tri
  from (select doc_id, words, unnest(range(1, len(words) - 1)) as i from d)),
again as (
  select doc_id, i from windows
  qualify count(*) over (partition by doc_id, tri) > 1),
covered as (
  select doc_id, count(distinct p) as n_repeat_words
  from (select doc_id, unnest([i, i + 1, i + 2]) as p from again) group by doc_id),
m as (
  select d.doc_id, text, len(words)::bigint as n_words,
         length(array_to_string(words, ''))::bigint as word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
         (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
         coalesce(n_repeat_words, 0)::bigint as n_repeat_words,
         len(lines) as n_lines,
         length(regexp_replace(text, '[^!]', '', 'g')) as marks,
         length(regexp_replace(text, '[^\p{Lu}]', '', 'g')) as capitals,
         length(regexp_replace(text, '[^\p{L}]', '', 'g')) as letters
  from d left join covered using (doc_id)),
b as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not (base_failed or 10 * n_symbols > n_words or 2 * n_dup_lines > n_lines
            or word_chars < 2 * n_words or word_chars > 15 * n_words or 2 * marks > n_words
            or 2 * capitals > letters or 2 * letters < word_chars) as kept
from b""",
    "op6_line_dedup": r"""
with l as (
  select doc_id, i - 1 as line, list_sort(list_distinct(string_split_regex(
           trim(body, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
           '[\x20\x09-\x0D]+'))) as words
  from (select doc_id, unnest(string_split(text, chr(10))) as body,
               generate_subscripts(string_split(text, chr(10)), 1) as i from documents)
  where regexp_matches(body, '[^\x20\x09-\x0D]')),
s as (
  select words, min(struct_pack(doc_id := doc_id, line := line)) as first, len(words) as n,
         row_number() over () as id
  from l group by words),
t as (select id, n, unnest(words) as w from s),
rare as (select w from t group by w having count(*) > 1),
tt as (select * from t semi join rare using (w)),
pairs as (
  select x.id as a, y.id as b from tt x join tt y using (w)
  where x.id <> y.id and 100 * x.n >= 80 * y.n and 100 * y.n >= 80 * x.n
  group by x.id, y.id, x.n, y.n
  having 100 * count(*) >= 80 * (x.n + y.n - count(*))),
low as (
  select a as id, count(*) as links, min(s.first) as low
  from pairs join s on s.id = pairs.b group by a),
k as (
  select first.doc_id as doc_id, first.line as line, coalesce(links, 0) as links,
         low is null or first < low as kept
  from s left join low using (id)),
d as (
  select l.doc_id, count(*) as n_lines,
         count(*) filter (where not coalesce(k.kept, false)) as n_removed,
         string_agg(l.line::varchar, ',' order by l.line)
           filter (where not coalesce(k.kept, false)) as removed,
         coalesce(sum(links), 0)::bigint as n_links
  from l left join k on l.doc_id = k.doc_id and l.line = k.line group by l.doc_id)
select doc_id, coalesce(n_lines, 0) as n_lines, coalesce(n_removed, 0) as n_removed,
       coalesce(removed, '') as removed, coalesce(n_links, 0) as n_links
from documents left join d using (doc_id)""",
}
