"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontaminate, html_extract, language_id, minhash, quality, spotsigs, token_count, token_store, url_filter
from .common import table

#: Vocabulary files; their place is a parameter of the operators.
BYTE_BPE, WORD_BPE = "byte_bpe_50k.json", "word_bpe_49k.json"
#: Behind each document in the token store.
END_ID = 2


#: Stated rules of the URL filter.
RULES = [
    url_filter.Rule("net", "/", url_filter.BLOCK),
    url_filter.Rule("example.net", "/en/", url_filter.ALLOW),
    url_filter.Rule("example.com", "/de/", url_filter.BLOCK),
    url_filter.Rule("org", "/fr/", url_filter.ALLOW),
]


def op1_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words_each=2, percent=80)


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, labels = table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")
    out = url_filter.judge(pages, url_filter.label_by_document(pages, labels), RULES)
    return out.select("page_id", "host", "path", "rule", "verdict", F.col("mined_rule").isNotNull().alias("mined"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "item_ids", F.col("leak_similarity").alias("similarity"), F.col("leak_kept").alias("kept"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = language_id.identify_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages"))
    return out.select("doc_id", "language", "confidence", "declared_language", F.col("language_kept").alias("kept"))


def pages_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = language_id.identify_pages(table(spark, sf_dir, "pages"))
    return out.select("page_id", "language", "confidence", "declared_language", F.col("language_kept").alias("kept"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", F.col("quality_score").alias("score"), F.col("quality_kept").alias("kept"))


def op9_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.store_round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE), end_id=END_ID)


def op10_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.fingerprints(table(spark, sf_dir, "documents"))


def spotsigs_alike(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.alike(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = [op1_html_extract, op2_minhash, op3_url_filter, op4_decontaminate, op5_language_id, op6_bpe, op7_token_counts, op8_quality, op9_token_store, op10_spotsigs, pages_language_id, spotsigs_alike]
    return {f.__name__: f for f in own}


def _stated_sql(value: str) -> str:
    """The longest stated rule that fits, as a CASE over the rules from the longest on."""
    whens = " ".join(f"when (host = '{r.host}' or ends_with(host, '.{r.host}')) and starts_with(path, '{r.path}') then '{r.text if value == 'text' else r.verdict}'" for r in sorted(RULES, key=lambda r: (len(r.text), r.text), reverse=True))
    return f"case {whens} end"


#: Every set of tokens of every labelled URL is counted: what FP-growth finds, by brute force.
URL_SQL = rf"""
with parts as (
    select page_id, url, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{url_filter.UPPER}', '{url_filter.LOWER}') as host, coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path from pages),
words as (
    select *, [['scheme', x] for x in [lower(regexp_extract(coalesce(url, ''), '^([A-Za-z][A-Za-z0-9+.\-]*)://', 1))]] || [['host', x] for x in string_split_regex(host, '[.:]')]
        || [['word', x] for x in string_split_regex(host, '[.:\-]') if contains(host, '-')] || [['path', x] for x in string_split_regex(regexp_replace(lower(path), '\.[a-z0-9]{{1,5}}$', ''), '[/_\-+%.]+')]
        || [['file', regexp_extract(lower(path), '\.([a-z0-9]{{1,5}})$', 1)]] || [['key', string_split(x, '=')[1]] for x in string_split(regexp_extract(coalesce(url, ''), '(?s)\?([^#]*)', 1), '&')]
        || [['fragment', case when contains(coalesce(url, ''), '#') then 'yes' else '' end]] as pairs from parts),
tokens as (select page_id, url, host, path, list_sort(list_distinct([p[1] || ':' || p[2] for p in pairs if p[2] <> '' and not regexp_matches(p[2], '^[0-9]+$')])) as tokens from words),
labelled as (
    select tokens, bad from (select *, try_cast(regexp_extract(path, '.*?([0-9]{{1,18}})[^0-9]*$', 1) as bigint) as label_id from tokens) t
    join (select doc_id, max((quality = 0 or toxic = 1)::int) as bad from labels where doc_id is not null group by doc_id) l on l.doc_id = t.label_id where bad is not null and len(tokens) > 0),
needed as (select ceil(least(1.0, greatest({url_filter.MIN_SUPPORT}, {url_filter.MIN_ROWS} / greatest(1.0, count(*)))) * count(*)) as least from labelled),
counted as (
    select s, count(*) as n, sum(bad) as n_bad from (select bad, unnest([[x for x, i in tokens if (m >> (i - 1)) & 1 = 1] for m in range(1, 1 << len(tokens))]) as s from labelled) a group by s),
rules as (select s from counted, needed where n_bad >= least and n_bad >= {url_filter.MIN_CONFIDENCE} * n)
select page_id, host, path, {_stated_sql('text')} as rule, coalesce({_stated_sql('verdict')}, case when mined then '{url_filter.BLOCK}' else '{url_filter.ALLOW}' end) as verdict, mined
from (select *, exists (select 1 from rules where list_has_all(tokens, s)) as mined from tokens) t
"""


#: Near-duplicates by comparing all pairs that share a shingle; components by walking the links.
NEAR_SQL = rf"""
with recursive words as (select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{url_filter.UPPER}', '{url_filter.LOWER}'), '[\x20\x09-\x0D]+'), lambda w: w <> '') as w from documents),
sets as (select doc_id, list_distinct(case when len(w) >= 2 then [w[i] || ' ' || w[i + 1] for i in range(1, len(w))] else w end) as s from words),
each as (select doc_id, unnest(s) as x from sets),
common as (select a.doc_id as a, b.doc_id as b, count(*) as c from each a join each b on a.x = b.x and a.doc_id <> b.doc_id group by 1, 2),
links as (select a, b from common join sets m on m.doc_id = a join sets n on n.doc_id = b where 100 * c >= 80 * (len(m.s) + len(n.s) - c)),
reached as (select doc_id as id, doc_id as other from sets union select r.id, l.b from reached r join links l on l.a = r.other)
select doc_id, cast(len(s) as bigint) as n_shingles, component_id, doc_id = component_id as kept from sets join (select id, min(other) as component_id from reached group by id) k on k.id = doc_id
"""


def oracle_sql() -> dict[str, str]:
    """SQL for what SQL can say; the other queries are tested against brute force or the tokenizers library."""
    return {"op2_minhash": NEAR_SQL, "op3_url_filter": URL_SQL}
