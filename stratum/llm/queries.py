"""Registered queries of the training-data operators, and DuckDB SQL where SQL
can express them on whole tables. Each query derives the digest columns of its
contract from its operator's rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline

from . import (collocations, decontaminate, html_wrappers, language_id, licenses, order_minhash, packing,
               pii, projected_search, repeats, url_filter, vector_forest, whitening)

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

# Fixed values of the contract: (host, path, verdict).
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
             ("org", "/fr/", "allow")]


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        REGISTRY[name] = fn
        if sql:
            ORACLE_SQL[name] = sql
        return fn
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@query("op1_html_wrappers")
def op1(spark, sf_dir):
    return html_wrappers.extract_main_text(table(spark, sf_dir, "pages"))


@query("op2_order_minhash")
def op2(spark, sf_dir):
    return order_minhash.class_of_documents(table(spark, sf_dir, "documents"))


@query("op3_language_id")
def op3(spark, sf_dir):
    found = language_id.identify(language_id.evidence_of_pages(table(spark, sf_dir, "pages")))
    return found.withColumnRenamed("id", "page_id")


@query("op4_pack_karmarkar_karp")
def op4(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"))


# Pairs are compared one by one, which whole vector tables of some thousand rows allow.
_LINKS_SQL = r"""
with recursive sound as (
  select row_number() over () as r, vec_id, label, list_transform(embedding, lambda x: cast(x as double)) as v
  from embeddings
  where vec_id is not null and label is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as (
  select a.r as a, b.r as b, a.vec_id as x, b.vec_id as y
  from sound a join sound b on a.label = b.label and a.r <> b.r and len(a.v) = len(b.v)
  where list_inner_product(a.v, b.v) / sqrt(list_inner_product(a.v, a.v) * list_inner_product(b.v, b.v)) >= 0.93),
reach(r, low) as (
  select r, vec_id from sound
  union
  select l.a, reach.low from links l join reach on reach.r = l.b),
found as (
  select s.vec_id, (select count(*) from links where links.a = s.r) as n_links, (select min(low) from reach where reach.r = s.r) as component_id
  from sound s
  union all
  select vec_id, 0, vec_id from embeddings e
  where not coalesce(vec_id is not null and label is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0, false))
select vec_id, n_links, component_id, coalesce(vec_id = component_id, true) as kept from found
"""


@query("op5_vector_forest", _LINKS_SQL)
def op5(spark, sf_dir):
    return vector_forest.link_vectors(table(spark, sf_dir, "embeddings"))


@query("op6_license_scan")
def op6(spark, sf_dir):
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


_URL_SQL = """
with parts as (
  select page_id,
    translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), ''),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') as path
  from pages),
rules(h, p, verdict) as (values ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                                ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
fits as (
  select parts.*, h || p as rule, verdict,
    row_number() over (partition by page_id, host, path order by length(h || p) desc, length(h) desc) as n
  from parts left join rules on (host = h or ends_with(host, '.' || h)) and starts_with(path, p))
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from fits where n = 1
"""


@query("op7_personal_data")
def op7(spark, sf_dir):
    return pii.find_personal_data(table(spark, sf_dir, "documents"))


@query("op8_url_filter", _URL_SQL)
def op8(spark, sf_dir):
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), rules)


_WORDS = ("regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')")
_CONTAMINATION_SQL = f"""
with items as (
  select item_id, words, len(words) as n from (select item_id, {_WORDS.format('text')} as words from benchmark)
  where len(words) > 0),
windows as (
  select distinct item_id, least(n, 13) as size, words[i:i + least(n, 13) - 1] as w
  from (select *, unnest(range(1, n - least(n, 13) + 2)) as i from items)),
docs as (select doc_id, coalesce({_WORDS.format('text')}, []) as words from documents),
sizes as (select distinct size from windows),
spans as (
  select doc_id, i, size, words[i:i + size - 1] as w
  from (select doc_id, words, size, unnest(range(1, len(words) - size + 2)) as i from docs, sizes)),
found as (select doc_id, i, spans.size, item_id from spans join windows on spans.size = windows.size and spans.w = windows.w),
hits as (
  select doc_id, count(distinct pos) as n_hit
  from (select doc_id, unnest(range(i, i + size)) as pos from found) group by doc_id),
named as (
  select doc_id, count(*) as n_items, string_agg(name, ',' order by name) as names
  from (select distinct doc_id, cast(item_id as varchar) as name from found) group by doc_id)
select docs.doc_id, cast(len(words) as bigint) as n_words, coalesce(n_hit, 0) as n_hit,
  coalesce(n_items, 0) as n_items, sha256(coalesce(names, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(words) as contaminated
from docs left join hits using (doc_id) left join named using (doc_id)
"""


@query("op9_decontaminate", _CONTAMINATION_SQL)
def op9(spark, sf_dir):
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_REPEATS_SQL = r"""
with docs as (select doc_id, encode(coalesce(text, '')) as bytes from documents),
strings as (
  select doc_id, i, bytes[i:i + 49] as s
  from (select doc_id, bytes, unnest(range(1, octet_length(bytes) - 48)) as i from docs where octet_length(bytes) >= 50)),
first as (select s, min(doc_id) as low from strings group by s having min(doc_id) < max(doc_id)),
hits as (select doc_id, i from strings join first using (s) where low < doc_id),
runs as (
  select doc_id, min(i) as a, max(i) + 49 as b
  from (select doc_id, i, sum(new) over (partition by doc_id order by i) as run
        from (select doc_id, i, case when i <= lag(i) over (partition by doc_id order by i) + 50 then 0 else 1 end as new from hits))
  group by doc_id, run),
gaps as (
  select doc_id, coalesce(lag(b) over (partition by doc_id order by a), 0) + 1 as f, a - 1 as t from runs
  union all select doc_id, max(b) + 1, 9223372036854775807 from runs group by doc_id),
kept as (
  select g.doc_id, string_agg(hex(bytes[f:least(t, octet_length(bytes))]), '' order by f) as h
  from gaps g join docs using (doc_id) where f <= least(t, octet_length(bytes)) group by g.doc_id),
removed as (select doc_id, cast(sum(b - a + 1) as bigint) as n_removed, count(*) as n_spans from runs group by doc_id)
select d.doc_id, cast(octet_length(bytes) as bigint) as n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans,
  sha256(case when r.doc_id is null then bytes else unhex(coalesce(h, '')) end) as kept_sha256
from docs d left join removed r using (doc_id) left join kept using (doc_id)
"""


@query("op10_repeated_strings", _REPEATS_SQL)
def op10(spark, sf_dir):
    return repeats.removal_digests(table(spark, sf_dir, "documents"))


_COLLOCATION_SQL = r"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents),
cut as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as words from pieces),
total as (select lang, cast(sum(len(words)) as bigint) as n from cut group by lang),
counted as (
  select lang, phrase, size, count(*) as f
  from (select lang, k as size, array_to_string(words[i:i + k - 1], ' ') as phrase
        from (select lang, words, unnest(range(1, len(words) + 1)) as i from cut), (select unnest([1, 2, 3, 4]) as k)
        where i + k - 1 <= len(words))
  group by lang, phrase, size having count(*) >= 30),
candidates as (select lang, phrase, size, f as a, string_split(phrase, ' ') as words from counted where size > 1),
cuts as (
  select c.lang, c.phrase, c.a, k, x.f as l, y.f as r, 2000000::hugeint * c.a // (x.f + y.f) as score
  from (select *, unnest(range(1, size)) as k from candidates) c
  join counted x on x.lang = c.lang and x.phrase = array_to_string(c.words[1:k], ' ')
  join counted y on y.lang = c.lang and y.phrase = array_to_string(c.words[k + 1:], ' ')),
weakest as (select * from cuts qualify row_number() over (partition by lang, phrase order by score, k) = 1),
around as (
  select lang, sub, max(a) as most
  from (select lang, a, array_to_string(words[i:i + w - 1], ' ') as sub
        from (select *, unnest(range(1, size)) as i from candidates where size > 2), (select unnest([2, 3]) as w)
        where w < size and i + w - 1 <= size)
  group by lang, sub),
kept as (
  select weakest.* from weakest left join around on around.lang = weakest.lang and sub = phrase
  where most is null or 100::hugeint * most < 80::hugeint * a),
ranked as (
  select *, row_number() over (partition by lang order by score desc, a desc, encode(phrase)) as rank from kept)
select lang, rank, phrase, a, l, r, n, cast(score as bigint) as score from ranked join total using (lang) where rank <= 2000
"""


@query("op11_collocations", _COLLOCATION_SQL)
def op11(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query("op12_projected_search")
def op12(spark, sf_dir):
    return projected_search.nearest(table(spark, sf_dir, "embeddings"))


@query("op13_whitening")
def op13(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)
