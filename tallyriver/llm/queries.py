"""The registered queries of the text operators, and their SQL where SQL can express them."""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyriver.llm import bpe
from tallyriver.llm.conversations import repair_conversations
from tallyriver.llm.credentials import PATTERNS, SCOPE, credential_digest, find_credentials
from tallyriver.llm.decontamination import find_leaks
from tallyriver.llm.jaccard import jaccard_components
from tallyriver.llm.language import fit_language, with_language
from tallyriver.llm.language_model import fit_language_model, score_texts
from tallyriver.llm.licenses import license_labels, scan_licenses
from tallyriver.llm.lines import dedup_lines
from tallyriver.llm.neighbours import build_index, search
from tallyriver.llm.quality import fit_quality, with_quality
from tallyriver.llm.runs import find_runs, run_digest
from tallyriver.llm.text import held_out
from tallyriver.llm.urls import Rule, filter_urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


@query
def op1_secret_scan(spark, sf_dir):
    """Secrets of every document, weak parts only beside their complement."""
    return credential_digest(find_credentials(table(spark, sf_dir, "documents")))


def _secret_sql() -> str:
    found = " union all ".join(
        f"select doc_id, {n} as kind, '{kind}' as name, unnest(regexp_extract_all(text, $${p}$$)) as whole,"
        f" unnest({f'regexp_extract_all(text, $${p}$$, 1)' if kind == 'assign' else f'regexp_extract_all(text, $${p}$$)'}) as value,"
        f" unnest(list_resize(string_split_regex(text, $${p}$$), len(regexp_extract_all(text, $${p}$$)))) as gap,"
        f" unnest(range(1, len(regexp_extract_all(text, $${p}$$)) + 1)) as i from documents"
        for n, (kind, p) in enumerate(PATTERNS.items())
    )
    return f"""
with found as ({found}),
placed as (
    select doc_id, kind, name, length(whole) as size,
           sum(length(gap) + length(whole)) over (partition by doc_id, kind order by i) as stop,
           case name when 'assign' then length(value) >= 8 when 'access' then length(whole) >= 16
               when 'opaque' then regexp_matches(whole, '[0-9]') and regexp_matches(whole, '[A-Za-z]') else true end as ok,
           case when name in ('access', 'identifier') then 'identifier' when name = 'endpoint' then 'endpoint'
               else 'secret' end as role
    from found),
spans as (select doc_id, kind, name, role, (stop - size)::bigint as start, stop::bigint as stop from placed where ok),
free as (
    select * from spans a where kind < 3 or not exists (
        select 1 from spans b where b.kind < 3 and b.doc_id = a.doc_id and b.start < a.stop and b.stop > a.start)),
kept as (
    select * from free a where kind < 3 or exists (
        select 1 from free b where b.doc_id = a.doc_id and b.role <> a.role and 'secret' in (a.role, b.role)
        and b.start <= a.stop + {SCOPE} and b.stop >= a.start - {SCOPE})),
texts as (
    select doc_id, kind, start, name || ':' || start || ':' || stop as t, name from kept)
select d.doc_id, count(*) filter (name = 'assign')::bigint as n_assign, count(*) filter (name = 'access')::bigint as n_access,
       count(*) filter (name = 'hex')::bigint as n_hex,
       sha256(coalesce(string_agg(t, ',' order by start, kind) filter (kind < 3), '')) as base_sha256,
       coalesce(string_agg(t, ',' order by start, kind), '') as spans
from documents d left join texts using (doc_id) group by d.doc_id
"""


ORACLES["op1_secret_scan"] = _secret_sql()


@query
def op2_line_dedup(spark, sf_dir):
    """Every document without the lines that it shares with two other documents, as a digest."""
    kept = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


ORACLES["op2_line_dedup"] = r"""
with lines as (
    select doc_id, unnest(l) as line, generate_subscripts(l, 1) as i
    from (select doc_id, string_split(coalesce(text, ''), chr(10)) as l from documents)),
keyed as (
    select *, regexp_replace(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', '') as key
    from lines),
hot as (
    select key, max(doc_id) as last from keyed where length(key) >= 20 group by key having count(distinct doc_id) >= 3),
marked as (select k.*, h.key is not null and h.last <> k.doc_id as gone from keyed k left join hot h on h.key = k.key)
select doc_id, count(*)::bigint as n_lines, count(*) filter (gone)::bigint as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by i) filter (not gone), '')) as kept_sha256
from marked group by doc_id
"""


# The rules (verdict, host, path).
URL_RULES = [
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
]


@query
def op3_url_filter(spark, sf_dir):
    """Host, path, rule and verdict of every page's url."""
    return filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


@query
def op4_license_scan(spark, sf_dir):
    """License phrases and rules found in every document."""
    return license_labels(scan_licenses(table(spark, sf_dir, "documents")))


@query
def op5_ngram_jaccard_join(spark, sf_dir):
    """Documents that share four fifths of their five-word shingles, by component."""
    found = jaccard_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


ORACLES["op5_ngram_jaccard_join"] = r"""
with recursive words as (
    select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') as w
    from documents),
sets as (
    select doc_id, list_distinct(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
        else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as s
    from words),
shingles as (select doc_id, len(s) as n, unnest(s) as g from sets),
pairs as (
    select a.doc_id as a, b.doc_id as b from shingles a join shingles b on a.g = b.g
    where a.n * 5 >= b.n * 4 and b.n * 5 >= a.n * 4 group by a.doc_id, b.doc_id
    having 100 * count(*) >= 80 * (min(a.n) + min(b.n) - count(*))),
reach(doc_id, other) as (select a, b from pairs union select r.doc_id, p.b from reach r join pairs p on p.a = r.other)
select doc_id, len(s)::bigint as n_shingles,
       coalesce((select min(other) from reach r where r.doc_id = sets.doc_id), doc_id) as component_id
from sets
"""


QUALITY_THRESHOLD = 0.3


@query
def op6_quality_classifier(spark, sf_dir):
    """Every document's probability of being good, by a model of the labelled rows outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    model = fit_quality(docs, table(spark, sf_dir, "labels"))
    scored = with_quality(docs.select("doc_id", "text"), model)
    predicted = (F.col("score") >= QUALITY_THRESHOLD).cast("int").alias("predicted")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted)


@query
def op7_benchmark_decontamination(spark, sf_dir):
    """Documents that hold four fifths of the shingles of a benchmark item, or all words of a shorter one in a row."""
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), short_items=True)


ORACLES["op7_benchmark_decontamination"] = r"""
with words as (
    select kind, id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') as w
    from (select 'doc' as kind, doc_id as id, text from documents
          union all select 'item', item_id, text from benchmark)),
widths as (select distinct len(w) as k from words where kind = 'item' and len(w) between 1 and 4),
shingles as (
    select distinct kind, id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
        else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as g
    from words
    union
    select kind, id, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' ')))
    from words, widths where kind = 'doc' and len(w) > k),
sizes as (select id, count(*)::bigint as n from shingles where kind = 'item' group by id)
select d.id as doc_id, i.id as item_id, n as n_shingles, count(*)::bigint as n_shared, count(*) / n as containment
from shingles d join shingles i on d.g = i.g and d.kind = 'doc' and i.kind = 'item' join sizes s on s.id = i.id
group by d.id, i.id, n having 100 * count(*) >= 80 * n
"""


@query
def op8_byte_bpe(spark, sf_dir):
    """Every document's token ids and the bytes decoded from them, as digests."""
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    return bpe.digests(bpe.encode(table(spark, sf_dir, "documents"), path, pattern, decoded=True))


@query
def op9_nearest_neighbours(spark, sf_dir):
    """The five nearest vectors of every fiftieth one."""
    rows = table(spark, sf_dir, "embeddings")
    return search(build_index(rows), rows.filter(F.col("vec_id") % 50 == 0))


@query
def op10_language_id(spark, sf_dir):
    """Every document's language, by a network trained on rows outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    found = with_language(docs.select("doc_id", "text"), fit_language(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def planted_run(doc_id: int | None, n: int) -> np.ndarray | None:
    """The places of a document's words when a run is planted in one document of ten, chosen by its id."""
    checksum = zlib.crc32(str(doc_id).encode())
    if doc_id is None or checksum % 10 or not n:
        return None
    g = checksum // 10
    start = g % n
    period = 1 + (n - start) // (3 + g % 8)
    places = np.arange(n)
    places[start:] = start + (places[start:] - start) % period
    return places


@query
def op11_periodic_runs(spark, sf_dir):
    """Every document's runs of repeating words, some of them planted, and the text without the repeats."""
    return run_digest(find_runs(table(spark, sf_dir, "documents"), rewrite=planted_run))


SCORED_FOLDS = 10


@query
def op12_lm_scoring(spark, sf_dir):
    """Every document's probability by a model of the documents outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    out = held_out(F.col("doc_id"), SCORED_FOLDS)
    model = fit_language_model(docs.filter(~out))
    found = score_texts(docs, model)
    learnt = F.lit(model.totals.tokens).cast("bigint").alias("train_tokens")
    return found.select("doc_id", out.alias("held_out"), "n_tokens", "n_known", learnt, "base_score", "score")


@query
def op13_conversation_repair(spark, sf_dir):
    """Every conversation's faults and its cheapest repair, after some damage."""
    return repair_conversations(table(spark, sf_dir, "conversations"), damage=True)
