"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import decontaminate, exact_dedup, fill_in_middle, filter_audit, html_text, jaccard_join, language_mix, packing, pitman_yor, secret_scan, sharding, toxicity, warc
from llm.workers import importable
from tidymart.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)



def query(name: str, sql: str | None = None):
    def register(run):
        def start(spark: SparkSession, folder: str) -> DataFrame:
            importable(spark)
            return run(spark, folder)

        QUERIES[name] = start
        if sql:
            ORACLE[name] = sql
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _spans_sql(kind: str, pattern: str, group: int, least: int) -> str:
    """Spans of a kind: sums of the lengths of the texts between the matches and of the matches."""
    pattern = pattern.replace("'", "''")
    return f"""
    select doc_id, {kind!r} as kind, start, start + length(found) as stop from (
      select doc_id, unnest(found) as found, unnest(value) as value,
        unnest(list_transform(range(1, len(found) + 1), lambda i: list_sum(list_transform(gap[1:i], lambda g: length(g)))
          + coalesce(list_sum(list_transform(found[1:i - 1], lambda f: length(f))), 0)))::bigint as start
      from (select doc_id, regexp_extract_all(t, '{pattern}', 0) as found, regexp_extract_all(t, '{pattern}', {group}) as value,
              string_split_regex(t, '{pattern}') as gap from texts))
    where length(value) >= {least}"""


_ALL_SPANS = "\nunion all ".join(
    f"select {i} as place, * from ({_spans_sql(r.kind, r.pattern, r.value, r.least)})" for i, r in enumerate(secret_scan.RULES)
)
SECRETS_SQL = f"""
with texts as (select doc_id, coalesce(text, '') as t from documents),
spans as ({_ALL_SPANS}),
lists as (
  select doc_id, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access,
    count(*) filter (kind = 'hex') as n_hex,
    string_agg(kind || ':' || start || ':' || stop, ',' order by start, place) filter (place < {len(secret_scan.BASE_RULES)}) as base,
    string_agg(kind || ':' || start || ':' || stop, ',' order by start, place) as spans
  from spans group by doc_id)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
  sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from documents left join lists using (doc_id)"""


@query("op2_secret_scan", SECRETS_SQL)
def op2_secret_scan(spark, folder):
    # An earlier scan had half of the documents and fewer rules; now what it has not seen is scanned, and all is returned.
    ledger = scratch_path(spark, "secret-ledger")
    documents = table(spark, folder, "documents")
    earlier = documents.filter(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0)
    secret_scan.scan_versions(earlier, ledger, rules=secret_scan.BASE_RULES)
    found = secret_scan.scan_versions(documents, ledger)
    hits = F.col("hits")
    return found.select(
        "doc_id",
        *[secret_scan.count_spans(hits, r.kind).alias(f"n_{r.kind}") for r in secret_scan.BASE_RULES],
        F.sha2(secret_scan.spans_text(hits, secret_scan.BASE_RULES), 256).alias("base_sha256"),
        secret_scan.spans_text(hits, secret_scan.RULES).alias("spans"),
    )


@query("op4_shard_lpt")
def op4_shard_lpt(spark, folder):
    placed = sharding.shard_documents(table(spark, folder, "documents"), shards=16)
    none = F.lit(None).cast("int").alias("grown_shard")
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", none)


EXACT_SQL = """
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
  doc_id = max(doc_id) over same as kept, sha256(coalesce(text, '')) as text_sha256
from documents window same as (partition by coalesce(text, ''))"""


@query("op8_exact_dedup", EXACT_SQL)
def op8_exact_dedup(spark, folder):
    groups = exact_dedup.exact_groups(table(spark, folder, "documents"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


_DIGEST_SQL = "||".join(
    "(select string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(hex, "
    f"{1 + 10 * i}, 10))::bigint >> (35 - 5 * k)) & 31) + 1)::int, 1), '' order by k) from range(8) as r(k))"
    for i in range(4)
)
WARC_SQL = f"""
with digests as (select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha1(coalesce(html, '')) as hex from pages),
named as (select page_id, payload_bytes, {_DIGEST_SQL} as payload_digest, min(page_id) over (partition by hex) as keeper from digests)
select page_id, payload_bytes, payload_digest, case when page_id = keeper then 'response' else 'revisit' end as record_type,
  case when page_id <> keeper then keeper end as refers_to
from named"""


@query("op5_warc_boundary_chain", WARC_SQL)
def op5_warc(spark, folder):
    archives = scratch_path(spark, "warc")
    warc.write_archives(table(spark, folder, "pages"), archives)
    return warc.read_archives(spark, archives)


@query("op7_toxicity_fm")
def op7_toxicity(spark, folder):
    docs = table(spark, folder, "documents")
    held_out = toxicity.held_out()
    model = toxicity.train(docs, table(spark, folder, "labels").filter(~held_out))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op9_pattern_packing")
def op9_packing(spark, folder):
    return packing.pack_documents(table(spark, folder, "documents"), tokenizer_path())


@query("op10_html_text")
def op10_html_text(spark, folder):
    return html_text.extract_text(table(spark, folder, "pages"))


JACCARD_SQL = r"""
with recursive words as (
  select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda w: w <> '') as w from documents),
runs as (
  select doc_id, unnest(case when len(w) >= 4 then list_transform(range(1, len(w) - 2), lambda i: w[i:i + 3]) when len(w) > 0 then [w] else [] end) as run from words),
sets as (select distinct doc_id, run from runs),
sizes as (select doc_id, count(*) as n from sets group by doc_id),
pairs as (select a.doc_id as a, b.doc_id as b, count(*) as shared from sets a join sets b on a.run = b.run and a.doc_id <> b.doc_id group by all),
links as (select a, b from pairs join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * shared >= 85 * (x.n + y.n - shared)),
reach(a, b) as (select a, b from links union select reach.a, links.b from reach join links on reach.b = links.a)
select d.doc_id, coalesce(n, 0) as n_shingles, least(d.doc_id, coalesce(min(b), d.doc_id)) as component_id
from documents d left join sizes s on s.doc_id = d.doc_id left join reach r on r.a = d.doc_id group by d.doc_id, n"""


@query("op1_ngram_jaccard_join", JACCARD_SQL)
def op1_jaccard(spark, folder):
    found = jaccard_join.linked_components(table(spark, folder, "documents"), jaccard_join.Threshold(n=4, part=85, whole=100))
    return found.select("doc_id", F.col("size").alias("n_shingles"), "component_id")


@query("op6_cgk_decontamination")
def op6_decontamination(spark, folder):
    return decontaminate.find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op3_pitman_yor")
def op3_pitman_yor(spark, folder):
    return pitman_yor.score_texts(table(spark, folder, "documents"))


_FORM_SQL = "case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 90 then 'plain' when h4 % 100 < 20 then 'spm' else 'psm' end"
FIM_SQL = f"""
with hashed as (select doc_id, coalesce(text, '') as t, sha256('1:' || doc_id) as x from documents),
numbers as (select doc_id, t, length(t) as n, {", ".join(f"('0x' || substr(x, {1 + 8 * i}, 8))::bigint as h{i + 1}" for i in range(4))} from hashed),
formed as (select doc_id, t, n, {_FORM_SQL} as form, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b from numbers),
parts as (select *, substr(t, 1, a) as p, substr(t, a + 1, b - a) as m, substr(t, b + 1) as s from formed)
select doc_id, n, form, case when form <> 'plain' then a end as prefix_chars, case when form <> 'plain' then b - a end as middle_chars,
  sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
    else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256, sha256(t) as restored_sha256
from parts"""


@query("op11_fill_in_middle", FIM_SQL)
def op11_fill_in_middle(spark, folder):
    return fill_in_middle.fim_digests(table(spark, folder, "documents"))


AUDIT_SQL = r"""
with words as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as t,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') as w from documents),
failing as (
  select doc_id, part, (len(w) < 50)::int as a, (100 * len(list_distinct(w)) < 65 * len(w))::int as b,
    (100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 5 * length(t))::int as c,
    regexp_matches(t, '[#$%&*|]')::int as d, (doc_id > min(doc_id) over (partition by t))::int as e from words),
marked as (
  select part, map {'A': a, 'B': b, 'C': c, 'D': d, 'E': e} as fails, count(*) as n, count(*) filter (quality = 1) as good, count(*) filter (toxic = 1) as bad
  from failing left join (select doc_id, max(quality) as quality, max(toxic) as toxic from labels group by doc_id) using (doc_id) group by all),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as f),
orders as (
  select p.f || q.f || r.f || s.f || t.f as o from letters p, letters q, letters r, letters s, letters t
  where len(list_distinct([p.f, q.f, r.f, s.f, t.f])) = 5),
steps as (select o as filter_order, k::int as step, substr(o, k::int, 1) as f, string_split(substr(o, 1, k::int - 1), '') as before from orders, range(1, 6) as r(k)),
states as (
  select part, filter_order, step, f, n, good, bad, fails[f] as own, list_sum(list_transform(['A', 'B', 'C', 'D', 'E'], lambda x: fails[x])) as every,
    len(list_filter(before, lambda x: x <> '' and fails[x] = 1)) > 0 as gone from marked, steps),
counted as (
  select part, filter_order, step, f, coalesce(sum(n) filter (not gone and own = 0), 0)::bigint as kept,
    coalesce(sum(n) filter (not gone and own = 1), 0)::bigint as removed, coalesce(sum(n) filter (gone and own = 1), 0)::bigint as redundant,
    coalesce(sum(n) filter (own = 1 and every = 1), 0)::bigint as unique_fails, coalesce(sum(good) filter (not gone and own = 1), 0)::bigint as good_lost,
    coalesce(sum(bad) filter (not gone and own = 1), 0)::bigint as toxic_lost from states group by all)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) over (partition by part, f))::bigint as shapley from counted"""


@query("op12_filter_audit", AUDIT_SQL)
def op12_filter_audit(spark, folder):
    return filter_audit.audit_filters(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op13_language_mixture")
def op13_language_mixture(spark, folder):
    docs = table(spark, folder, "documents")
    held_out = language_mix.held_out()
    found = language_mix.predict(docs, language_mix.train(docs.filter(~held_out)))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
