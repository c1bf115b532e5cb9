"""Registered queries of the corpus operators, with oracle SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coverloom.llm import ann, chat, codebooks, divergence, embeddings, html, langid, mixing, packing, simhash, tokens, urls, warc
from coverloom.llm.common import table

#: Fixed values of the queries.
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]
WEIGHTS = [5, 2, 1]
CAPACITY = 2048

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def register(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


@register()
def op1_main_text(spark, sf_dir):
    return html.extract(table(spark, sf_dir, "pages"))


_RULE_ROWS = ", ".join(f"('{h}', '{p}', '{a}')" for h, p, a in RULES)
_ASCII = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


@register(rf"""
WITH rest AS (SELECT page_id, url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (SELECT page_id, url, translate(regexp_extract(r, '^[^/?#]*'), {_ASCII}) AS host, regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
rules(h, p, a) AS (VALUES {_RULE_ROWS}),
numbered AS (SELECT *, row_number() OVER () AS n FROM parts),
best AS (SELECT n, h || p AS rule, a, row_number() OVER (PARTITION BY n ORDER BY length(h || p) DESC, length(h) DESC) AS k
         FROM numbered JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT page_id, url, host, path, rule, coalesce(a, 'allow') AS verdict FROM numbered LEFT JOIN best ON numbered.n = best.n AND k = 1""")
def op2_url_verdicts(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return urls.judge(pages, spark.createDataFrame(RULES, "host string, path string, action string"))


@register()
def op3_nearest_neighbours(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    return ann.search(rows, rows.filter(F.col("vec_id") % 20 == 0), k=20)


@register(r"""
WITH sized AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS weight FROM per),
ratios AS (SELECT *, (source_size * 3)::DOUBLE / weight AS ratio FROM weighed),
levels AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(source_size * 3) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
           / sum(weight) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM ratios),
goals AS (SELECT source, source_size, least((source_size * 3)::DOUBLE, coalesce(max(CASE WHEN level <= ratio THEN level END) OVER (), 0.0) * weight) AS target FROM levels),
plan AS (SELECT *, floor(target + 0.5)::BIGINT AS budget, CASE WHEN source_size > 0 THEN floor(floor(target + 0.5) / source_size) ELSE 0 END::BIGINT AS epochs FROM goals),
placed AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY md5(concat_ws(':', coalesce(doc_id::VARCHAR, ''), size::VARCHAR)), doc_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM sized)
SELECT doc_id, s.source, size, source_size, target, (epochs * size + greatest(0, least(size, budget - epochs * source_size - before)))::BIGINT AS taken
FROM placed s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source""")
def op4_mix(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"), WEIGHTS)


@register("""
WITH raw AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
hashed AS (SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, sha1(html) AS payload_digest FROM raw),
best AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS best FROM hashed)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 1000 AND page_id <> best THEN 'revisit' ELSE 'response' END AS record_type,
CASE WHEN payload_bytes >= 1000 AND page_id <> best THEN best END AS refers_to FROM best""")
def op5_warc(spark, sf_dir):
    return warc.round_trip(table(spark, sf_dir, "pages"))


@register()
def op6_simhash_groups(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@register()
def op7_language(spark, sf_dir):
    return langid.identify(table(spark, sf_dir, "documents"))


@register()
def op8_embedding_groups(spark, sf_dir):
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


@register(r"""
WITH turns AS (SELECT conv_id, turn, CASE WHEN trim(role) <> '' THEN role END AS speaker, replace(coalesce(text, ''), '<|', '< |') AS text FROM conversations WHERE conv_id IS NOT NULL),
seats AS (SELECT DISTINCT conv_id, speaker AS perspective FROM turns WHERE speaker <> 'system'),
rows AS (SELECT t.*, perspective, CASE WHEN speaker = perspective THEN 'assistant' WHEN speaker = 'system' THEN 'system' ELSE 'user' END AS role FROM turns t JOIN seats USING (conv_id)),
heads AS (SELECT *, '<|im_start|>' || role || CASE WHEN role = 'user' THEN ' name=' || regexp_replace(coalesce(speaker, 'unknown'), '[\s<>|=]+', '_', 'g') ELSE '' END || chr(10) AS head FROM rows),
pieces AS (SELECT *, head || text || '<|im_end|>' || chr(10) AS piece FROM heads),
placed AS (SELECT *, length(piece)::BIGINT AS len, coalesce(sum(length(piece)) OVER (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker NULLS FIRST, text
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM pieces)
SELECT conv_id, perspective, turn, speaker, role, piece, start, len AS length, CASE WHEN role = 'assistant' THEN start + length(head) END AS train_start,
CASE WHEN role = 'assistant' THEN start + length(head) + length(text) + 10 END AS train_end FROM placed""")
def op9_perspectives(spark, sf_dir):
    return chat.rotate(table(spark, sf_dir, "conversations"))


@register()
def op10_pack(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_file(), CAPACITY)


@register()
def op11_bpe_round_trip(spark, sf_dir):
    import public_tokenizers

    return tokens.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@register(r"""
WITH docs AS (SELECT row_number() OVER () AS d, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
found AS (SELECT d, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term, count(*)::HUGEINT AS c FROM found GROUP BY lang, term HAVING count(DISTINCT d) >= 10),
langs AS (SELECT lang, count(*)::HUGEINT AS v, sum(c)::HUGEINT AS n FROM kept GROUP BY lang),
counts AS (SELECT lang, source, term, count(*)::HUGEINT AS c FROM found SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
groups AS (SELECT lang, source, coalesce(sum(c), 0)::HUGEINT AS n FROM (SELECT DISTINCT lang, source FROM docs) LEFT JOIN counts USING (lang, source) GROUP BY lang, source),
cells AS (SELECT lang, source, term, coalesce(counts.c, 0) AS c, 1 + 1000000000 * (coalesce(counts.c, 0) + 2) // (groups.n + 2 * v) AS p,
          1 + 1000000000 * (kept.c + 2) // (langs.n + 2 * v) AS q
          FROM groups JOIN kept USING (lang) JOIN langs USING (lang) LEFT JOIN counts USING (lang, source, term)),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)), 0) AS value
          FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN cells x ON x.lang = a.lang AND x.source = a.source
          LEFT JOIN cells y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term GROUP BY ALL),
ranked AS (SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pairs
           UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q),
           row_number() OVER (PARTITION BY lang, source ORDER BY (p - q) * (p - q) // (p + q) DESC, term) FROM cells WHERE c > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 10""")
def op12_source_divergence(spark, sf_dir):
    return divergence.audit(table(spark, sf_dir, "documents")).drop("q")


def _codes_sql(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    """The rounds of op13 spelled out: ``b0`` is the start, ``a{k}`` assigns parts by ``b{k}``, ``b{k+1}`` moves its entries."""
    steps = [rf"""
WITH kept AS (SELECT vec_id, label, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
              WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pieces AS (SELECT vec_id, label, p::INTEGER AS p, v[p * len(v) // {parts} + 1:(p + 1) * len(v) // {parts}] AS x FROM kept, range({parts}) r(p)),
b0 AS (SELECT p, e, x AS c FROM (SELECT p, x, (row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1)::INTEGER AS e FROM pieces) WHERE e < {entries})"""]
    for k in range(rounds + 1):
        steps.append(f"""a{k} AS (SELECT vec_id, label, p, x, arg_min(e, d * {entries} + e) AS e, min(d) AS d FROM (SELECT vec_id, label, pieces.p, x, e,
       list_sum([(z[1] - z[2]) * (z[1] - z[2]) FOR z IN list_zip(x, c)])::BIGINT AS d FROM pieces JOIN b{k} USING (p)) GROUP BY vec_id, label, p, x)""")
        if k < rounds:
            steps.append(f"""m{k} AS (SELECT p, e, list(m ORDER BY i) AS c FROM (SELECT p, e, i, floor(sum(x[i])::DOUBLE / count(*))::BIGINT AS m
       FROM a{k}, range(1, 4097) r(i) WHERE i <= len(x) GROUP BY p, e, i) GROUP BY p, e),
b{k + 1} AS (SELECT p, e, coalesce(m{k}.c, b{k}.c) AS c FROM b{k} LEFT JOIN m{k} USING (p, e))""")
    return ",\n".join(steps) + f""",
digest AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{rounds}),
coded AS (SELECT vec_id, label, string_agg(lower(lpad(to_hex(e), 2, '0')), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a{rounds} GROUP BY vec_id, label)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM coded, digest"""


@register(_codes_sql())
def op13_vector_codes(spark, sf_dir):
    return codebooks.codes(table(spark, sf_dir, "embeddings"))
