"""The operators as registered queries, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    alignment,
    codes,
    decontaminate,
    embeddings,
    licenses,
    mixing,
    packing,
    sharding,
    simhash,
    substrings,
    tokens,
    toxicity,
    urls,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


MIX_ENTROPY, MIX_EPOCHS, MIX_BLOCK = 0.95, 4.0, 1 << 20


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    words = docs.select("doc_id", "source", mixing.n_words(F.col("text")).alias("n"))
    spend = words.agg(F.sum("n").alias("n")).first()["n"] or 0
    return mixing.mix(words, tokens=F.col("n"), entropy=MIX_ENTROPY, max_epochs=MIX_EPOCHS, budget=spend,
                      block_tokens=MIX_BLOCK)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.section_tokens(_table(spark, sf_dir, "documents"), fields=["text"], rule="start")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


# The rules of the query's contract (host, path, action).
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(_table(spark, sf_dir, "documents"), length=50).select(
        "doc_id", "n_words", "n_removed", "kept_sha256")


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> bytes:
    """A model of the labelled documents that are not held out; the sample is bounded by ``toxicity.train``."""
    labels = _table(spark, sf_dir, "labels").where(~toxicity.held_out(F.col("doc_id")))
    return toxicity.train(docs, labels)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity_model(spark, docs, sf_dir))
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_shard_by_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select(
        "doc_id", sharding.text_size(F.col("text")).alias("bytes"),
        F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("text_crc32"))
    return sharding.byte_shards(docs, 16, order_by=["doc_id", "text_crc32", "bytes"], size=F.col("bytes")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(_table(spark, sf_dir, "embeddings"), threshold=0.9)


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, distance=3)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"), licenses.templates_frame(spark))


TOKENIZERS = "/opt/tokenizers"  # the folder of the public vocabulary files


def op11_align_tokenizers(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = alignment.align(_table(spark, sf_dir, "documents"), bpe_vocabulary=f"{TOKENIZERS}/byte_bpe_50k.json",
                              piece_vocabulary=f"{TOKENIZERS}/piece_bpe_32k.model")
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2(F.col("groups"), 256))
    digested = aligned.select("doc_id", "n_a", "n_b", "n_groups", digest.alias("groups_sha256"), "links")
    return alignment.link_scores(digested).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                                                  "groups_sha256")


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = codes.compress(_table(spark, sf_dir, "embeddings"), parts=8, entries=16, rounds=6, scale=4096)
    digest = hashlib.sha256(codes.codebook_text(books).encode()).hexdigest()
    return codes.label_errors(coded).select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def op13_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), vocabulary=f"{TOKENIZERS}/word_bpe_49k.json", end_id=2,
                        window=4096)


QUERIES = {f.__name__: f for f in (
    op1_mix_sources, op2_token_counts, op3_decontaminate, op4_url_filter, op5_substring_dedup, op6_toxicity,
    op7_shard_by_bytes, op8_embedding_near_dedup, op9_simhash_near_dedup, op10_license_scan, op11_align_tokenizers,
    op12_vector_codes, op13_pack_sequences)}

_WORD = "[^\\x20\\x09-\\x0D]+"

_OP1 = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, source, greatest(1, coalesce(len(regexp_extract_all(text, '{_WORD}')), 0))::BIGINT AS n_tokens
  FROM documents),
totals AS (SELECT source, sum(n_tokens)::BIGINT AS total FROM docs GROUP BY source),
whole AS (SELECT sum(total)::BIGINT AS t, count(*) AS n FROM totals),
shares AS (SELECT source, total, total / (SELECT t FROM whole)::DOUBLE AS p FROM totals),
-- grid point k is exponent k / 4096; at each, the relative entropy and the most epochs
grid AS (
  SELECT k, CASE WHEN (SELECT n FROM whole) < 2 THEN 1.0
                 ELSE (ln(sum(pow(p, k / 4096.0))) - k / 4096.0 * sum(pow(p, k / 4096.0) * ln(p)) / sum(pow(p, k / 4096.0)))
                      / ln((SELECT n FROM whole)) END AS entropy,
         max(pow(p, k / 4096.0) / total) / sum(pow(p, k / 4096.0)) * (SELECT t FROM whole) AS epochs
  FROM shares, range(0, {4 * 4096} + 1) g(k) GROUP BY k),
flat AS (SELECT coalesce(max(k) FILTER (WHERE entropy >= {MIX_ENTROPY}), 0) AS k FROM grid),
chosen AS (SELECT min(g.k) AS k FROM grid g, flat f WHERE g.k >= f.k AND (g.epochs <= {MIX_EPOCHS} OR g.k >= 4096)),
norm AS (SELECT sum(pow(p, (SELECT k FROM chosen) / 4096.0)) AS z FROM shares),
weights AS (
  SELECT source, total, greatest(1, floor(round(pow(p, (SELECT k FROM chosen) / 4096.0) / (SELECT z FROM norm), 12)
                                          * (SELECT t FROM whole)::DOUBLE + 0.5))::BIGINT AS b FROM shares),
copies AS (
  SELECT d.doc_id, d.source, d.n_tokens, e::INT AS epoch, w.b,
         coalesce(sum(d.n_tokens) OVER (PARTITION BY d.source
           ORDER BY e, md5('42:' || e || ':' || d.doc_id), d.doc_id, d.n_tokens
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM docs d JOIN weights w ON d.source IS NOT DISTINCT FROM w.source, range(0, ceil(w.b / w.total::DOUBLE)::BIGINT) r(e)),
blocks AS (SELECT greatest(1, ceil(sum(b) / {MIX_BLOCK}.0))::BIGINT AS n FROM weights),
placed AS (SELECT *, floor(before::DOUBLE / b * (SELECT n FROM blocks))::INT AS block FROM copies WHERE before < b)
SELECT doc_id, source, n_tokens, epoch, block,
       row_number() OVER (PARTITION BY block ORDER BY md5('42:block:' || epoch || ':' || doc_id), doc_id, epoch, source,
                          n_tokens) - 1 AS place
FROM placed"""

_OP4 = """
WITH cut AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
rules(host, path, action) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block'))
SELECT c.page_id, c.host, c.path,
       (SELECT arg_max(r.host || r.path, length(r.host) * 1000 + length(r.path)) FROM rules r
        WHERE (c.host = r.host OR ends_with(c.host, '.' || r.host)) AND starts_with(c.path, r.path)) AS rule,
       coalesce((SELECT arg_max(r.action, length(r.host) * 1000 + length(r.path)) FROM rules r
        WHERE (c.host = r.host OR ends_with(c.host, '.' || r.host)) AND starts_with(c.path, r.path)), 'allow') AS verdict
FROM cut c"""

_OP5 = f"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
wins AS (SELECT doc_id, p, array_to_string(w[p + 1:p + 50], ' ') AS win FROM words, range(0, len(w) - 49) r(p)),
firsts AS (SELECT win, min(doc_id) AS low FROM wins GROUP BY win),
hits AS (SELECT DISTINCT doc_id, p FROM wins JOIN firsts USING (win) WHERE doc_id > low),
gone AS (SELECT doc_id, list(DISTINCT p + i) AS places FROM hits, range(0, 50) r(i) GROUP BY doc_id),
kept AS (
  SELECT doc_id, len(w) AS n_words, len(coalesce(places, [])) AS n_removed,
         array_to_string(CASE WHEN places IS NULL THEN w ELSE
           list_transform(list_filter(range(0, len(w)), lambda i: NOT list_contains(places, i)), lambda i: w[i + 1]) END, ' ') AS t
  FROM words LEFT JOIN gone USING (doc_id))
SELECT doc_id, n_words, n_removed::BIGINT AS n_removed, sha256(t) AS kept_sha256 FROM kept"""

_OP8 = """
WITH RECURSIVE fine AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
unit AS (SELECT vec_id, v, sqrt(list_dot_product(v, v)) AS n FROM fine),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM unit a JOIN unit b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_dot_product(a.v, b.v) / (a.n * b.n) >= 0.9),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
low AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, low.component_id, e.vec_id = low.component_id AS kept
FROM embeddings e LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) n ON n.a = e.vec_id
JOIN low ON low.vec_id = e.vec_id"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_NORM = "regexp_replace(lower({0}), '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g')"
_OP10 = f"""
WITH templates(template, license, body) AS (VALUES {", ".join(
    f"({i}, {_quoted(n)}, {_quoted(t)})" for i, (n, t) in enumerate(licenses.TEMPLATES))}),
docs AS (SELECT row_number() OVER () AS row, doc_id, {_NORM.format("text")} AS norm FROM documents WHERE text IS NOT NULL),
cut AS (SELECT row, doc_id, string_split(norm, chr(10)) AS lines,
               string_split_regex(norm, '\\n[ \\n]*\\n') AS paragraphs, norm FROM docs),
units AS (
  SELECT row, doc_id, 'line' AS unit, i - 1 AS place, lines[i] AS body FROM cut, range(1, len(lines) + 1) r(i)
  UNION ALL SELECT row, doc_id, 'paragraph', i - 1, paragraphs[i] FROM cut, range(1, len(paragraphs) + 1) r(i)
  WHERE len(paragraphs) > 1
  UNION ALL SELECT row, doc_id, 'text', 0, norm FROM cut WHERE len(lines) > 1),
worded AS (SELECT *, list_filter(string_split_regex(body, '[ \\n]+'), lambda w: w <> '') AS w FROM units),
grams AS (
  SELECT row, doc_id, unit, place, len(w) - 1 AS n, g, count(*) AS c
  FROM (SELECT *, unnest([w[i] || ' ' || w[i + 1] for i in range(1, len(w))]) AS g FROM worded) GROUP BY ALL),
tw AS (SELECT template, license,
              list_filter(string_split_regex({_NORM.format("body")}, '[ \\n]+'), lambda w: w <> '') AS w FROM templates),
tg AS (SELECT template, license, len(w) - 1 AS n, g, count(*) AS c
       FROM (SELECT *, unnest([w[i] || ' ' || w[i + 1] for i in range(1, len(w))]) AS g FROM tw) GROUP BY ALL),
found AS MATERIALIZED (
  SELECT row, doc_id, unit, place::INT AS place, license, max(dice) AS dice FROM (
    SELECT a.row, a.doc_id, a.unit, a.place, b.license, 2 * sum(least(a.c, b.c)) / (a.n + b.n)::DOUBLE AS dice
    FROM grams a JOIN tg b ON a.g = b.g GROUP BY a.row, a.doc_id, a.unit, a.place, b.template, b.license, a.n, b.n) AS pairs
  WHERE dice >= {licenses.THRESHOLD} GROUP BY row, doc_id, unit, place, license),
-- windows: every place of a template's bigram begins one, as long as the template
flat AS (SELECT row, doc_id, list_filter(string_split_regex(norm, '[ \\n]+'), lambda w: w <> '') AS w FROM docs),
hits AS MATERIALIZED (
  SELECT row, doc_id, last, pos, b.template, b.license, b.n AS n_t, b.g, b.c AS c_t
  FROM (SELECT row, doc_id, len(w) - 1 AS last, i - 1 AS pos, w[i] || ' ' || w[i + 1] AS g FROM flat, range(1, len(w)) r(i)) a
  JOIN tg b ON a.g = b.g),
scored AS MATERIALIZED (
  SELECT row, doc_id, license, p, max(dice) AS dice FROM (
    SELECT row, doc_id, license, p, 2 * sum(least(c, c_t)) / (n_t + least(n_t, last - p))::DOUBLE AS dice FROM (
      SELECT s.row, s.doc_id, s.license, s.template, s.n_t, s.last, s.pos AS p, h.g, h.c_t, count(*) AS c
      FROM hits s JOIN hits h ON h.row = s.row AND h.template = s.template AND h.pos >= s.pos AND h.pos < s.pos + s.n_t
      GROUP BY ALL) x GROUP BY row, doc_id, license, template, n_t, last, p) y
  WHERE dice >= {licenses.THRESHOLD} GROUP BY row, doc_id, license, p)
SELECT doc_id, unit, place, license, dice FROM found
UNION ALL
SELECT doc_id, 'window', p::INT, license, dice FROM scored s
WHERE NOT EXISTS (SELECT 1 FROM found f WHERE f.row = s.row AND f.license = s.license)
  AND NOT EXISTS (SELECT 1 FROM scored o WHERE o.row = s.row AND o.license = s.license
    AND abs(o.p - s.p) <= (SELECT max(n) FROM tg) AND (o.dice > s.dice OR (o.dice = s.dice AND o.p < s.p)))"""

_OP7 = """
WITH crc AS (  -- the table of CRC-32: eight shifts of each byte
  SELECT list_transform(range(0, 256), lambda b: list_reduce(range(0, 8), lambda c, k:
           CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, b)) AS t),
docs AS (
  SELECT doc_id, coalesce(strlen(text), 0) + 1 AS size, hex(encode(coalesce(text, ''))) AS h FROM documents),
sums AS (
  SELECT doc_id, size,
         xor(4294967295, list_reduce(
           list_transform(range(0, size - 1), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT),
           lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1]), 4294967295::BIGINT)) AS text_crc32
  FROM docs, crc),
placed AS (
  SELECT *, sum(size) OVER (ORDER BY doc_id, text_crc32, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS done,
         sum(size) OVER () AS total FROM sums),
sharded AS (
  SELECT *, least(15, ((2 * done - size) * 16) // (2 * total))::INT AS shard FROM placed)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id, text_crc32, size) - 1 AS slot, NULL::INT AS grown_shard
FROM sharded"""

def _op12() -> str:
    """Six rounds over the parts of every vector, round by round; a floored mean is the sum less its modulus, divided."""
    steps = ["""
WITH fine AS (
  SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding::DOUBLE[], lambda x: floor(4096 * x)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT r, vec_id, k, v[k * (len(v) // 8) + 1:(k + 1) * (len(v) // 8)] AS p FROM fine, range(0, 8) t(k)),
b0 AS MATERIALIZED (
  SELECT k, i, p AS e FROM (SELECT k, p, row_number() OVER (PARTITION BY k ORDER BY vec_id) - 1 AS i FROM parts) WHERE i < 16)"""]
    for n in range(7):
        steps.append(f"""
d{n} AS MATERIALIZED (
  SELECT r, k, min(d * 16 + i) AS m FROM (
    SELECT r, k, i, list_sum(list_transform(list_zip(p, e), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
    FROM parts JOIN b{n} USING (k)) GROUP BY r, k)""")
        if n < 6:
            steps.append(f"""
s{n} AS (
  SELECT k, m % 16 AS i, j, sum(p[j])::BIGINT AS s, count(*) AS c FROM parts JOIN d{n} USING (r, k), range(1, 9) q(j)
  WHERE j <= len(p) GROUP BY ALL),
b{n + 1} AS MATERIALIZED (
  SELECT b.k, b.i, coalesce(m.e, b.e) AS e FROM b{n} b LEFT JOIN (
    SELECT k, i, list((s - ((s % c) + c) % c) // c ORDER BY j) AS e FROM s{n} GROUP BY k, i) m ON m.k = b.k AND m.i = b.i)""")
    return ",".join(steps) + """,
coded AS (
  SELECT r, string_agg(lower(printf('%02x', m % 16)), '' ORDER BY k) AS code, sum(m // 16)::BIGINT AS error FROM d6 GROUP BY r)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       sha256((SELECT string_agg(array_to_string(e, ','), ',' ORDER BY k, i) FROM b6)) AS codebooks_sha256
FROM fine JOIN coded USING (r)"""


ORACLE_SQL = {"op12_vector_codes": _op12(), "op7_shard_by_bytes": _OP7, "op8_embedding_near_dedup": _OP8, "op10_license_scan": _OP10, "op1_mix_sources": _OP1, "op4_url_filter": _OP4, "op5_substring_dedup": _OP5}
