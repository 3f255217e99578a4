"""Registered queries of the training-data operators and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .decontam import match_digest
from .jaccard import component_digest
from .lexical import rank_digest
from .licenses import license_digest
from .lines import line_digest
from .mixing import mix_digest
from .pieces import token_digest
from .quality import quality_digest
from .spelling import variant_digest
from .topk import top_digest
from .toxicity import toxicity_digest
from .wrappers import text_digest
from .warc import record_digest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register("op1_line_dedup", r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
k AS (
  SELECT doc_id, pos, line,
         trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key
  FROM l),
s AS (
  SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
j AS (
  SELECT k.doc_id, k.pos, k.line, s.keeper IS NOT NULL AND s.keeper <> k.doc_id AS gone
  FROM k LEFT JOIN s ON k.key = s.key)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
""")
def op1_line_dedup(spark, sf_dir):
    return line_digest(table(spark, sf_dir, "documents"))


@register("op2_decontamination")
def op2_decontamination(spark, sf_dir):
    return match_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op7_license_scan")
def op7_license_scan(spark, sf_dir):
    return license_digest(table(spark, sf_dir, "documents"))


@register("op6_sentencepiece")
def op6_sentencepiece(spark, sf_dir):
    return token_digest(table(spark, sf_dir, "documents"))


@register("op8_topk_search", """
WITH v AS (
  SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0),
r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score FROM r WHERE rank <= 5
""")
def op8_topk_search(spark, sf_dir):
    return top_digest(table(spark, sf_dir, "embeddings"))


@register("op10_warc")
def op10_warc(spark, sf_dir):
    return record_digest(table(spark, sf_dir, "pages"))


@register("op5_ngram_jaccard_join")
def op5_ngram_jaccard_join(spark, sf_dir):
    return component_digest(table(spark, sf_dir, "documents"))


@register("op9_html_extraction")
def op9_html_extraction(spark, sf_dir):
    return text_digest(table(spark, sf_dir, "pages"))


@register("op3_toxicity")
def op3_toxicity(spark, sf_dir):
    return toxicity_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op4_quality_classifier")
def op4_quality_classifier(spark, sf_dir):
    return quality_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


# crc32 bit by bit into a table, then byte by byte; near words by their one-letter deletions.
@register("op11_spelling_variants", r"""
WITH RECURSIVE steps(i, c, k) AS (
  SELECT i, i, 0 FROM range(256) t(i) UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS tbl FROM steps WHERE k = 8),
runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM (
    SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents)
  WHERE length(run) >= 7),
said AS (
  SELECT run, count(*) AS n, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS said
  FROM runs GROUP BY doc_id, run),
summed AS (
  SELECT run, n, xor(4294967295, list_reduce(
    list_transform(range(length(said) // 2), lambda i: CAST('0x' || substr(said, 2 * i + 1, 2) AS BIGINT)),
    lambda c, b: xor(c >> 8, tbl[(xor(c, b) & 255) + 1]), 4294967295)) AS h
  FROM said, crc),
slipped AS (
  SELECT CASE WHEN h % 31 = 0 THEN left(run, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2)
              ELSE run END AS word, n FROM summed),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM slipped WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
cuts AS (
  SELECT word, n, i, left(word, i) || substr(word, i + 2) AS short FROM (
    SELECT word, n, unnest(range(length(word))) AS i FROM words)),
pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM cuts a JOIN cuts b ON a.i = b.i AND a.short = b.short AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.short = b.word
  UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.short = b.word),
top AS (
  SELECT word, near, near_n, count(*) OVER (PARTITION BY word) AS n_near FROM pairs
  QUALIFY row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) = 1),
forms AS (
  SELECT w.word, CASE WHEN near_n >= 10 * n THEN near END AS form, n, coalesce(n_near, 0) AS n_near,
         CASE WHEN near_n >= 10 * n THEN near_n END AS form_n
  FROM words w LEFT JOIN top USING (word)),
chain(word, last, depth) AS (
  SELECT word, word, 0 FROM forms UNION ALL
  SELECT c.word, f.form, depth + 1 FROM chain c JOIN forms f ON f.word = c.last WHERE f.form IS NOT NULL)
SELECT word, form, root, n, n_near, form_n
FROM forms JOIN (SELECT word, arg_max(last, depth) AS root FROM chain GROUP BY word) USING (word)
""")
def op11_spelling_variants(spark, sf_dir):
    return variant_digest(table(spark, sf_dir, "documents"))


# The water level by sorting sources by cap over weight, the documents by running sums.
@register("op12_source_mixing", r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS key FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS s,
         [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w FROM d GROUP BY source),
o AS (
  SELECT *, sum(s) OVER () AS total, sum(w) OVER () AS weight,
         coalesce(sum(3 * s) OVER up, 0) AS words_below, coalesce(sum(w) OVER up, 0) AS weight_below
  FROM s WINDOW up AS (ORDER BY s / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT *, 3 * s * (weight - weight_below) < (total - words_below) * w AS clamped FROM o),
level AS (
  SELECT any_value(total) - coalesce(sum(3 * s) FILTER (clamped), 0) AS free,
         any_value(weight) - coalesce(sum(w) FILTER (clamped), 0) AS left_weight FROM c),
t AS (
  SELECT source, s, CASE WHEN clamped THEN CAST(3 * s AS DOUBLE) ELSE CAST(free * w AS DOUBLE) / left_weight END AS target,
         CASE WHEN clamped THEN 3 * s ELSE (free * w) // left_weight END AS words FROM c, level),
r AS (
  SELECT d.*, s, target, CASE WHEN s > 0 THEN words // s ELSE 0 END AS whole, CASE WHEN s > 0 THEN words % s ELSE 0 END AS rest,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, size, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
           AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, s AS source_size, target, CAST(whole * size + greatest(0, least(size, rest - before)) AS BIGINT) AS taken FROM r
""")
def op12_source_mixing(spark, sf_dir):
    return mix_digest(table(spark, sf_dir, "documents"))


@register("op13_lexical_search", r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
tf AS (
  SELECT r, term, count(*) AS tf FROM (
    SELECT r, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term FROM d)
  GROUP BY r, term),
docs AS (SELECT r, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY r),
g AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_words FROM docs),
df AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, g GROUP BY term, n_docs),
q AS (
  SELECT item_id, term, count(*) AS c FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term FROM benchmark)
  GROUP BY item_id, term),
s AS (
  SELECT item_id, r, CAST(sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_words)))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN df USING (term) JOIN docs USING (r), g GROUP BY item_id, r),
k AS (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
  FROM s JOIN d USING (r) WHERE score > 0 AND doc_id IS NOT NULL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM k WHERE rank <= 20
""")
def op13_lexical_search(spark, sf_dir):
    return rank_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
