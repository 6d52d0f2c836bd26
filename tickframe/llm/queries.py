"""Registered queries of the corpus operators and, where SQL can express them, their DuckDB text."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickframe.llm import (fill_middle, filter_audit, html_extract, jaccard_join, language_id, lm_scoring, mixing, packing,
                           quality_rules, repeat_spans, resharding, token_counts, topk_search)
from tickframe.llm.common import fold_of, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return add


@query("op1_jaccard_join")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


@query("op2_token_counts")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op3_mixing")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "copies")


@query("op4_html_extraction")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


TOPK_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, (row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""


@query("op5_topk_search", TOPK_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query("op6_lm_scoring")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(table(spark, sf_dir, "documents"))


@query("op7_sharding")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the layout ``CRC-32 of the text modulo 16`` to 24 shards of equal bytes."""
    placed = resharding.reshard(table(spark, sf_dir, "documents"), lambda crc: F.pmod(crc, F.lit(resharding.OLD_SHARDS)),
                                lambda total: resharding.even_capacities(total, resharding.NEW_SHARDS))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "old_shard")


LANGUAGE_FOLDS, LANGUAGE_HELD_OUT = 3, 1


@query("op8_language_id")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold_of(F.col("doc_id"), LANGUAGE_FOLDS) == LANGUAGE_HELD_OUT
    found = language_id.identify(docs, language_id.train(docs, ~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


QUALITY_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0B\f\r]')) AS lines
  FROM documents),
m AS (
  SELECT row_number() OVER () AS r, doc_id, len(w)::BIGINT AS n_words, len(array_to_string(w, ''))::BIGINT AS word_chars,
         len(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, w, lines, len(string_split(text, chr(10))) AS n_lines,
         len(list_filter(lines, lambda x: regexp_matches(x, '^[ \t\n\x0B\f\r]*[•‣▪●○◦*-]'))) AS n_bullet_lines,
         len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[ \t\n\x0B\f\r]*$'))) AS n_ellipsis_lines FROM t),
s AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, w[i], w[i+1], w[i+2], w[i+3], w[i+4]) AS k
  FROM (SELECT r, w, unnest(range(1, n_words - 3)) AS i FROM m)),
c AS (SELECT r, count(DISTINCT i + d)::BIGINT AS n_repeat_words FROM s, range(5) AS o(d) WHERE k > 1 GROUP BY r),
a AS (SELECT m.*, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words FROM m LEFT JOIN c USING (r)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, greatest(n_words, 1) AS n FROM a)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (10 * n_symbols > 3 * n) AND NOT (word_chars < 2 * n OR word_chars > 14 * n)
       AND NOT (n_dup_lines >= 3 AND 10 * n_dup_lines > 3 * n_lines)
       AND NOT 2 * len(list_filter(w, lambda x: regexp_matches(x, '\p{L}'))) < n_words
       AND NOT (n_bullet_lines >= 5 AND 10 * n_bullet_lines > 9 * len(lines))
       AND NOT (n_ellipsis_lines >= 3 AND 10 * n_ellipsis_lines > 3 * len(lines)) AS kept
FROM b
"""


@query("op9_quality_rules", QUALITY_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op10_packing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


FILL_MIDDLE_SQL = r"""
WITH h AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS k,
         regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u FROM documents),
r AS (
  SELECT doc_id, text, u, len(u)::BIGINT AS n, ('0x' || k[1:8])::BIGINT AS h1, ('0x' || k[9:16])::BIGINT AS h2,
         ('0x' || k[17:24])::BIGINT AS h3, ('0x' || k[25:32])::BIGINT AS h4 FROM h),
f AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90
              THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM r),
c AS (
  SELECT *, coalesce(array_to_string(u[1:a], ''), '') AS p, coalesce(array_to_string(u[a + 1:b], ''), '') AS m,
         coalesce(array_to_string(u[b + 1:], ''), '') AS s FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p)::BIGINT END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(text) AS restored_sha256
FROM c
"""


@query("op11_fill_middle", FILL_MIDDLE_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.fill_in_middle(table(spark, sf_dir, "documents")).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


FILTER_AUDIT_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+') AS w FROM documents),
l AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
m AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         (len(w) < 100)::INT + 2 * (100 * len(list_distinct(w)) < 80 * len(w))::INT
         + 4 * (100 * len(regexp_replace(text, '[^A-Z]+', '', 'g')) > 10 * len(text))::INT
         + 8 * regexp_matches(text, '[#$%&*|]')::INT
         + 16 * coalesce(t.doc_id > min(t.doc_id) OVER (PARTITION BY text), false)::INT AS mask
  FROM t LEFT JOIN l USING (doc_id)),
k AS (SELECT part, mask, good, toxic, count(*) AS n FROM m GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS bit),
o AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM x a, x b, x c, x d, x e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
    AND (a.bit | b.bit | c.bit | d.bit | e.bit) = 31),
s AS (
  SELECT filter_order, step::INTEGER AS step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INTEGER AS prior
  FROM o, range(1, 6) AS r(step)),
c AS (
  SELECT part, filter_order, step, bit,
         coalesce(sum(n) FILTER (mask & bit = 0 AND mask & prior = 0), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (mask & bit > 0 AND mask & prior = 0), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (mask & bit > 0 AND mask & prior > 0), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails,
         coalesce(sum(n) FILTER (mask & bit > 0 AND mask & prior = 0 AND good = 1), 0)::BIGINT AS good_lost,
         coalesce(sum(n) FILTER (mask & bit > 0 AND mask & prior = 0 AND toxic = 1), 0)::BIGINT AS toxic_lost
  FROM k, s GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM c
"""


@query("op12_filter_audit", FILTER_AUDIT_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op13_suffix_dedup")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeat_spans.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["stop"] - s["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))
