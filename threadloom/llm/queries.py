"""The numbered queries: each applies its operator, with production
parameters, to the whole of its table.  ``ORACLE`` holds DuckDB SQL where SQL
can express the result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.llm import (alignment, bpe, exact_dedup, html_text, licenses, merkle, near_dup, packing, parity_join, quality,
                            token_cache, topk, url_rules)
from threadloom.llm.fragments import TokenizerFile
from threadloom.llm.store import Scratch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> TokenizerFile:
    return TokenizerFile.read(public_tokenizers.path(name))


@register("op1_html_text")
def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(table(spark, sf_dir, "pages"))


@register("op2_near_dup")
def op2_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


@register("op3_exact_dedup", """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""")
def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


@register("op4_packing")
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


@register("op5_bpe")
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


@register("op6_top_k", """
WITH v AS (SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS e
           FROM embeddings WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
             AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0 AND len(embedding) > 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
             CAST(list_sum([p[1] * p[2] for p in list_zip(q.e, c.e)]) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20""")
def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


@register("op7_quality")
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = quality.draw(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return drawn.select("doc_id", "n_ngrams", "log_weight", "gumbel_key", "kept")


@register("op8_licenses")
def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


_RULES_SQL = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in url_rules.CONTRACT_RULES)


@register("op9_url_rules", f"""
WITH rules(h, p, verdict) AS (VALUES {_RULES_SQL}),
a AS (SELECT page_id, row_number() OVER () AS rid, url, instr(coalesce(url, ''), '://') AS mark FROM pages),
b AS (SELECT page_id, rid, CASE WHEN mark > 0 THEN substr(url, mark + 3) ELSE '' END AS rest FROM a),
c AS (SELECT page_id, rid,
             translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                       'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM b),
d AS (SELECT c.*, h || p AS rule, verdict, row_number() OVER (PARTITION BY rid ORDER BY length(h || p) DESC) AS n
      FROM c LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM d WHERE n = 1""")
def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_urls(table(spark, sf_dir, "pages"), url_rules.rule_table(spark))


@register("op10_token_counts")
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Starts from an empty cache of its own, so that every run counts every text."""
    cache = Scratch(spark, "token-counts").path("cache")
    counted = token_cache.count_tokens(table(spark, sf_dir, "documents"), cache, tokenizer("word_bpe_49k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


@register("op11_alignment")
def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = alignment.PieceModel.read(public_tokenizers.path("piece_bpe_32k.model"))
    return alignment.align(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), pieces)


@register("op12_merkle", """
WITH RECURSIVE d AS (
  SELECT *, row_number() OVER () AS rid,
         coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
           || coalesce(strlen(lang) || ':' || lang, '-') AS head,
         coalesce(strlen("text") || ':' || "text", '-') AS tail, CAST(doc_id AS VARCHAR) AS s FROM documents),
e AS (
  SELECT rid, doc_id, lang, sha256(head || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || tail) AS leaf,
         sha256(head || coalesce(strlen(CAST(CAST(n_chars AS HUGEINT) + 1 AS VARCHAR)) || ':' || (CAST(n_chars AS HUGEINT) + 1), '-')
                || tail) AS changed,
         xor(4294967295, list_reduce(list_concat([CAST(4294967295 AS BIGINT)], flatten([[(ord(s[k]) >> b) & 1 for b in range(8)]
             for k in range(1, length(s) + 1)])), lambda c, bit: xor(c >> 1, (xor(c, bit) & 1) * 3988292384))) % 7 = 0 AS hit
  FROM d),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n,
         dense_rank() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS tree FROM e),
lev(tree, h, j, n, node) AS (
  SELECT tree, 0, i, n, leaf FROM leaves
  UNION ALL
  SELECT tree, h + 1, j // 2, (max(n) + 1) // 2, sha256(string_agg(node, '' ORDER BY j)) FROM lev WHERE n > 1 GROUP BY tree, h, j // 2),
subroots AS (SELECT tree, node AS subroot, count(*) OVER () AS langs FROM lev WHERE n = 1),
up(h, j, n, node) AS (
  SELECT 0, tree, langs, subroot FROM subroots
  UNION ALL
  SELECT h + 1, j // 2, (max(n) + 1) // 2, sha256(string_agg(node, '' ORDER BY j)) FROM up WHERE n > 1 GROUP BY h, j // 2),
way(rid, tree, h, j, n, proof, folded) AS (
  SELECT rid, tree, 0, i, n, '', CASE WHEN hit THEN changed ELSE leaf END FROM leaves
  UNION ALL
  SELECT rid, w.tree, w.h + 1, w.j // 2, (w.n + 1) // 2, proof || coalesce(s.node, ''),
         sha256(CASE WHEN s.node IS NULL THEN folded WHEN w.j % 2 = 0 THEN folded || s.node ELSE s.node || folded END)
  FROM way w LEFT JOIN lev s ON s.tree = w.tree AND s.h = w.h AND s.j = xor(w.j, 1) WHERE w.n > 1),
higher(rid, h, j, n, proof, folded) AS (
  SELECT rid, 0, tree, (SELECT count(*) FROM subroots), proof, folded FROM way WHERE n = 1
  UNION ALL
  SELECT rid, w.h + 1, w.j // 2, (w.n + 1) // 2, proof || coalesce(s.node, ''),
         sha256(CASE WHEN s.node IS NULL THEN folded WHEN w.j % 2 = 0 THEN folded || s.node ELSE s.node || folded END)
  FROM higher w LEFT JOIN up s ON s.h = w.h AND s.j = xor(w.j, 1) WHERE w.n > 1)
SELECT doc_id, leaf, subroot, node AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = node AS verified
FROM higher JOIN leaves USING (rid) JOIN subroots USING (tree) CROSS JOIN (SELECT node FROM up WHERE n = 1) WHERE higher.n = 1""")
def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return merkle.manifest(table(spark, sf_dir, "documents"), tampered)[0]


@register("op13_jaccard_join")
def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity_join.jaccard_components(table(spark, sf_dir, "documents"))
