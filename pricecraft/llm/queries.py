"""Registered queries of the training-data operators, with production
parameters over the whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, jaccard, langid, neardup, packing, periodic, pfor, ppm, rules, sites, toxicity, trie, warc
from .common import crc_mod, save

QUERIES = {}
ORACLES: dict[str, str] = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(table(spark, sf_dir, "documents"),
                                  public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@register
def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                  with_ids=False)


@register
def op8_pfor_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = pfor.write_token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pfor.read_token_files(files, {"ids_crc32": F.crc32("ids")})


@register
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify_held_out(table(spark, sf_dir, "documents"))


@register
def op10_ppm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.held_out_scores(table(spark, sf_dir, "documents"))


@register
def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


@register
def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "embeddings"))


@register
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_held_out(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.quality_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register
def op5_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sites.held_out_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation c opens with the first crc32(c) % 4 turns of c - c % 20."""
    c = F.col("conv_id")
    numbered = save(trie.number_turns(table(spark, sf_dir, "conversations")), "numbered")
    turns, members = trie.share_heads(numbered, c - c % 20, crc_mod(c, 4), 3)
    return trie.prefix_trie(turns, members)


ORACLES["op11_prefix_trie"] = r"""
WITH crc_table AS (
  SELECT list(c ORDER BY n) AS t FROM (
    SELECT n, list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, x: CASE WHEN a & 1 = 1 THEN xor(3988292384, a >> 1) ELSE a >> 1 END) AS c
    FROM range(256) r(n))),
turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS i
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, conv_id - conv_id % 20 AS donor,
         xor(list_reduce(list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
                         lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM turns), crc_table),
rebuilt AS (
  SELECT c.conv_id, 0 AS part, i, role, text FROM convs c JOIN turns t ON t.conv_id = c.donor AND t.i < c.h
  UNION ALL
  SELECT c.conv_id, 1, i, role, text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.i >= c.h),
paths AS (
  SELECT c.conv_id, coalesce(p.path, []) AS path
  FROM convs c LEFT JOIN (SELECT conv_id, list({'role': role, 'text': text} ORDER BY part, i) AS path FROM rebuilt GROUP BY conv_id) p USING (conv_id)),
members AS (SELECT conv_id, len(path) AS n, d AS depth, path[1:d] AS node FROM paths, unnest(range(len(path) + 1)) u(d)),
nodes AS (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = depth), '') AS ends,
         CASE WHEN depth = 0 THEN 0 ELSE len(regexp_extract_all(node[depth].text, '[^ 	-
]+')) END AS words
  FROM members GROUP BY node, depth),
linked AS (SELECT n.*, p.conv_id AS parent_conv_id FROM nodes n LEFT JOIN nodes p ON n.depth > 0 AND p.depth = n.depth - 1 AND p.node = n.node[1:n.depth - 1]),
kids AS (SELECT node[1:depth - 1] AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
full_nodes AS (SELECT l.*, coalesce(n_children, 0) AS n_children FROM linked l LEFT JOIN kids k ON k.node = l.node),
below AS (
  SELECT node[1:d] AS node, sum((n_children = 0)::BIGINT) AS n_leaves, sum((n_convs - 1) * words) AS saved_tokens
  FROM full_nodes, unnest(range(depth + 1)) u(d) GROUP BY 1)
SELECT conv_id, depth::BIGINT AS depth, parent_conv_id, n_convs, n_children::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves,
       saved_tokens::BIGINT AS saved_tokens, sha256(ends) AS ends_sha256
FROM full_nodes f JOIN below b ON b.node = f.node
"""


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text): every tenth document by h = crc32(doc_id) repeats its
    words from a = g % n on with period p = 1 + (n - a) div (3 + g % 8), g = h div 10."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    text = F.coalesce("text", F.lit(""))
    d = docs.select("doc_id", text.alias("text"), F.floor(h / 10).alias("g"),
                    F.when(h % 10 == 0, F.regexp_extract_all(text, F.lit(trie.WORD), F.lit(0))).alias("words"))
    d = d.withColumn("n", F.when(F.size("words") > 0, F.size("words")))
    d = d.withColumn("a", (F.col("g") % F.col("n")).cast("int")).withColumn("rest", F.col("n") - F.col("a"))
    d = d.withColumn("p", (1 + F.floor(F.col("rest") / (3 + F.col("g") % 8))).cast("int"))
    turns = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), F.ceil(F.col("rest") / F.col("p")).cast("int")))
    planted = F.concat(F.slice("words", F.lit(1), F.col("a")), F.slice(turns, F.lit(1), F.col("rest")))
    return d.select("doc_id", F.when(F.col("n").isNotNull(), F.array_join(planted, " ")).otherwise(F.col("text")).alias("text"))


@register
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(with_planted_runs(table(spark, sf_dir, "documents")))
    best = periodic.greatest_run(F.col("runs"))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


@register
def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read_pages(spark, warc.archive_pages(table(spark, sf_dir, "pages")))


ORACLES["op13_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html)) AS n, sha256(html) AS digest,
             CASE WHEN octet_length(encode(html)) >= 100 THEN min(page_id) OVER (PARTITION BY html) ELSE page_id END AS first FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM d
"""
