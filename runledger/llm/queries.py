"""The operators' queries over the given tables and their SQL, as far as there is any."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runledger.llm import language_id, quality, toxicity
from runledger.llm.common import fold, read_table
from runledger.llm.decontamination import contamination
from runledger.llm.hard_negatives import hard_negatives
from runledger.llm.jaccard_join import near_duplicates
from runledger.llm.line_dedup import dedup_lines
from runledger.llm.merkle import folded, leaf_digest, manifest, path_digest
from runledger.llm.mixing import mix
from runledger.llm.neighbours import nearest
from runledger.llm.quality_rules import quality_rules
from runledger.llm.token_counts import token_counts
from runledger.llm.url_filters import judge_urls, rule_table

TOKEN_LIMIT = 512
NEIGHBOURS = 20
RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents: sizes, targets by source and what is taken."""
    mixed = mix(read_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source", "source_size", "target", "copies", "taken")


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of all other rows for every row whose id 20 divides."""
    vectors = read_table(spark, sf_dir, "embeddings")
    return nearest(vectors, F.col("id") % 20 == 0, NEIGHBOURS)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned from labels of four fifths of the ids."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels")
    network = toxicity.learn(docs, labels, fold("_id", 5) != 0)
    scored = toxicity.toxicity(docs, network)
    held_out = F.coalesce(fold("doc_id", 5) == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, deciding rule and verdict of all pages."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    judged = judge_urls(pages, rule_table(spark, RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents, learned from two thirds of the ids."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.learn(
        docs, fold("doc_id", 3) != 1, public_tokenizers.path("piece_bpe_32k.model")
    )
    held_out = F.coalesce(fold("doc_id", 3) == 1, F.lit(False)).alias("held_out")
    found = language_id.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out, "lang_pred", "score")


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingle count and component of near copies of all documents."""
    found = near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without lines that are near copies of earlier ones."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "text", "n_lines", "n_removed")


def grades(labels: DataFrame) -> DataFrame:
    """Ratings made of two marks: 0 for poor text, 1 for good but toxic text, 2 for good."""
    clean = 1 - F.coalesce("toxic", F.lit(0))
    return labels.select("doc_id", F.when(F.col("quality") == 1, 1 + clean).otherwise(
        F.col("quality")).alias("grade"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade and tail probability of all documents, learned from four fifths of the ids."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    ratings = grades(read_table(spark, sf_dir, "labels"))
    model = quality.learn(docs, ratings, fold("_id", 5) != 0)
    held_out = F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out")
    return quality.quality(docs, model, least=1).select(
        "doc_id", held_out, "expected_grade", "tail_probability", "selected"
    )


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents that stand in benchmark windows, and the items hit."""
    docs = read_table(spark, sf_dir, "documents")
    found = contamination(docs, read_table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"
    )


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of all documents."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"), TOKEN_LIMIT)
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to 10 hard negatives for each of the first 5 positives of each anchor."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(read_table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, label)


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of all documents and whether the rules and their perplexity keep them."""
    judged = quality_rules(read_table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "perplexity",
    )


LEAF_FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all documents, and whether each proof leads from what half of the
    documents became without their line feeds to the root."""
    docs = read_table(spark, sf_dir, "documents")
    shortened = leaf_digest(*LEAF_FIELDS[:-1], F.replace("text", F.lit("\n"), F.lit("")))
    tampered = F.when((fold("doc_id", 2) == 0) & F.contains("text", F.lit("\n")), shortened)
    found = manifest(docs, LEAF_FIELDS, carry={"tampered": tampered})
    found = found.withColumn("folded_root", folded(F.coalesce("tampered", "leaf"), F.col("path")))
    return found.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root",
        path_digest(F.col("path")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_neighbours": op2_neighbours,
    "op3_toxicity": op3_toxicity,
    "op4_url_filters": op4_url_filters,
    "op5_language_id": op5_language_id,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_line_dedup": op7_line_dedup,
    "op8_quality": op8_quality,
    "op9_decontamination": op9_decontamination,
    "op10_token_counts": op10_token_counts,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_quality_rules": op12_quality_rules,
    "op13_merkle": op13_merkle,
}

URL_RULES_SQL = """
WITH parsed AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0
                       THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), split AS (
  SELECT page_id, lower(regexp_extract(rest, '^[^/?#]*', 0)) AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parsed
), rules(rhost, rpath, verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
         ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
)
SELECT s.page_id, s.host, s.path,
       (SELECT rhost || rpath FROM rules
        WHERE (s.host = rhost OR ends_with(s.host, '.' || rhost)) AND starts_with(s.path, rpath)
        ORDER BY length(rhost || rpath) DESC LIMIT 1) AS rule,
       coalesce((SELECT verdict FROM rules
        WHERE (s.host = rhost OR ends_with(s.host, '.' || rhost)) AND starts_with(s.path, rpath)
        ORDER BY length(rhost || rpath) DESC LIMIT 1), 'allow') AS verdict
FROM split s
"""

NEIGHBOURS_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), pairs AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e) AS score
  FROM v q JOIN v c ON q.r <> c.r AND len(q.e) = len(c.e) WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (
    PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM pairs
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

HARD_NEGATIVES_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id AS id,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT a.r AS ar, a.id AS aid, c.r AS cr, c.id AS cid, a.label = c.label AS same,
         CAST(list_dot_product(a.e, c.e) AS BIGINT) AS score
  FROM v a JOIN v c ON a.r <> c.r AND len(a.e) = len(c.e) WHERE a.id % 100 = 0
), positives AS (
  SELECT ar, aid, cr, cid, score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY ar ORDER BY score DESC, cid, cr) <= 5
), ranked AS (
  SELECT p.aid AS anchor_id, p.cid AS positive_id,
         row_number() OVER (PARTITION BY p.ar, p.cr ORDER BY n.score DESC, n.cid, n.cr) AS rank,
         n.cid AS negative_id, p.score AS positive_score, n.score AS negative_score
  FROM positives p JOIN pairs n ON n.ar = p.ar AND NOT n.same
    AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score,
       negative_score
FROM ranked WHERE rank <= 10
"""

# Whether 2 divides crc32 is seen from the last bit of the plain bitwise division.
MERKLE_SQL = """
WITH RECURSIVE marked AS (
  SELECT *, list_reduce(list_concat([4294967295::BIGINT], list_transform(
      range(length(CAST(doc_id AS VARCHAR))),
      lambda i: CAST(ascii(CAST(doc_id AS VARCHAR)[i + 1]) AS BIGINT))),
    lambda crc, byte: list_reduce(
      list_concat([xor(crc, byte)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
      lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))) & 1 AS last_bit
  FROM documents
), hashed AS (
  SELECT doc_id, source,
         CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(doc_id::VARCHAR) || ':' || doc_id END
         || CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END
         || CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END
         || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(n_chars::VARCHAR) || ':' || n_chars END
         AS head, text,
         CASE WHEN doc_id IS NOT NULL AND last_bit = 1 THEN replace(text, chr(10), '') ELSE text END AS kept
  FROM marked
), leaves AS (
  SELECT doc_id, source,
         sha256(head || CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END) AS leaf,
         sha256(head || CASE WHEN kept IS NULL THEN '-' ELSE strlen(kept) || ':' || kept END) AS altered
  FROM hashed
), placed AS (
  SELECT *, row_number() OVER () AS r, row_number() OVER (
    PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, altered) - 1 AS pos FROM leaves
), up AS (
  SELECT source, 0 AS level, list(leaf ORDER BY pos) AS nodes FROM placed GROUP BY source
  UNION ALL
  SELECT source, level + 1, list_transform(range(0, len(nodes), 3),
    lambda i: sha256(array_to_string(nodes[i + 1:i + 3], ''))) FROM up WHERE len(nodes) > 1
), subroots AS (
  SELECT source, level AS height, nodes[1] AS subroot,
         row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS spos
  FROM up WHERE len(nodes) = 1
), top AS (
  SELECT 0 AS level, list(subroot ORDER BY spos) AS nodes FROM subroots
  UNION ALL
  SELECT level + 1, list_transform(range(0, len(nodes), 3),
    lambda i: sha256(array_to_string(nodes[i + 1:i + 3], ''))) FROM top WHERE len(nodes) > 1
), stops AS (
  SELECT p.r, u.level, u.nodes, p.pos // CAST(pow(3, u.level) AS BIGINT) AS i
  FROM placed p JOIN up u ON u.source IS NOT DISTINCT FROM p.source WHERE len(u.nodes) > 1
  UNION ALL
  SELECT p.r, s.height + t.level, t.nodes, s.spos // CAST(pow(3, t.level) AS BIGINT)
  FROM placed p JOIN subroots s ON s.source IS NOT DISTINCT FROM p.source, top t
  WHERE len(t.nodes) > 1
), siblings AS (
  SELECT r, level, coalesce(array_to_string(nodes[i - i % 3 + 1:i], ''), '') AS l,
         coalesce(array_to_string(nodes[i + 2:i - i % 3 + 3], ''), '') AS h FROM stops
), proofs AS (
  SELECT r, sha256(string_agg(l || h, '' ORDER BY level)) AS proof FROM siblings GROUP BY r
), folds AS (
  SELECT r, 0 AS level, altered AS node FROM placed
  UNION ALL
  SELECT f.r, f.level + 1, sha256(s.l || f.node || s.h)
  FROM folds f JOIN siblings s ON s.r = f.r AND s.level = f.level
), ends AS (
  SELECT r, arg_max(node, level) AS folded_root FROM folds GROUP BY r
)
SELECT p.doc_id, p.leaf, s.subroot, t.nodes[1] AS root, coalesce(q.proof, sha256('')) AS proof_sha256,
       e.folded_root, e.folded_root = t.nodes[1] AS verified
FROM placed p JOIN subroots s ON s.source IS NOT DISTINCT FROM p.source
  JOIN ends e ON e.r = p.r LEFT JOIN proofs q ON q.r = p.r, top t
WHERE len(t.nodes) = 1
"""

ORACLE: dict[str, str] = {
    "op2_neighbours": NEIGHBOURS_SQL,
    "op4_url_filters": URL_RULES_SQL,
    "op11_hard_negatives": HARD_NEGATIVES_SQL,
    "op13_merkle": MERKLE_SQL,
}
