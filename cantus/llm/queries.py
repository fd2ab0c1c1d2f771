"""The corpus operators as registered queries over the given tables, with SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from . import byte_bpe, decontamination, embedding_dedup, exact_dedup, filter_audit, hard_negatives, line_dedup, lm_scoring, packing, quality, simhash, substring_dedup, token_counts
from .common import BLANKS, table

QUERIES: dict = {}
ORACLES: dict = {}


def _query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@_query("op1_best_fit_packing")
def _(spark, sf):
    return packing.pack_documents(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"), seq_len=2048, end_id=0)


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), windows AS (
  SELECT doc_id, s, array_to_string(w[s:s + 19], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM d WHERE len(w) >= 20)
), later AS (
  SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS rn FROM windows) WHERE rn > 1
), gone AS (
  SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(s, s + 20)) AS p FROM later)
), words AS (
  SELECT doc_id, p, w[p] AS word FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM d)
), kept AS (
  SELECT words.doc_id, count(gone.p) AS n_removed, string_agg(word, ' ' ORDER BY words.p) FILTER (WHERE gone.p IS NULL) AS t
  FROM words LEFT JOIN gone ON words.doc_id = gone.doc_id AND words.p = gone.p GROUP BY words.doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id
"""


@_query("op2_substring_dedup", OP2_SQL)
def _(spark, sf):
    done = substring_dedup.substring_dedup(table(spark, sf, "documents").select("doc_id", "text"), window=20)
    kept = F.btrim(F.regexp_replace(F.coalesce("text", F.lit("")), BLANKS, " "), F.lit(" "))
    return done.select("doc_id", "n_words", "n_removed", F.sha2(kept, 256).alias("kept_sha256"))


@_query("op3_simhash_near_dedup")
def _(spark, sf):
    return simhash.simhash_groups(table(spark, sf, "documents"), width=3, bits=3)


@_query("op4_lm_scoring")
def _(spark, sf):
    return lm_scoring.lm_scores(table(spark, sf, "documents"), parts=7, held_out=2)


OP5_SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM d
"""


@_query("op5_exact_dedup", OP5_SQL)
def _(spark, sf):
    return exact_dedup.exact_groups(table(spark, sf, "documents"))


@_query("op6_byte_bpe")
def _(spark, sf):
    return byte_bpe.round_trip(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


OP7_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.98
), reach(node, root) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT links.b, reach.root FROM reach JOIN links ON links.a = reach.node
), root AS (SELECT node, min(root) AS component_id FROM reach GROUP BY node),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n.n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN root ON vec_id = node LEFT JOIN n ON vec_id = n.a
"""


@_query("op7_embedding_near_dedup", OP7_SQL)
def _(spark, sf):
    return embedding_dedup.embedding_groups(table(spark, sf, "embeddings"), threshold=0.98)


@_query("op8_token_counts")
def _(spark, sf):
    return token_counts.token_counts(table(spark, sf, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@_query("op9_line_dedup")
def _(spark, sf):
    done = line_dedup.line_run_dedup(table(spark, sf, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_lines", "n_removed_lines", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@_query("op10_quality_classifier")
def _(spark, sf):
    return quality.quality_scores(table(spark, sf, "documents"), table(spark, sf, "labels"), parts=3, held_out=1)


OP11_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), mask AS (
  SELECT doc_id, part, (CASE WHEN len(w) < 200 THEN 1 ELSE 0 END) + (CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END)
    + (CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 4 ELSE 0 END)
    + (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END) + (CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END) AS m
  FROM d
), known AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id
), cell AS (
  SELECT part, m, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic FROM mask LEFT JOIN known ON mask.doc_id = known.doc_id GROUP BY part, m
), letter(f) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM letter a, letter b, letter c, letter d, letter e
  WHERE a.f NOT IN (b.f, c.f, d.f, e.f) AND b.f NOT IN (c.f, d.f, e.f) AND c.f NOT IN (d.f, e.f) AND d.f <> e.f
), steps AS (
  SELECT filter_order, step, (1 << (ascii(substr(filter_order, step, 1)) - 65)) AS own,
    list_sum(list_transform(range(1, 6), lambda i: CASE WHEN i < step THEN 1 << (ascii(substr(filter_order, i, 1)) - 65) ELSE 0 END))::INTEGER AS gone
  FROM (SELECT filter_order, unnest(range(1, 6))::INTEGER AS step FROM orders)
), told AS (
  SELECT part, filter_order, step, m, own, n, good, toxic, m & own <> 0 AS fails, m & gone <> 0 AS out FROM cell, steps
)
SELECT part, filter_order, step, sum(CASE WHEN NOT fails AND NOT out THEN n ELSE 0 END)::BIGINT AS kept,
  sum(CASE WHEN fails AND NOT out THEN n ELSE 0 END)::BIGINT AS removed, sum(CASE WHEN fails AND out THEN n ELSE 0 END)::BIGINT AS redundant,
  sum(CASE WHEN m = own THEN n ELSE 0 END)::BIGINT AS unique_fails, sum(CASE WHEN fails AND NOT out THEN good ELSE 0 END)::BIGINT AS good_lost,
  sum(CASE WHEN fails AND NOT out THEN toxic ELSE 0 END)::BIGINT AS toxic_lost, sum(CASE WHEN fails THEN n * (120 // bit_count(m)) ELSE 0 END)::BIGINT AS shapley
FROM told GROUP BY part, filter_order, step
"""


@_query("op11_filter_audit", OP11_SQL)
def _(spark, sf):
    return filter_audit.filter_audit(table(spark, sf, "documents"), table(spark, sf, "labels"))


OP12_SQL = r"""
WITH dw AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents
), bw AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark
), item AS (
  SELECT DISTINCT item_id, n, array_to_string(w[s:s + n - 1], ' ') AS k
  FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS s FROM bw WHERE len(w) > 0)
), place AS (
  SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS k
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM dw, (SELECT DISTINCT n FROM item) AS lengths WHERE len(w) >= n)
), hit AS (
  SELECT doc_id, s, place.n, item_id FROM place JOIN item ON place.n = item.n AND place.k = item.k
), words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM (SELECT DISTINCT doc_id, s, n FROM hit)) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM hit) GROUP BY doc_id
)
SELECT dw.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM dw LEFT JOIN words ON dw.doc_id = words.doc_id LEFT JOIN items ON dw.doc_id = items.doc_id
"""


@_query("op12_benchmark_decontamination", OP12_SQL)
def _(spark, sf):
    done = decontamination.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"), window=10)
    listed = F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256")
    return done.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), listed, "contaminated")


OP13_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.e, b.e)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
), positive AS (
  SELECT anchor_id, vec_id AS positive_id, score FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS r FROM pairs WHERE same) WHERE r <= 5
), negative AS (
  SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY n.score DESC, n.vec_id) AS rank,
    n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
  FROM positive p JOIN pairs n ON p.anchor_id = n.anchor_id AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM negative WHERE rank <= 3
"""


@_query("op13_hard_negatives", OP13_SQL)
def _(spark, sf):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0, label=label)


@_query("pipeline")
def _(spark, sf):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf)
