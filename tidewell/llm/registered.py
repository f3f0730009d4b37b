"""The queries of the operators and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import (decontaminate, egojoin, language, lines, lm, packing, quality, ranks, repair, secrets,
                          simhash, wavelet, whitening)
from tidewell.llm.common import documents, shared_dir
from tidewell.session import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = lm.held_out(F.col("doc_id"))
    scored = lm.score(documents(spark, sf_dir), ~held)
    return scored.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@_query
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup(documents(spark, sf_dir)).select("doc_id", "n_lines", "n_deleted", "text")


@_query
def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir))


@_query
def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.classes(documents(spark, sf_dir), width=3, bits=3)
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


@_query
def op5_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(documents(spark, sf_dir, "doc_id", "text", "source"))
    return found.select(F.col("row.doc_id").alias("doc_id"), F.col("at").cast("bigint").alias("word_at"),
                        F.length("name").cast("bigint").alias("place_in_word"),
                        F.sha2("value", 256).alias("value_sha256"), F.col("length").cast("bigint").alias("length"),
                        "label", "probability", "is_secret")


@_query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text", "lang").withColumn("held_out", language.held_out(F.col("doc_id")))
    model = language.train(docs.filter(~F.col("held_out")))
    return language.predict(docs.select("doc_id", "text", "held_out"), model)


@_query
def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.report(documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


ORACLES["op7_benchmark_decontamination"] = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
    FROM documents),
b AS (SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
    FROM benchmark),
g AS (SELECT DISTINCT item_id, least(len(w), 13) AS size, unnest(list_transform(range(1, len(w) - least(len(w), 13) + 2),
        lambda i: array_to_string(w[i : i + least(len(w), 13) - 1], ' '))) AS gram
    FROM b WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM g),
x AS (SELECT doc_id, size, unnest(list_transform(range(1, len(w) - size + 2),
        lambda i: {'i': i, 'gram': array_to_string(w[i : i + size - 1], ' ')})) AS p
    FROM d, sizes WHERE len(w) >= size),
h AS (SELECT x.doc_id, x.p.i AS i, x.size AS size, g.item_id AS item_id
    FROM x JOIN g ON g.size = x.size AND g.gram = x.p.gram),
hit AS (SELECT doc_id, count(*) AS n_hit
    FROM (SELECT DISTINCT doc_id, unnest(range(i, i + size)) AS p FROM h) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(s, ',' ORDER BY s)) AS sha
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    coalesce(sha, sha256('')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""


@_query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(documents(spark, sf_dir))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept", "posterior")


@_query
def op9_wavelet_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "wavelet")
    wavelet.write(documents(spark, sf_dir), path)
    return wavelet.read(spark, path)


@_query
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranks.count_tokens(documents(spark, sf_dir))


@_query
def op11_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return egojoin.classes(read_table(spark, sf_dir, "embeddings"), cosine=0.9)


ORACLES["op11_embedding_near_dedup"] = """
WITH RECURSIVE rows AS (SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings),
v AS (SELECT r, vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM rows
    WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT x.r AS a, y.r AS b FROM v x JOIN v y ON x.r <> y.r AND list_cosine_similarity(x.e, y.e) >= 0.9),
reach AS (SELECT r AS a, r AS b FROM rows UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a),
least AS (SELECT a, min(vec_id) AS component_id FROM reach JOIN rows ON rows.r = reach.b GROUP BY a),
n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT rows.vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
FROM rows JOIN least ON least.a = rows.r LEFT JOIN n ON n.a = rows.r
"""


@_query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    found, _ = repair.repair(repair.damaged(turns))
    every = turns.select("conv_id").distinct()
    zero = F.lit(0).cast("bigint")
    return every.join(found, F.col("conv_id").eqNullSafe(F.col("conv")), "left").select(
        "conv_id", *(F.coalesce(c, zero).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


@_query
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whitening.whiten(read_table(spark, sf_dir, "embeddings"), components=8)
    # beyond a long's range the exact sum is in deviation_exact only
    return white.select(F.col("id").alias("vec_id"), "component", "n", F.expr("try_cast(deviation AS bigint)").alias("deviation"),
                        "whitened", "explained", "identity_error", F.col("deviation").alias("deviation_exact"))
