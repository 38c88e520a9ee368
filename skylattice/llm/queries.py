"""The operators as queries on the given tables, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    chat_format,
    decontamination,
    hard_negatives,
    kneser_ney,
    language_id,
    line_dedup,
    quality_classifier,
    quality_rules,
    sentencepiece_dropout,
    sharding,
    simhash_dedup,
    token_alignment,
    token_counts,
)

Query = Callable[[SparkSession, str], DataFrame]
SHARDS = 8
TOKEN_LIMIT = 2048
LEAST_QUALITY = 0.3


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def fold(of: int) -> Column:
    """crc32 of the document's number as text, modulo ``of``; a null is in fold 0."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % of, F.lit(0))


def op1_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{folder}/benchmark.parquet")
    found = decontamination.contaminated(documents(spark, folder), benchmark)
    return found.select("doc_id", "item_id", "similarity", "start", "n_words")


def op2_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    return chat_format.format_chats(spark.read.parquet(f"{folder}/conversations.parquet"))


def op3_shards(spark: SparkSession, folder: str) -> DataFrame:
    size = (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long")
    docs = documents(spark, folder).select("doc_id", size.alias("size"), F.crc32("text").alias("text_crc32"))
    placed = sharding.shard_rows(docs, [F.col("doc_id"), F.col("text_crc32"), F.col("size")], SHARDS)
    law = {"law": F.lit("rows"), "grown_shard": F.lit(None).cast("int")}
    return placed.withColumns(law).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "row_number")


def op4_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    done = sentencepiece_dropout.encode_checked(documents(spark, folder), path, F.col("doc_id"))
    return done.select("doc_id", "n_pieces", "lossless", "ids")


def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash_dedup.near_duplicates(documents(spark, folder))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    rated = quality_rules.apply_rules(documents(spark, folder))
    return rated.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.remove_boilerplate(documents(spark, folder)).select("doc_id", "text", "n_removed")


def op8_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    held = fold(3) == 1
    network = language_id.fit(docs.where(~held))
    return language_id.predict(docs, network).select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    counted = token_counts.count_tokens(documents(spark, folder), path)
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return counted.select("doc_id", size.alias("n_bytes"), "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def op10_kneser_ney(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    held = fold(7) == 2
    model = kneser_ney.train(docs.where(~held))
    scored = kneser_ney.score(docs, model)
    return scored.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op11_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    paths = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    found = token_alignment.link_statistics(documents(spark, folder).select("doc_id", "text"), *paths)
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_overlaps", "n_shared")


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    table = spark.read.parquet(f"{folder}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    known = table.where(hard_negatives.complete(F.col("embedding"), F.col("label")))
    vectors = known.select("vec_id", label.alias("label"), hard_negatives.whole_numbers(F.col("embedding")).alias("vector"))
    return hard_negatives.mine(vectors, F.coalesce(F.col("vec_id") % 100 == 0, F.lit(False)))


def op13_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs, held = documents(spark, folder), fold(5) == 0
    labels = spark.read.parquet(f"{folder}/labels.parquet").where(~held)
    scored = quality_classifier.score(docs, quality_classifier.fit(labels, docs))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= LEAST_QUALITY).cast("int").alias("predicted"))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder)


_QUERIES = (
    op1_decontaminate, op2_chat_format, op3_shards, op4_sentencepiece, op5_simhash, op6_quality,
    op7_line_dedup, op8_language, op9_token_counts, op10_kneser_ney, op11_token_alignment, op12_hard_negatives,
    op13_quality_classifier, pipeline,
)


def registry() -> dict[str, Query]:
    return {q.__name__: q for q in _QUERIES}


_WORD = r"'[^\x20\x09-\x0D]+'"

_OP1 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents WHERE text IS NOT NULL),
b AS (SELECT DISTINCT item_id, w, len(w) AS n FROM
      (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM benchmark) WHERE len(w) >= 5),
bs AS (SELECT item_id, w, n, list_transform(range(1, n - 3), lambda i: array_to_string(w[i:i + 4], ' ')) AS s FROM b),
bq AS (SELECT item_id, n, unnest(s) AS sh, unnest(range(0, n - 4)) AS q FROM bs),
ds AS (SELECT doc_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS sh,
              unnest(range(0, len(w) - 4)) AS p, len(w) AS nd FROM d WHERE len(w) >= 5),
hits AS (SELECT DISTINCT doc_id, item_id, greatest(least(p - q, greatest(nd - n, 0)), 0) AS start FROM ds JOIN bq USING (sh)),
win AS (SELECT h.doc_id, h.item_id, h.start, bs.n, bs.s AS b, d.w[h.start + 1 : h.start + bs.n] AS x
        FROM hits h JOIN bs USING (item_id) JOIN d USING (doc_id)),
ws AS (SELECT *, list_transform(range(1, len(x) - 3), lambda i: array_to_string(x[i:i + 4], ' ')) AS a FROM win),
c AS (SELECT *, coalesce(list_sum(list_transform(list_intersect(a, b), lambda s:
        least(len(list_filter(a, lambda y: y = s)), len(list_filter(b, lambda y: y = s))))), 0) AS common FROM ws),
r AS (SELECT *, common / (len(a) + len(b) - common) AS similarity FROM c)
SELECT doc_id, item_id, similarity, start::BIGINT AS start, n::BIGINT AS n_words FROM r WHERE similarity >= 0.8
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start) = 1
"""

_OP6 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), {_WORD}) AS w,
             list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, {_WORD})) AS ls FROM documents),
win AS (SELECT doc_id, unnest(range(1, len(w) - 3)) AS i, w FROM d WHERE len(w) >= 5),
txt AS (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS s FROM win),
again AS (SELECT doc_id, i FROM txt QUALIFY count(*) OVER (PARTITION BY doc_id, s) > 1),
rep AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM again, range(0, 5) AS x(k) GROUP BY doc_id),
m AS (SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
        len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(ls)::BIGINT AS n_lines,
        (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
        len(list_filter(w, lambda x: lower(x) IN ({{stop}}))) AS n_stop,
        len(list_filter(ls, lambda l: regexp_matches(l, '^\s*[-*•]'))) AS n_bullets,
        len(list_filter(ls, lambda l: regexp_matches(l, '(\.\.\.|…)\s*$'))) AS n_ellipses
      FROM d LEFT JOIN rep USING (doc_id)),
f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
        coalesce(word_chars / nullif(n_words, 0), 0) BETWEEN 2.0 AND 25.0
        AND coalesce(n_symbols / nullif(n_words, 0), 0) <= 0.1
        AND (n_words < 50 OR n_stop / n_words >= 0.02)
        AND coalesce(n_dup_lines / nullif(n_lines, 0), 0) <= 0.3
        AND coalesce(n_bullets / nullif(n_lines, 0), 0) <= 0.9
        AND coalesce(n_ellipses / nullif(n_lines, 0), 0) <= 0.3 AS passed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND passed AS kept FROM f
"""

_OP7 = rf"""
WITH l AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
             unnest(range(0, len(string_split(text, chr(10))))) AS pos FROM documents WHERE text IS NOT NULL),
k AS (SELECT *, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS same,
        len(regexp_extract_all(line, {_WORD})) >= 1 AS asked FROM l),
b AS (SELECT same FROM k WHERE asked GROUP BY same HAVING count(DISTINCT source) >= 5),
g AS (SELECT k.*, asked AND b.same IS NOT NULL AND row_number() OVER (PARTITION BY asked, k.same ORDER BY doc_id, pos) > 1 AS gone
      FROM k LEFT JOIN b ON k.same = b.same),
t AS (SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text,
        count(*) FILTER (WHERE gone) AS n_removed FROM g GROUP BY doc_id)
SELECT d.doc_id, t.text, coalesce(t.n_removed, 0)::BIGINT AS n_removed FROM documents d LEFT JOIN t USING (doc_id)
"""


_OP12 = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, x.vec_id, a.label = x.label AS same, list_inner_product(a.e, x.e)::BIGINT AS score
      FROM v a JOIN v x ON a.vec_id <> x.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
        row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank
      FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""


def oracle() -> dict[str, str]:
    stop = ", ".join(f"'{w}'" for w in sorted({w for ws in quality_rules.STOP_WORDS.values() for w in ws}))
    return {"op1_decontaminate": _OP1, "op6_quality": _OP6.replace("{stop}", stop), "op7_line_dedup": _OP7, "op12_hard_negatives": _OP12}
