"""The queries opN_* and pipeline: each applies its operator to whole tables with production parameters."""
from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import audio, bagminhash, decontaminate, html_paths, ngram_lm, pieces, quality_pu, token_counts, toxicity, warc
from .common import bounded_batches, held_out, table

#: Names of tokenizer files; their place is found by the package that has them.
WORD_TOKENIZER, PIECE_MODEL = "word_bpe_49k.json", "piece_bpe_32k.model"

#: Ids of target documents are broadcast (8 bytes each) up to this many; beyond that they are joined by hash partitions.
BROADCAST_IDS = 1_000_000


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted: nnPU learnt from trusted positives and unlabelled documents."""
    docs = table(spark, sf_dir, "documents")
    net, _ = quality_pu.train(docs, table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", held_out("doc_id").alias("held_out"), quality_pu.score_column(net, "text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= quality_pu.THRESHOLD).cast("int"))


def op2_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of each text stored as 8-bit sound, read back and analysed."""
    s = audio.features(audio.store(audio.encode(table(spark, sf_dir, "documents"))))
    return s.select(
        "doc_id", "n_bytes", F.octet_length("samples").cast("long").alias("payload_bytes"), F.sha2("samples", 256).alias("payload_sha256"), F.crc32(F.expr("substring(samples, -64)")).alias("tail_crc32"),
        F.octet_length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"), "feature",
    )


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, class_id, kept: classes of documents linked by a weighted Jaccard similarity of 0.8 or more."""
    c = bagminhash.classes(table(spark, sf_dir, "documents"))
    return c.withColumn("kept", F.col("doc_id") == F.col("class_id"))


def op4_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_pieces, n_byte_pieces, ids_sha256 and whether decoding gives the text back."""
    path = public_tokenizers.path(PIECE_MODEL)
    docs = pieces.encode_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    ids, text = F.col("piece_ids"), F.coalesce("text", F.lit(""))
    kinds = pieces.pieces(path).bytes.values()
    return docs.select(
        "doc_id", F.size(ids).cast("long").alias("n_pieces"), F.size(F.filter(ids, lambda i: i.between(min(kinds), max(kinds)))).cast("long").alias("n_byte_pieces"),
        F.sha2(F.array_join(ids.cast("array<string>"), ","), 256).alias("ids_sha256"), (pieces.decode_column(path, ids) == F.translate(text, pieces.BLANK, " ")).alias("round_trip"),
    )


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted: the weighted lexicon learnt from labelled documents."""
    docs = table(spark, sf_dir, "documents")
    lexicon = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", held_out("doc_id").alias("held_out"), toxicity.score_column(lexicon, "text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= toxicity.THRESHOLD).cast("int"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit."""
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_TOKENIZER))


def op7_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, losses and their difference; the target is what is labelled of high quality and not held out, the background all else."""
    docs = table(spark, sf_dir, "documents")
    good = table(spark, sf_dir, "labels").where((F.col("quality") == 1) & ~held_out("doc_id")).select(F.col("doc_id").alias("_good")).distinct()
    if good.count() <= BROADCAST_IDS:
        good = F.broadcast(good)
    marked = docs.select("doc_id", "text").join(good, F.col("doc_id") == F.col("_good"), "left")
    return ngram_lm.score(marked, F.col("_good").isNotNull())


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, read back from the archives."""
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, url, text, n_chars."""
    return html_paths.extract(table(spark, sf_dir, "pages"))


def op10_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("items")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    all_ = (op1_quality, op2_audio, op3_near_duplicates, op4_pieces, op5_toxicity, op6_token_counts, op7_lm_scores, op8_warc, op9_main_text, op10_contamination)
    return {f.__name__: f for f in all_}


OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents
), i AS (
  SELECT CAST(item_id AS VARCHAR) AS item, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark
), iw AS (
  SELECT DISTINCT item, n, array_to_string(w[b:b + n - 1], ' ') AS v
  FROM (SELECT item, w, n, unnest(generate_series(1, len(w) - n + 1)) AS b FROM (SELECT item, w, least(10, len(w)) AS n FROM i WHERE len(w) > 0))
), dw AS (
  SELECT r, n, b, array_to_string(w[b:b + n - 1], ' ') AS v
  FROM (SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS b FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)
), h AS (
  SELECT r, b, dw.n, item FROM dw JOIN iw ON dw.n = iw.n AND dw.v = iw.v
), n AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(generate_series(b, b + n - 1)) AS p FROM h) GROUP BY r
), s AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM h) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN s USING (r)
"""


def oracle_sql() -> dict[str, str]:
    return {"op10_contamination": OP10_SQL}
