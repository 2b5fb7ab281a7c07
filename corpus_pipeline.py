"""The corpus pipeline: five stages, each on all that the one before has kept, each written as Parquet and read again.

Documents that the quality classifier or the toxicity lexicon rejects go, one document of each class of near duplicates stays,
documents with benchmark passages go, and what is left is encoded. Every stage defines its result for nulls, empty texts, repeated
rows and empty tables as its operator does; columns of documents beyond the usual ones are kept.
"""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bagminhash, decontaminate, pieces, quality_pu, toxicity
from tessera.llm.common import bounded_batches, fresh, scratch, table
from tessera.llm.queries import PIECE_MODEL


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at least the classifier's threshold."""
    net, _ = quality_pu.train(docs, table(spark, sf_dir, "labels"))
    return docs.where(quality_pu.score_column(net, "text") >= quality_pu.THRESHOLD)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the lexicon's threshold."""
    lexicon = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return docs.where(toxicity.score_column(lexicon, "text") < toxicity.THRESHOLD)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: the one with the least id."""
    return bagminhash.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return decontaminate.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their piece ids, the number of these and whether decoding gives the text back."""
    ids, n, back = fresh(docs, "piece_ids", "n_pieces", "round_trip")
    path = public_tokenizers.path(PIECE_MODEL)
    text = F.translate(F.coalesce("text", F.lit("")), pieces.BLANK, " ")
    return pieces.encode_documents(docs, path, into=ids).withColumn(n, F.size(ids).cast("long")).withColumn(back, pieces.decode_column(path, ids) == text)


STAGES = [("quality classifier", quality), ("toxicity", clean), ("near-duplicate removal", dedup), ("benchmark decontamination", decontaminated), ("piece encoding", encoded)]

#: No SQL: stages learn their models, and classes of near duplicates come from an iteration.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; the result is what the last one has written."""
    bounded_batches(spark)
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        path = scratch(spark, "stage")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
