"""The engine's registered queries and their SQL for another engine."""
from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import translit
from .functions.similarity import SCORERS, score
from .functions.text import NAME_COLUMNS
from .operators import features, models, reports
from .plans import linkage
from .sources.scratch import written

#: Small enough for a registered query; models.Settings has the usual size.
SETTINGS = models.Settings(trees=4, depth=3, bins=32, least_rows=20)


def _tables(spark: SparkSession, sf_dir: str, *steps: str) -> dict[str, DataFrame]:
    """The base tables and steps, costly ones written once."""
    t = linkage.prepare(spark, steps, {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in linkage.BASE})
    return t | {s: linkage.run(spark, s, t) for s in steps if s not in t}


def _query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return linkage.run(spark, name, {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in linkage.BASE})

    run.__name__ = f"er_{name}"
    return run


def er_name_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """cand, s1 and the similarity of the names' cores by each scorer, and of their keys, skeletons and joined cores."""
    t = _tables(spark, sf_dir, "cand", "clean")
    names = t["clean"].select("key", "name_core", "name_key", "name_skel", "name_nospace")
    a, b = names.select(F.col("key").alias("s1"), *(F.col(c).alias(f"a_{c}") for c in names.columns[1:])), names.select(F.col("key").alias("cand"), *(F.col(c).alias(f"b_{c}") for c in names.columns[1:]))
    pairs = t["cand"].select("cand", "s1").join(a, "s1").join(b, "cand")
    scores = [(f"core_{s}", s, "name_core") for s in SCORERS] + [("key_set", "token_set_ratio", "name_key"), ("skel_set", "token_set_ratio", "name_skel"), ("nosp_partial", "partial_ratio", "name_nospace")]
    return pairs.select("cand", "s1", *(F.round(score(s, f"a_{c}", f"b_{c}"), 6).alias(n) for n, s, c in scores))


def _features(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    t = _tables(spark, sf_dir, "cand", "clean", "labelled", "s1_info")
    labelled = t["labelled"].select("cand", "s1", "country", "fold", "label", *features.CANDIDATE)
    return features.all_features(labelled, t["clean"]), t


def er_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """cand, s1, country, fold, label and the 73 features of each candidate pair."""
    return _features(spark, sf_dir)[0]


def er_string_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """cand, s1 and the 48 text features of each candidate pair."""
    other = {*features.CANDIDATE, *features.GROUP, *features.PARTNER, *features.RELATIVE, "country", "fold", "label"}
    return er_features(spark, sf_dir).drop(*other)


def er_partner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """cand, s1 and how like the entity's best other candidate is."""
    return er_features(spark, sf_dir).select("cand", "s1", *features.PARTNER)


def er_relative(spark: SparkSession, sf_dir: str) -> DataFrame:
    """cand, s1 and four scores less their record's best, and the rank of the joint one."""
    return er_features(spark, sf_dir).select("cand", "s1", *features.RELATIVE)


def er_gbt_oof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """cand, s1, country, fold, label, prob: boosted trees, each pair by the model that hasn't seen its fold."""
    return models.cross_validated(written(er_features(spark, sf_dir), "features"), SETTINGS)[0]


def er_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """feature, importance: the twenty features with the most gain, a mean over the folds."""
    found = models.cross_validated(written(er_features(spark, sf_dir), "features"), SETTINGS)[1].importance()
    return spark.createDataFrame(found, "feature string, importance double").orderBy(F.desc("importance"), "feature").limit(20)


def er_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    """cand, s1, country, prob: the mean of the folds' models, saved and loaded again."""
    from .sources.scratch import folder

    table = written(er_features(spark, sf_dir), "features")
    path = f"{folder(spark)}/models-{uuid.uuid4().hex}"
    models.cross_validated(table, SETTINGS)[1].save(spark, path)
    return models.ensemble(table, models.Models.load(spark, path))


def er_stacked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """cand, s1, country, fold, label, prob of the second stage, or of the first where that is better."""
    f, t = _features(spark, sf_dir)
    oof, _ = models.cross_validated(written(f, "features"), SETTINGS)
    return models.stacked(oof, t["s1_info"], SETTINGS)[0]


def er_error_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """cause, counts and rates for the ten causes of errors."""
    t = _tables(spark, sf_dir, "clean", "found", "threshold", "labelled")
    predicted = t["threshold"].join(t["labelled"].select("cand", "s1", "label"), ["cand", "s1"])
    return reports.error_rates(predicted, t["found"], t["clean"], ("ASIA", "AMERICA"))


def er_recall_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """bin, n, found: recall of true pairs by the likeness of their names."""
    t = _tables(spark, sf_dir, "clean", "found")
    return reports.recall_by_name(t["found"], t["clean"])


def er_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """cand, s1 and the raw records of ten true pairs that were missed."""
    t = _tables(spark, sf_dir, "raw", "found")
    return reports.examples(t["found"].where("found = 0"), t["raw"], 10)


def er_translated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entity_id and name forms after the learnt dictionary; names of source 3 stand for those of another script."""
    t = _tables(spark, sf_dir, "clean", "truth", "scripts")
    native = t["clean"].withColumn("is_nonlatin", (F.col("source") == 3).cast("int"))
    return translit.translate(native, translit.learn(t["truth"], t["scripts"])).select("entity_id", *NAME_COLUMNS)


#: Queries that SQL can't express in another engine (common subsequences, learnt models); tests hold them against brute force.
WITHOUT_SQL = {f.__name__: f for f in (er_name_scores, er_features, er_string_features, er_partner, er_relative, er_gbt_oof, er_importance, er_ensemble, er_stacked, er_error_rates, er_recall_by_name, er_examples, er_translated)}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f"er_{n}": _query(n) for n in linkage.QUERIES} | WITHOUT_SQL


def oracle_sql() -> dict[str, str]:
    return {f"er_{n}": linkage.oracle(n) for n in linkage.QUERIES}
