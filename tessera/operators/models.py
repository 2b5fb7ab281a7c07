"""Boosted trees on pair features: folds by entity, predictions out of fold, an ensemble of the folds' models, and a second stage."""
from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.scratch import written
from . import decision
from .features import feature_columns, stack_features

FOLDS = 5

#: Spark's learner looks for bins in all rows, of up to the square of its maxBins (an int); above, in so many drawn ones. Ours are found before, so that no more of them arise.
MOST_BINS = 46340


@dataclass
class Settings:
    """Of the trees."""

    trees: int = 100
    depth: int = 7
    bins: int = 255
    rate: float = 0.1
    rows_share: float = 0.8
    columns_share: str = "0.8"
    least_rows: int = 200
    seed: int = 42


@dataclass
class Models:
    """Each fold's model bins the columns by its own borders, and has its trees last."""

    columns: list[str]
    folds: list[PipelineModel] = field(default_factory=list)

    def importance(self) -> list[tuple[str, float]]:
        """Each feature's share of the gain, a mean over the folds, largest first."""
        whole = [sum(m.stages[-1].featureImportances[i] for m in self.folds) / len(self.folds) for i in range(len(self.columns))]
        total = sum(whole) or 1.0
        return sorted(((c, float(w / total)) for c, w in zip(self.columns, whole, strict=True)), key=lambda r: (-r[1], r[0]))

    def save(self, spark: SparkSession, path: str) -> None:
        """A folder for each fold, and the columns as JSON."""
        for k, m in enumerate(self.folds):
            m.write().overwrite().save(f"{path}/fold{k}")
        write_json(spark, {"columns": self.columns, "folds": len(self.folds)}, f"{path}/features")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Models:
        about = read_json(spark, f"{path}/features")
        return cls(about["columns"], [PipelineModel.load(f"{path}/fold{k}") for k in range(about["folds"])])


def write_json(spark: SparkSession, value, path: str) -> None:
    """One JSON document, where Spark can write."""
    spark.createDataFrame([(json.dumps(value),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_json(spark: SparkSession, path: str):
    return json.loads("\n".join(r["value"] for r in spark.read.text(path).collect()))


def borders(df: DataFrame, columns: Sequence[str], bins: int) -> list[list[float]]:
    """For each column the borders of its bins, at most `bins`, in ascending order; a value's bin has the number of borders below it. They come from the counts of all values: one between any two neighbours
    if there are no more values than `bins`, else by the rule of Spark's learner. That goes through the values in order, with a target of one bin's rows at first, and puts a border before a value if the count
    up to there is nearer to the target than the count with the value; the next target is then one bin's rows more."""
    w, column = Window.partitionBy("i").orderBy("v"), Window.partitionBy("i")
    t = df.select(F.posexplode(F.array(*(F.col(c).cast("double") for c in columns))).alias("i", "v")).groupBy("i", "v").agg(F.count(F.lit(1)).alias("n"))
    t = t.withColumns({"upto": F.sum("n").over(w), "low": F.lag("v").over(w), "k": F.row_number().over(w) - 1, "whole": F.sum("n").over(column), "kinds": F.count(F.lit(1)).over(column)})
    # `passed`: targets below the middle of the counts without and with the value, less the value's place k. At most one border a value: it gets one unless `passed` is lower than ever before.
    t = t.withColumn("most", F.least(F.lit(bins).cast("long"), "whole")).withColumn("passed", F.expr("if(k = 0, 0L, ((2 * upto - n) * most - 1) div (2 * whole) - k)"))
    t = t.withColumn("lowest", F.min("passed").over(w.rowsBetween(Window.unboundedPreceding, -1)))
    out: list[list[float]] = [[] for _ in columns]
    for r in t.where("k > 0 AND (kinds <= most OR passed >= lowest)").select("i", "low", "v").collect():
        middle = (r["low"] + r["v"]) / 2
        out[r["i"]].append(middle if r["low"] <= middle < r["v"] else r["low"])
    return [sorted(b) for b in out]


def _bins(columns: Sequence[str], at: Sequence[Sequence[float]]) -> list:
    """Two transformers: the numbers of the columns' bins, and these as a vector. A column without borders gets one at 0."""
    names = [f"_bin{i}" for i in range(len(columns))]
    splits = [[-math.inf, *(math.nextafter(x, math.inf) for x in b or [0.0]), math.inf] for b in at]
    return [Bucketizer(splitsArray=splits, inputCols=list(columns), outputCols=names), VectorAssembler(inputCols=names, outputCol="_x")]


def _with_prob(df: DataFrame, model: PipelineModel, name: str) -> DataFrame:
    return model.transform(df).withColumn(name, vector_to_array("_p")[1]).select(*dict.fromkeys([*df.columns, name]))


def fit(train: DataFrame, valid: DataFrame, columns: Sequence[str], s: Settings) -> PipelineModel:
    """Trees are added until they don't help on valid. The borders of the bins come from all of train."""
    both = train.withColumn("_valid", F.lit(False)).unionByName(valid.withColumn("_valid", F.lit(True)))
    stages = _bins(columns, borders(train, columns, s.bins))
    learner = GBTClassifier(
        featuresCol="_x", labelCol="label", predictionCol="_hard", maxIter=s.trees, maxDepth=s.depth, maxBins=MOST_BINS, stepSize=s.rate, subsamplingRate=s.rows_share,
        featureSubsetStrategy=s.columns_share, minInstancesPerNode=s.least_rows, validationIndicatorCol="_valid", validationTol=0.0, seed=s.seed,
    )
    learner = learner.setProbabilityCol("_p").setRawPredictionCol("_raw")
    binned = PipelineModel(stages).transform(both.withColumn("label", F.col("label").cast("double"))).select("_x", "label", "_valid")
    binned = binned.withMetadata("_x", {"ml_attr": {"num_attrs": len(columns)}})  # else bins would be learnt from as categories, without their order
    return PipelineModel([*stages, learner.fit(binned)])


def cross_validated(features: DataFrame, settings: Settings | None = None, columns: Sequence[str] | None = None, folds: int = FOLDS) -> tuple[DataFrame, Models]:
    """(cand, s1, country, fold, label, prob) of every pair, each from the model that hasn't seen its fold, and the models. Entities are whole in a
    fold. A model learns from all pairs of the other folds, as do the borders of its bins, and all of its own fold decide when to stop. A fold without pairs, or with only one label to learn from, has no model; its pairs get the share of positives."""
    s = settings or Settings()
    models = Models(list(columns or feature_columns(features)))
    parts = None
    for k in range(folds):
        own, others = features.where(F.col("fold") == k), features.where(F.col("fold") != k)
        share = others.agg(F.avg(F.col("label").cast("double"))).first()[0]
        if share is None or share in (0.0, 1.0) or own.isEmpty():
            scored = own.withColumn("prob", F.lit(float(share or 0.0)))
        else:
            model = fit(others, own, models.columns, s)
            models.folds.append(model)
            scored = _with_prob(own, model, "prob")
        scored = scored.select("cand", "s1", "country", "fold", "label", F.round("prob", 6).alias("prob"))
        parts = scored if parts is None else parts.unionByName(scored)
    return written(parts, "oof"), models


def ensemble(features: DataFrame, models: Models) -> DataFrame:
    """(cand, s1, country, prob): the mean of the folds' models."""
    out = features.select("cand", "s1", "country", *models.columns)
    names = [f"_prob{k}" for k in range(len(models.folds))]
    for m, n in zip(models.folds, names, strict=True):
        out = _with_prob(out, m, n)
    mean = sum((F.col(n) for n in names), F.lit(0.0)) / max(len(names), 1)
    return out.select("cand", "s1", "country", F.round(mean, 6).alias("prob"))


def best_f05(scored: DataFrame, info: DataFrame) -> tuple[float, DataFrame]:
    """Macro F0.5 of the best rule for all, after each record has gone to its most likely entity; and the rules."""
    from pyspark.sql import Window

    owner = F.row_number().over(Window.partitionBy("cand").orderBy(F.desc("prob"), "s1"))
    best = written(scored.withColumn("_rn", owner).where("_rn = 1").drop("_rn"), "owners")
    rules = written(decision.choose(decision.grid(best, info), info), "rules")
    found = rules.where("scope = 'all'").first()
    return (found["f05"] if found else 0.0), rules


def stacked(oof: DataFrame, info: DataFrame, settings: Settings | None = None) -> tuple[DataFrame, bool, Models]:
    """Out-of-fold probabilities of a second stage over stack_features, whether it is better than the first, and its models. The better
    of the two is returned."""
    s = settings or Settings(least_rows=500)
    table = written(stack_features(oof).join(oof.select("cand", "s1", "country", "fold", "label"), ["cand", "s1"]), "stack")
    second, models = cross_validated(table, s)
    better = best_f05(second, info)[0] > best_f05(oof, info)[0]
    return (second if better else oof), better, models
