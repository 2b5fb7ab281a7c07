"""Which pairs to keep: rules, the search for the best one, and rules for each country.

A probability only matters by how many of a rule's parameters it reaches. So an entity's result changes at the few parameters that its own
pairs reach, and the whole grid is the sum of these changes: no pair is copied for each parameter.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

THRESHOLDS = [round(0.3 + i * 0.01, 3) for i in range(66)]
FLOORS = [round(i * 0.025, 3) for i in range(39)]
PARAMS = {"threshold": THRESHOLDS, "expected": FLOORS}
LEAST = 1e-6


def f05(tp: Column, n_pred: Column, n_true: Column) -> Column:
    """F0.5 of an entity; 1 if there is nothing to find and nothing found."""
    return F.when(n_true + n_pred == 0, 1.0).otherwise(1.25 * tp / (0.25 * n_true + n_pred))


def expected_f(pairs: DataFrame, *by: str) -> DataFrame:
    """Of the pairs of each entity (columns by) those whose number, most likely first, has the highest expected F0.5, if that is more than
    that of keeping none. Columns cand, prob."""
    p = F.least(F.greatest(F.col("prob"), F.lit(LEAST)), F.lit(1 - LEAST))
    order = Window.partitionBy(*by).orderBy(F.desc("prob"), "cand")
    all_ = Window.partitionBy(*by)
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = pairs.withColumn("_p", p).withColumns({"_k": F.row_number().over(order), "_cum": F.sum("_p").over(so_far), "_total": F.sum("_p").over(all_), "_none": F.exp(F.sum(F.log(1 - F.col("_p"))).over(all_))})
    ranked = ranked.withColumn("_ef", F.round(1.25 * F.col("_cum") / (0.25 * F.col("_total") + F.col("_k")), 9))
    ranked = ranked.withColumn("_top", F.max("_ef").over(all_)).withColumn("_best", F.min(F.when(F.col("_ef") == F.col("_top"), F.col("_k"))).over(all_))
    return ranked.where((F.col("_k") <= F.col("_best")) & (F.col("_top") > F.col("_none"))).drop("_p", "_k", "_cum", "_total", "_none", "_ef", "_top", "_best")


def _reached(params: list[float]) -> Column:
    return F.size(F.filter(F.array(*map(F.lit, params)), lambda x: x <= F.col("prob")))


def _states(best: DataFrame) -> DataFrame:
    """(method, s1, reached, tp, n_pred): an entity's result for parameters up to the one reached and above the next lower row's."""
    at = best.select("s1", "cand", "label", "prob", _reached(THRESHOLDS).alias("reached"))
    down = Window.partitionBy("s1").orderBy(F.desc("reached")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    steps = at.where("reached > 0").groupBy("s1", "reached").agg(F.sum("label").alias("tp"), F.count(F.lit(1)).alias("n_pred"))
    steps = steps.select(F.lit("threshold").alias("method"), "s1", "reached", F.sum("tp").over(down).alias("tp"), F.sum("n_pred").over(down).alias("n_pred"))
    at = best.select("s1", "cand", "label", "prob", _reached(FLOORS).alias("_own"))
    levels = at.select("s1", F.col("_own").alias("reached")).where("reached > 0").distinct()
    kept = expected_f(at.join(levels, "s1").where("_own >= reached").drop("_own"), "s1", "reached")
    found = kept.groupBy("s1", "reached").agg(F.sum("label").alias("tp"), F.count(F.lit(1)).alias("n_pred"))
    none = F.lit(0).cast("long")
    return steps.unionByName(levels.join(found, ["s1", "reached"], "left").select(F.lit("expected").alias("method"), "s1", "reached", F.coalesce("tp", none).alias("tp"), F.coalesce("n_pred", none).alias("n_pred")))


def grid(best: DataFrame, info: DataFrame) -> DataFrame:
    """(method, param, country, tp, n_pred, f): sums over the country's entities for every parameter of both rules."""
    s = _states(best).join(info.select("s1", "country", "n_true"), "s1").withColumn("f", f05(F.col("tp"), F.col("n_pred"), F.col("n_true")))
    w = Window.partitionBy("method", "s1").orderBy("reached")
    base = F.when(F.col("n_true") == 0, 1.0).otherwise(0.0)
    change = s.select("method", "country", F.col("reached").alias("_j"), *(F.col(c) - F.coalesce(F.lead(c).over(w), d) for c, d in (("tp", F.lit(0)), ("n_pred", F.lit(0)), ("f", base))))
    change = change.toDF("method", "country", "_j", "tp", "n_pred", "f").groupBy("method", "country", "_j").agg(*(F.sum(c).alias(c) for c in ("tp", "n_pred", "f")))
    start = info.groupBy("country").agg(F.sum(base).alias("_start"))
    rows = F.array(*(F.struct(F.lit(m).alias("method"), F.lit(j).alias("_j"), F.lit(x).alias("param")) for m, xs in PARAMS.items() for j, x in enumerate(xs, 1)))
    every = start.select("country", "_start", F.inline(rows))
    down = Window.partitionBy("method", "country").orderBy(F.desc("_j")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = lambda c: F.coalesce(F.sum(c).over(down), F.lit(0))
    return every.join(change, ["method", "country", "_j"], "left").select("method", "param", "country", total("tp").alias("tp"), total("n_pred").alias("n_pred"), (F.col("_start") + total("f")).alias("f"))


def choose(sums: DataFrame, info: DataFrame) -> DataFrame:
    """(scope, method, param, f05, adopted): the best rule for all, then for each country. Of equal ones the first: thresholds before floors, the
    lowest parameter. Rules of countries are adopted if they are better together."""
    sizes = info.groupBy("country").agg(F.count(F.lit(1)).alias("n"))
    each = sums.join(sizes, "country").select(F.col("country").alias("scope"), "method", "param", "f", "n")
    whole = each.groupBy("method", "param").agg(F.sum("f").alias("f"), F.sum("n").alias("n")).select(F.lit("all").alias("scope"), "method", "param", "f", "n")
    key = F.struct(-F.round(F.col("f") / F.col("n"), 9), (F.col("method") == "expected").alias("later"), "param")
    pick = lambda d: d.groupBy("scope").agg(F.min_by(F.struct("method", "param", "f", "n"), key).alias("r")).select("scope", "r.*")
    best = pick(whole).unionByName(pick(each))
    is_all = F.col("scope") == "all"
    sides = best.agg(F.sum(F.when(~is_all, F.col("f"))).alias("_each"), F.max(F.when(is_all, F.col("f"))).alias("_whole"))
    better = F.coalesce(F.col("_each") > F.col("_whole") + 1e-6, F.lit(False))
    return best.join(F.broadcast(sides)).select("scope", "method", "param", (F.col("f") / F.col("n")).alias("f05"), (is_all | better).cast("int").alias("adopted"))


def apply(best: DataFrame, rules: DataFrame) -> DataFrame:
    """Of the pairs (cand, s1, country, label, prob) those that the country's rule keeps; where none is adopted for a country, or it was not seen,
    the rule for all."""
    one = rules.where("scope = 'all'").first()
    if one is None:
        return best.select("cand", "s1", "country", "label", "prob").limit(0)
    own = rules.where("scope <> 'all' AND adopted = 1").select(F.col("scope").alias("_scope"), F.col("method").alias("_method"), F.col("param").alias("_param"))
    ruled = best.join(F.broadcast(own), F.col("country") == F.col("_scope"), "left")  # a row for each country
    ruled = ruled.select("cand", "s1", "country", "label", "prob", F.coalesce("_method", F.lit(one["method"])).alias("_method"), F.coalesce("_param", F.lit(one["param"])).alias("_param")).where("prob >= _param")
    return ruled.where("_method = 'threshold'").drop("_method", "_param").unionByName(expected_f(ruled.where("_method = 'expected'").drop("_method", "_param"), "s1"))
