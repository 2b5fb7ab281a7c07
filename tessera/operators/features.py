"""Features of pairs among the other pairs of their record (cand) and of their entity (s1), and the whole table of features."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.pairs import RECORD_COLUMNS, string_features
from ..functions.similarity import score

LEAST = 1e-6
CANDIDATE = ("score", "rank", "sc_combo", "sc_name", "sc_addr", "n_pass")
GROUP = ("q_best", "q_n", "gap_next", "gap_best", "ratio_best", "s1_n", "s1_rank", "s1_ratio", "s1_top1_n", "is_s3")
PARTNER = ("partner_name_sim", "partner_addr_sim", "partner_score")
RELATIVE_TO = ("n_set", "a_set", "comb", "nosp_partial")
RELATIVE = ("comb", *(f"{c}_rel" for c in RELATIVE_TO), "comb_rank")
NOT_FEATURES = ("cand", "s1", "country", "label", "fold")


def group_features(cand: DataFrame) -> DataFrame:
    """cand with GROUP: the score among those of its record, then of its entity. Both kinds of windows share one exchange each."""
    c, s = Window.partitionBy("cand"), Window.partitionBy("s1")
    out = cand.withColumns({"q_best": F.max("score").over(c), "q_n": F.count(F.lit(1)).over(c), "_next": F.lead("score", 1, 0.0).over(c.orderBy("rank"))})
    out = out.withColumns({"gap_next": F.col("score") - F.col("_next"), "gap_best": F.col("q_best") - F.col("score"), "ratio_best": F.col("score") / F.greatest("q_best", F.lit(LEAST))})
    out = out.withColumns({"s1_n": F.count(F.lit(1)).over(s), "s1_rank": F.row_number().over(s.orderBy(F.desc("score"), "cand")), "_best": F.max("score").over(s), "s1_top1_n": F.sum((F.col("rank") == 0).cast("int")).over(s)})
    return out.withColumns({"s1_ratio": F.col("score") / F.greatest("_best", F.lit(LEAST)), "is_s3": (F.col("cand") >= 30000000000).cast("int")}).drop("_next", "_best")


def partner_keys(cand: DataFrame) -> DataFrame:
    """cand with partner, the entity's best other candidate (null if there is none), and partner_score (then 0)."""
    s = Window.partitionBy("s1")
    ranked = cand.withColumn("_rn", F.row_number().over(s.orderBy(F.desc("score"), "cand")))
    nth = lambda c, k: F.max(F.when(F.col("_rn") == k, F.col(c))).over(s)
    other = lambda c: F.when(F.col("_rn") == 1, nth(c, 2)).otherwise(nth(c, 1))
    return ranked.withColumns({"partner": other("cand"), "partner_score": F.coalesce(other("score"), F.lit(0.0))}).drop("_rn")


def relative(pairs: DataFrame, columns: Sequence[str] = RELATIVE_TO) -> DataFrame:
    """pairs with comb, each column less the best of its record, and the rank of comb there (equal ones share the first)."""
    c = Window.partitionBy("cand")
    out = pairs.withColumn("comb", F.round(0.6 * F.col("n_set") + 0.4 * F.col("a_set"), 6))
    out = out.withColumns({f"{x}_rel": F.round(F.col(x) - F.max(x).over(c), 6) for x in columns})
    return out.withColumn("comb_rank", F.rank().over(c.orderBy(F.desc("comb"))))


def stack_features(scored: DataFrame) -> DataFrame:
    """(cand, s1) and the 16 features of a pair's probability among those of its record and of its entity."""
    p = F.least(F.greatest(F.col("prob"), F.lit(LEAST)), F.lit(1 - LEAST))
    out = scored.select("cand", "s1", "prob").withColumn("logit", F.round(F.log(p / (1 - p)), 6))
    for key, tie, x in (("cand", "s1", "c"), ("s1", "cand", "s")):  # windows of one key follow each other
        w = Window.partitionBy(key)
        out = out.withColumns({f"{x}_rank": F.row_number().over(w.orderBy(F.desc("prob"), tie)), f"{x}_n": F.count(F.lit(1)).over(w), f"{x}_max": F.max("prob").over(w), f"_{x}_sum": F.sum("prob").over(w), f"{x}_n50": F.sum((F.col("prob") > 0.5).cast("int")).over(w)})
        if x == "c":
            out = out.withColumn("c_second", F.coalesce(F.max(F.when(F.col("c_rank") == 2, F.col("prob"))).over(w), F.lit(0.0)))
        out = out.withColumns({f"{x}_gap": F.round(F.col(f"{x}_max") - F.col("prob"), 6), f"{x}_sum": F.round(f"_{x}_sum", 6)})
    return out.withColumn("share_s", F.round(F.col("prob") / F.greatest("_s_sum", F.lit(LEAST)), 6)).drop("_c_sum", "_s_sum")


def all_features(labelled: DataFrame, clean: DataFrame) -> DataFrame:
    """(cand, s1, country, label, fold) and the 73 features of each candidate pair. labelled: candidates with label and fold (-1 each where there is no truth);
    clean: cleaned records by key."""
    records = clean.select("key", *RECORD_COLUMNS)
    a, b = (records.select(F.col("key").alias(k), *(F.col(c).alias(f"{side}_{c}") for c in RECORD_COLUMNS)) for side, k in (("a", "s1"), ("b", "cand")))
    p = records.select(F.col("key").alias("partner"), F.col("name_core").alias("p_name"), F.col("addr_clean").alias("p_addr"))
    pairs = partner_keys(group_features(labelled)).join(a, "s1").join(b, "cand").join(p, "partner", "left")
    likeness = lambda x, y: F.when(F.col("partner").isNull(), -1.0).otherwise(F.round(score("token_set_ratio", F.coalesce(x, F.lit("")), F.coalesce(y, F.lit(""))), 6))
    pairs = pairs.withColumns({"partner_name_sim": likeness("b_name_core", "p_name"), "partner_addr_sim": likeness("b_addr_clean", "p_addr")}).drop("p_name", "p_addr", "partner")
    return relative(string_features(pairs))


def feature_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in NOT_FEATURES]
