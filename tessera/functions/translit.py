"""A dictionary of words of names in other scripts, learnt from true pairs, and its use on cleaned names."""
from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .text import GENERIC, _first_filled, skeleton

LEAST_COUNT, LEAST_SHARE, SHORTEST = 3, 0.5, 2
#: The most words that are handed to every worker.
MOST = 200_000


def aligned(truth: DataFrame, names: DataFrame) -> DataFrame:
    """(src, dst) of the words in the same places of true pairs with equally many words. names: key, name_core and native (1 for the names to
    be translated)."""
    split = lambda c: F.filter(F.split(c, " "), lambda w: w != "")
    b = names.where("native = 1").select(F.col("key").alias("cand"), split("name_core").alias("_b"))
    a = names.where("native = 0").select(F.col("key").alias("s1"), split("name_core").alias("_a"))
    pairs = truth.select("cand", "s1").join(b, "cand").join(a, "s1").where((F.size("_a") == F.size("_b")) & (F.size("_a") > 0))
    return pairs.select(F.explode(F.arrays_zip(F.col("_b").alias("src"), F.col("_a").alias("dst"))).alias("_w")).select("_w.src", "_w.dst")


def learn(truth: DataFrame, names: DataFrame) -> DataFrame:
    """(src, dst, n): the word that stands for src in at least half of its places, three or more."""
    counts = aligned(truth, names).groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))
    share = F.col("n") / F.sum("n").over(Window.partitionBy("src"))
    known = counts.withColumn("_share", share).where((F.col("n") >= LEAST_COUNT) & (F.col("_share") >= LEAST_SHARE) & (F.col("src") != F.col("dst")) & (F.length("src") >= SHORTEST) & ~F.col("src").rlike("^[0-9]+$"))
    # of two words with half the places each the first in order
    first = F.row_number().over(Window.partitionBy("src").orderBy(F.desc("n"), "dst"))
    return known.withColumn("_rn", first).where("_rn = 1").select("src", "dst", "n")


def translate(clean: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Cleaned names whose words are replaced by the dictionary where the name is not in Latin letters; key, skeleton and joined name follow. Legal
    forms stay. Raises ValueError for more than MOST words."""
    n = dictionary.count()
    if n > MOST:
        raise ValueError(f"{n} words; at most {MOST}")
    words = {r["src"]: r["dst"] for r in dictionary.select("src", "dst").collect()}

    @F.arrow_udf("string")
    def remap(t: pa.Array) -> pa.Array:
        return pa.array([" ".join(words.get(w, w) for w in (x or "").split()) for x in t.to_pylist()], pa.string())

    native = F.col("is_nonlatin") == 1
    out = clean.withColumns({c: F.when(native, remap(F.col(c))).otherwise(F.col(c)) for c in ("name_clean", "name_core", "name_alt")})
    core = F.filter(F.split("name_core", " "), lambda w: w != "")
    new = {"name_key": F.array_join(_first_filled(F.filter(core, lambda w: ~w.isin(*GENERIC)), core), " "), "name_skel": F.array_join(F.transform(core, skeleton), " "), "name_nospace": F.array_join(core, "")}
    return out.withColumns({c: F.when(native, x).otherwise(F.col(c)) for c, x in new.items()})
