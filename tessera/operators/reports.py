"""Reports on linked pairs: causes of errors, recall by likeness, examples with their raw records, and a text of it all."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.similarity import score

BINS = ((40, "0-40"), (60, "40-60"), (80, "60-80"), (90, "80-90"), (100, "90-100"))


def with_records(pairs: DataFrame, clean: DataFrame) -> DataFrame:
    """pairs with a_* and b_* of their records and the likeness of the names' cores (token sets, 0 to 100)."""
    columns = ("name_core", "state", "house_no", "addr_missing", "is_domain", "country", "source")
    a, b = (clean.select(F.col("key").alias(k), *(F.col(c).alias(f"{side}_{c}") for c in columns)) for side, k in (("a", "s1"), ("b", "cand")))
    return pairs.join(a, "s1").join(b, "cand").withColumn("name_sim", score("token_set_ratio", "a_name_core", "b_name_core"))


def causes(countries: tuple[str, ...]) -> dict[str, Column]:
    """Properties of a pair that go with errors; a pair can have several."""
    differ = lambda c: (F.col(f"a_{c}") != "") & (F.col(f"b_{c}") != "") & (F.col(f"a_{c}") != F.col(f"b_{c}"))
    return {
        "candidate address missing": F.col("b_addr_missing") == 1, "candidate name is a domain": F.col("b_is_domain") == 1, "state conflict": differ("state"), "house number conflict": differ("house_no"),
        "names very different (<60)": F.col("name_sim") < 60, "names similar (>=90)": F.col("name_sim") >= 90, **{f"country = {c}": F.col("a_country") == c for c in countries},
        "candidate from S2": F.col("b_source") == 2, "candidate from S3": F.col("b_source") == 3,
    }


def error_rates(predicted: DataFrame, true: DataFrame, clean: DataFrame, countries: tuple[str, ...]) -> DataFrame:
    """(cause, n_predicted, fp_rate, n_true, lost_rate, missed_rate). predicted: cand, s1, label; true: cand, s1, in_cand, found. Rates are null where
    there is no pair."""
    none = F.lit(None).cast("int")
    rows = predicted.select("cand", "s1", F.col("label").alias("_label"), none.alias("_in"), none.alias("_found")).unionByName(true.select("cand", "s1", none.alias("_label"), F.col("in_cand").alias("_in"), F.col("found").alias("_found")))
    hits = F.array_compact(F.array(*(F.when(c, F.lit(n)) for n, c in causes(countries).items())))
    each = with_records(rows, clean).select("_label", "_in", "_found", F.explode(hits).alias("cause"))
    rate = lambda c: F.round(1 - F.avg(c), 6)
    return each.groupBy("cause").agg(F.count("_label").alias("n_predicted"), rate("_label").alias("fp_rate"), F.count("_in").alias("n_true"), rate("_in").alias("lost_rate"), rate("_found").alias("missed_rate"))


def recall_by_name(true: DataFrame, clean: DataFrame) -> DataFrame:
    """(bin, n, found) of the true pairs by the likeness of their names; bins are closed on the right."""
    bin_ = F.lit(BINS[-1][1])
    for top, name in reversed(BINS[:-1]):
        bin_ = F.when(F.col("name_sim") <= top, F.lit(name)).otherwise(bin_)
    return with_records(true, clean).groupBy(bin_.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.sum("found").alias("found"))


def examples(pairs: DataFrame, raw: DataFrame, n: int, salt: int = 42) -> DataFrame:
    """At most n of the pairs, drawn by a hash, with the raw names and addresses of both records."""
    some = pairs.orderBy(F.xxhash64(F.lit(salt), "cand", "s1"), "cand", "s1").limit(n)
    a, b = (raw.select(F.col("key").alias(k), F.col("business_name").alias(f"{side}_name"), F.col("business_address").alias(f"{side}_address")) for side, k in (("a", "s1"), ("b", "cand")))
    keys = F.broadcast(some)  # at most n rows
    return a.join(keys, "s1").join(b.join(F.broadcast(some.select("cand").distinct()), "cand", "left_semi"), "cand").select("cand", "s1", "a_name", "a_address", "b_name", "b_address")


def markdown(title: str, tables: dict[str, DataFrame]) -> str:
    """A text with each small table under its heading."""
    lines = [f"# {title}"]
    for name, df in tables.items():
        lines += ["", f"## {name}", "", "| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
        lines += ["| " + " | ".join("" if v is None else str(v) for v in row) + " |" for row in df.collect()]
    return "\n".join(lines) + "\n"
