"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

The queries run as one job: a step that several need is written once, and its time counts in the query that needs it first.
"""
import json
import os
import time

from pyspark.sql import SparkSession

from tessera.operators import features
from tessera.plans import linkage

HEADLINES = ("name_forms", "address_forms", "candidates_union", "group_features", "grid_search", "macro_f05", "id_lists", "stack_features")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "8g").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    took = {}
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in linkage.BASE}
    for name in HEADLINES:
        began = time.time()
        tables = linkage.prepare(spark, [name], tables)
        linkage.run(spark, name, tables).write.format("noop").mode("overwrite").save()
        took[f"er_{name}"] = round(time.time() - began, 3)
    began = time.time()
    tables |= {n: linkage.run(spark, n, tables) for n in ("labelled",)}
    pairs = tables["labelled"].select("cand", "s1", "country", "fold", "label", *features.CANDIDATE)
    features.all_features(pairs, tables["clean"]).write.format("noop").mode("overwrite").save()
    took["er_features"] = round(time.time() - began, 3)
    print(json.dumps({"metric": "headline linkage queries, total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
