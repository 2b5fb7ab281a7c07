"""Checks of id lists: of their rows, and of the files that hold them."""
from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MATCHED = ("source1_entity_id", "matched_entity_ids")
CANDIDATES = ("source1_entity_id", "candidate_entity_ids")
EXAMPLES = 5


def listed(rows: DataFrame) -> DataFrame:
    """(s1, id) of each id in the comma lists of the rows (s1, ids)."""
    return rows.select("s1", F.explode(F.split(F.coalesce("ids", F.lit("")), ",")).alias("id")).where("id <> ''")


def list_findings(rows: DataFrame, records: DataFrame, candidates: DataFrame | None = None) -> DataFrame:
    """(finding, example) for rows (s1, ids), records (entity_id, key, source) and candidates (s1, cand as keys). One row for each offender."""
    named = lambda name, df: df.select(F.lit(name).alias("finding"), df[df.columns[0]].alias("example"))
    ids, seen = listed(rows), rows.select("s1").distinct()
    wanted = records.where("source = 1").select(F.col("entity_id").alias("s1"))
    each = ids.select("id").distinct()
    out = [
        named("duplicate row", rows.groupBy("s1").count().where("count > 1")),
        named("duplicate id", ids.groupBy("s1", "id").count().where("count > 1").select("s1").distinct()),
        named("source 1 id", each.where(F.col("id").startswith("S1-"))),
        named("bad prefix", each.where(~F.col("id").rlike("^S[123]-"))),
        named("unknown row", seen.join(wanted, "s1", "left_anti")),
        named("missing row", wanted.join(seen, "s1", "left_anti")),
        named("unknown id", each.join(records.select(F.col("entity_id").alias("id")), "id", "left_anti")),
    ]
    if candidates is not None:
        a, b = (records.select(F.col("key").alias(k), F.col("entity_id").alias(n)) for k, n in (("s1", "_s1"), ("cand", "_id")))
        known = candidates.select("s1", "cand").join(a, "s1").join(b, "cand").select(F.col("_s1").alias("s1"), F.col("_id").alias("id"))
        strange = ids.distinct().join(known, ["s1", "id"], "left_anti")
        out.append(named("not a candidate", strange.select(F.concat_ws(" ", "s1", "id").alias("x"))))
    found = out[0]
    for x in out[1:]:
        found = found.unionByName(x)
    return found


def summary(findings: DataFrame) -> DataFrame:
    """(finding, n, examples): up to EXAMPLES offenders in order, comma-joined."""
    w = F.row_number().over(_by_finding())
    ranked = findings.withColumn("_rn", w)
    kept = F.when(F.col("_rn") <= EXAMPLES, F.struct("_rn", "example"))
    return ranked.groupBy("finding").agg(F.count(F.lit(1)).alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list(kept)), lambda x: x["example"]), ", ").alias("examples"))


def _by_finding():
    from pyspark.sql import Window

    return Window.partitionBy("finding").orderBy("example")


def file_findings(spark: SparkSession, path: str, header: Sequence[str] = MATCHED, records: DataFrame | None = None, candidates: DataFrame | None = None) -> DataFrame:
    """(finding, example) of the files at path: empty ones, headers that are comma-separated or others than wanted, lines without a tab; and what
    list_findings says of the lines that are whole. Blank lines are passed over. Nothing more is said of a file whose header is wrong."""
    # the first line of a file is the first row of its first split
    text = spark.read.text(path).select(F.col("_metadata.file_name").alias("_file"), F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_nth"), "value")
    firsts = text.where("_start = 0").groupBy("_file").agg(F.min_by("value", "_nth").alias("_head"))
    names = [(unquote(f.rpartition("/")[2]),) for f in spark.read.text(path).inputFiles()]  # a scan passes over empty files
    files = spark.createDataFrame(names, "_file string").distinct()
    heads = files.join(firsts, "_file", "left").select("_file", F.coalesce("_head", F.lit("")).alias("_head"))
    head = F.lower(F.regexp_replace("_head", "\r$", ""))
    columns = F.transform(F.split(head, "\t"), lambda x: F.trim(x))
    right = columns == F.array(*map(F.lit, header))
    comma = ~F.col("_head").contains("\t") & F.col("_head").contains(",")
    kinds = F.when(F.col("_head") == "", "empty file").when(comma, "comma-separated").when(~right, "wrong header")
    bad = heads.select(kinds.alias("finding"), F.col("_file").alias("example")).where("finding IS NOT NULL")
    sound = heads.where(right).select("_file", F.col("_head").alias("_first"))
    lines = text.join(F.broadcast(sound), "_file").where(F.col("value") != F.col("_first"))  # a row for each file
    broken = lines.where(~F.col("value").contains("\t") & (F.trim("value") != "")).select(F.lit("malformed row").alias("finding"), F.col("value").alias("example"))
    out = bad.unionByName(broken)
    if records is not None:
        rows = lines.where(F.col("value").contains("\t")).select(F.split("value", "\t", 2)[0].alias("s1"), F.split("value", "\t", 2)[1].alias("ids"))
        out = out.unionByName(list_findings(rows, records, candidates))
    return out
