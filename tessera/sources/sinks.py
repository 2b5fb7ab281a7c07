"""Id lists, tables by country, CSV and text reports."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tsv import write_tsv


def write_id_lists(lists: DataFrame, path: str, column: str = "matched_entity_ids") -> None:
    """Rows (source1_entity_id, ids) as TSV in the order of the entities' numbers; ids that are null are empty."""
    number = F.try_to_number(F.substring("source1_entity_id", 4, 18), F.lit("9" * 18))
    rows = lists.select("source1_entity_id", F.coalesce(F.col(lists.columns[1]), F.lit("")).alias(column), number.alias("_n"))
    write_tsv(rows.orderBy("_n", "source1_entity_id").drop("_n"), path)


def write_by_country(df: DataFrame, path: str) -> None:
    """Parquet with a folder for each country."""
    df.write.mode("overwrite").partitionBy("country").parquet(path)


def read_country(spark, path: str, country: str) -> DataFrame:
    """One country's rows: of such folders only its own is read; elsewhere the condition goes down to the scan."""
    return spark.read.parquet(path).where(F.col("country") == country)


def write_csv(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_report(spark, text: str, path: str) -> None:
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").option("lineSep", "").text(path)
