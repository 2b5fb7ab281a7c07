"""Tab-separated tables: every column a text, no quoting, no word that means null."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def read_tsv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """The columns of files with a header. Quotes and words like NULL stay as they are; missing fields are empty."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    return spark.read.option("sep", "\t").option("header", True).option("quote", "").option("escape", "").option("nullValue", "\u0000").schema(schema).csv(path).na.fill("")


def write_tsv(df: DataFrame, path: str, order: Sequence[str] = ()) -> None:
    """Files with a header each, in the given order (then the parts' order is the rows'). Nulls are written as empty fields."""
    out = df.orderBy(*order) if order else df
    out.write.option("sep", "\t").option("header", True).option("quote", "").option("escape", "").option("emptyValue", "").option("nullValue", "").csv(path)
