"""Records that arrive as a stream, blocked against a reference source that stands still.

Blocking only asks the reference source's index, so every micro-batch can be linked by itself.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.address import clean_addresses
from ..functions.text import clean_names
from ..operators.blocking import token_sets


def candidates_of(raw: DataFrame, index: DataFrame, plan: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The candidates of a batch of raw records. index: the reference source's tokens (country, key, source, pass, token)."""
    tokens = token_sets(clean_addresses(clean_names(raw)))
    return plan(tokens.unionByName(index.select(tokens.columns)))


def link_stream(raw: DataFrame, index: DataFrame, plan: Callable[[DataFrame], DataFrame], path: str, checkpoint: str) -> StreamingQuery:
    """Candidates of a stream of raw records, written as Parquet under path, one folder for each micro-batch: a batch that is run again
    replaces its own."""

    def write(batch: DataFrame, number: int) -> None:
        candidates_of(batch, index, plan).withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return raw.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
