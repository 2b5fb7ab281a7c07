"""What the corpus operators share: Arrow access, name hygiene, shared scratch tables."""
from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Records and bytes in one Arrow batch. Texts and multisets may be long, so batches are kept far below Spark's 10,000 rows and 64 MB.
BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20


def bounded_batches(spark: SparkSession, rows: int = BATCH_ROWS, max_bytes: int = BATCH_BYTES) -> None:
    """Bound the memory of Python workers, and what the JVM holds outside its heap for them: fewer rows and bytes in an Arrow
    batch than Spark's default. A batch ends with the row that reaches either bound, so no row is cut."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{max_bytes}b")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_bytes(column: pa.Array) -> list[bytes]:
    """The UTF-8 of each text; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def as_texts(column: pa.Array) -> list[str]:
    """Each text; null is empty."""
    return [x or "" for x in column.to_pylist()]


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that no column of df has, whatever the case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: spark.checkpoint.dir, or where that is unset a folder of our own."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = getattr(spark, "_tessera_scratch", None)
        if not found:
            found = spark._tessera_scratch = "file://" + tempfile.mkdtemp(prefix="tessera-")
            spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def scratch(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/tessera-{tag}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """Write df into the shared folder and read it back: lineage ends there and lost executors lose nothing."""
    spark = df.sparkSession
    path = scratch(spark, tag)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def held_out(doc_id: Column | str) -> Column:
    """True for the fifth of the rows whose labels are never learnt."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string")) % 5 == 0, F.lit(False))


def record_batches(it: Iterable[pa.RecordBatch], max_bytes: int = 4 << 20) -> Iterable[pa.RecordBatch]:
    """Slices of the batches with at most max_bytes each, or one row."""
    for batch in it:
        n = batch.num_rows
        if not n:
            continue
        step = max(1, min(n, n * max_bytes // max(batch.nbytes, 1)))
        for i in range(0, n, step):
            yield batch.slice(i, step)
