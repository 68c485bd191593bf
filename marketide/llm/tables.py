"""What the operators of this package share: reading tables, placing rows, hashing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketide.session import materialise

#: Text that a Python worker has in hand at once; a longer text makes a batch of its own.
BATCH_BYTES = 400_000
#: What an executor and a Python worker hand each other at once. Spark's own limits (10,000 rows, 64 MB) let buffers
#: of texts grow to 128 MB per task on both sides, beside the heap.
ARROW_BYTES = 4 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id and text (null as empty), and whatever else is asked for; other columns do not travel.

    From here on the session's Arrow batches hold ARROW_BYTES at most.
    """
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        *more,
    )


def kept(df: DataFrame) -> DataFrame:
    """``df`` computed once into the shared folder; later plans start from there."""
    return materialise(df)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores in front until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def crc_bucket(column: str, buckets: int) -> Column:
    """crc32 of the column as text, modulo ``buckets``; null for a null."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % buckets
