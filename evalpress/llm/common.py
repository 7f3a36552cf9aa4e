"""Helpers shared by the text operators."""
from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from evalpress.session import scratch_path

#: order key of rows without an id: before every id
NULL_ID = -(2 ** 63)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def staged(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet into the shared folder and read back:
    computed once, columnar, and not lost with an executor."""
    spark = df.sparkSession
    path = scratch_path(spark, "llm", uuid.uuid4().hex)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def order_id(col: str = "doc_id") -> Column:
    return F.coalesce(F.col(col).cast("long"), F.lit(NULL_ID).cast("long"))


def fraction_class(col: str, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; null for a null id."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % mod


#: rows of a side that may be broadcast; a wider side takes the shuffle join
BROADCAST_ROWS = 500_000


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A staged table of narrow rows, marked for broadcast only if its counted
    rows stay under ``rows``; otherwise unchanged (shuffle join)."""
    return F.broadcast(df) if df.count() <= rows else df


def sampled(docs: DataFrame, known: DataFrame, most: int, seed: int = 3) -> tuple[DataFrame, dict]:
    """Texts of at most ``most`` ids of each label, and the number of all ids of
    each label.  ``known``: staged (doc_id, _label), an id once.

    Labels are counted first; only ids whose hash lies below the share that
    gives twice the sample are ranked, so no task ranks more than that however
    large the table is.  An id with several texts gives the least of them."""
    ids = staged(known.join(docs.where(F.col("text").isNotNull()).select("doc_id").distinct(), "doc_id", "left_semi"))
    counts = {r["_label"]: r["n"] for r in ids.groupBy("_label").agg(F.count("*").alias("n")).collect()}
    share = F.lit(0.0)
    for label, n in counts.items():
        share = F.when(F.col("_label") == label, F.lit(2.0 * most / n)).otherwise(share)
    h = F.xxhash64(F.lit(seed), "doc_id")
    order = Window.partitionBy("_label").orderBy("_hash", "doc_id")
    few = (ids.withColumn("_hash", h).where(F.pmod("_hash", F.lit(1 << 30)) < share * (1 << 30))
           .withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= most).select("doc_id", "_label"))
    texts = (docs.where(F.col("text").isNotNull()).select("doc_id", "text").join(small(staged(few)), "doc_id")
             .groupBy("doc_id").agg(F.min("text").alias("text"), F.first("_label").alias("_label")))
    return texts, counts


def bounded_batches(df: DataFrame, rows: int = 1000, size: int = 8 << 20) -> DataFrame:
    """``df``; its session hands Python at most ``rows`` rows and about ``size``
    bytes at a time (unless smaller numbers are set), since a row can be a long
    text.  Spark reads both settings when the plan runs, so they stay set."""
    conf = df.sparkSession.conf
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", rows), ("spark.sql.execution.arrow.maxBytesPerBatch", size)):
        now = conf.get(key).removesuffix("b")
        if not now.isdigit() or not 0 < int(now) <= most:
            conf.set(key, str(most))
    return df


def release() -> None:
    """Hands memory that a reused Python worker no longer needs back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def tidy(run: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``run`` for mapInArrow, with memory handed back before and after it."""

    def wrapped(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        try:
            yield from run(batches)
        finally:
            release()

    return wrapped
