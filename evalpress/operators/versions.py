"""Versioned tables in the shared folder: state that one run leaves for the next.

A version is a folder of Parquet files.  It counts only once its line is in the
log, written after the data; readers take the newest logged version, so a build
that dies half-way changes nothing and a reader of an older version keeps its
files.  Old versions are not deleted here; that is the store's retention.
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evalpress.session import scratch_path
from evalpress.sources.feeds import or_empty

LOG = "version long, folder string, rows long"


class Versions:
    """The versions of one table, below ``<scratch>/versions/<name>``."""

    def __init__(self, spark: SparkSession, name: str, schema: T.StructType):
        self.spark, self.schema = spark, schema
        self.root = scratch_path(spark, "versions", name)

    def log(self) -> DataFrame:
        """(version, folder, rows) of every complete version."""
        schema = T.StructType.fromDDL(LOG)
        return or_empty(self.spark, lambda: self.spark.read.schema(schema).json(f"{self.root}/log"), schema)

    def newest(self) -> tuple[int, str | None, int]:
        """(version, folder, rows) of the newest one; version 0 is none."""
        r = self.log().agg(F.max(F.struct("version", "folder", "rows")).alias("m")).first()["m"]
        return (r["version"], r["folder"], r["rows"]) if r else (0, None, 0)

    def read(self, folder: str | None = None) -> DataFrame:
        """The newest version, or the one in ``folder``; no rows before the first."""
        folder = folder or self.newest()[1]
        if folder is None:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.root}/data/{folder}")

    def publish(self, df: DataFrame) -> DataFrame:
        """Writes ``df`` as the next version and returns it as read back.  Rows
        are counted while they are written, not in a second scan."""
        version, folder = self.newest()[0] + 1, uuid.uuid4().hex
        told = Observation()
        (df.select(*self.schema.names).observe(told, F.count(F.lit(1)).alias("rows"))
         .write.option("compression", "zstd").parquet(f"{self.root}/data/{folder}"))
        line = self.spark.createDataFrame([(version, folder, told.get["rows"])], LOG)
        line.coalesce(1).write.mode("append").json(f"{self.root}/log")
        return self.read(folder)

    def upsert(self, new: DataFrame, key: str) -> DataFrame:
        """Publishes the newest version with the rows of ``new`` in place of
        those with the same key (null keys are equal), and returns it."""
        old = self.read()
        kept = old.alias("o").join(new.select(F.col(key).alias("_k")).distinct(),
                                   F.col(f"o.{key}").eqNullSafe(F.col("_k")), "left_anti")
        return self.publish(kept.unionByName(new.select(*self.schema.names)))
