"""Sinks and read-back (ops 8-13).

All writes replace their target folder and go to the shared scratch folder
(the cluster's checkpoint dir).  Every sink returns the DataFrame read back
from what was written, so the written files are what a query sees.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evalpress.operators.publish import assert_no_raw_fields
from evalpress.operators.versions import Versions


def write_metric_parquet(df: DataFrame, path: str, origin: str = "") -> DataFrame:
    """Raw-field gate on the schema, then zstd parquet with the declared schema."""
    assert_no_raw_fields(df, origin)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def publish_metric_parquet(df: DataFrame, name: str, origin: str = "") -> DataFrame:
    """As :func:`write_metric_parquet`, but as the next version of the table
    ``name``: readers of the version before keep their files, and a build that
    fails leaves the newest version as it was."""
    assert_no_raw_fields(df, origin)
    return Versions(df.sparkSession, name, df.schema).publish(df)


def write_runs_jsonl(df: DataFrame, path: str, schema: T.StructType | None = None) -> DataFrame:
    """JSON lines with nulls written out (the default would drop null fields);
    read back with ``schema`` (default: the written DataFrame's schema)."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return df.sparkSession.read.schema(schema or df.schema).json(path)


def write_runs_parquet(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def write_summary_json(df: DataFrame, path: str) -> DataFrame:
    """One-row summary as one JSON line; read back as text."""
    df.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return df.sparkSession.read.text(path).withColumnRenamed("value", "json")


def same_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows in one but not the other, both directions (empty when equal)."""
    return a.exceptAll(b).withColumn("_side", F.lit("left")).unionByName(
        b.exceptAll(a).withColumn("_side", F.lit("right")))


def column_profile(df: DataFrame) -> DataFrame:
    """Read-back audit: one row per column with its type and non-null count."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
    stack = ", ".join(f"'{c}', `{c}`" for c in df.columns)
    long = counts.selectExpr(f"stack({len(df.columns)}, {stack}) AS (column_name, n_nonnull)")
    types = df.sparkSession.createDataFrame(
        [(f.name, f.dataType.simpleString(), i) for i, f in enumerate(df.schema.fields)],
        "column_name string, type_name string, position int")
    return long.join(F.broadcast(types), "column_name")


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """Files of a built dataset with relative path and bytes (content pruned)."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
             .select("path", "length"))
    prefix = root.rstrip("/") + "/"
    rel = F.regexp_replace(F.col("path"), r"^.*?" + prefix.replace(".", r"\."), "")
    return files.select(rel.alias("rel_path"), F.col("length").alias("bytes"))
