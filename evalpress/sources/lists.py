"""Allow- and deny-lists kept as text: blocks that open with ``- name:``.

A list decides what may be published, so it fails closed: a file that is not
there fails when the plan is made, and a list without a single name fails the
job that uses it, inside the plan and without a job of its own.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evalpress.sources.config_text import block_field, split_blocks

# FIXED VALUE: what opens an entry of a list
ENTRY = r"(?m)^\s*-\s*name:\s*"


def read_list(spark: SparkSession, path: str, flag: str | None = None) -> DataFrame:
    """(name) of every entry; with ``flag`` only of those whose block says
    ``flag: true``.  Text before the first entry, comments and quotes do not
    count; a name given twice is there once."""
    text = spark.read.text(path, wholetext=True)
    blocks = split_blocks(text, "value", ENTRY, [])
    name = block_field("block", r'^"?([^"#\n]+?)"?\s*(?:#[^\n]*)?(?:\n|$)')
    if flag:
        blocks = blocks.where(F.col("block").rlike(rf"(?m)^\s+{flag}:\s*true\s*(#.*)?$"))
    return blocks.select(name.alias("name")).where(F.col("name").isNotNull()).distinct()


def keep_listed(df: DataFrame, col: str, names: DataFrame, what: str = "the allow-list") -> DataFrame:
    """Rows whose ``col`` is on the list.  The names travel as one row, as large
    as the list's text; a join with them would be left out of the plan if they
    were none, and with it the failure."""
    message = F.lit(f"{what} has no entry: nothing is published")
    one = names.agg(F.collect_set("name").alias("n")).select(
        F.when(F.size("n") == 0, F.raise_error(message).cast("array<string>")).otherwise(F.col("n")).alias("_names"))
    return df.crossJoin(F.broadcast(one)).where(F.array_contains("_names", F.col(col))).drop("_names")


def drop_listed(df: DataFrame, col: str, names: DataFrame, what: str = "the deny-list") -> DataFrame:
    """Rows whose ``col`` is not on the list (null is on no list)."""
    message = F.lit(f"{what} has no entry: nothing is published")
    one = names.agg(F.count(F.lit(1)).alias("n")).select(
        F.when(F.col("n") == 0, F.raise_error(message).cast("long")).otherwise(F.col("n")).alias("_listed"))
    return (df.crossJoin(F.broadcast(one)).where("_listed > 0").drop("_listed")
            .join(names.select(F.col("name").alias("_name")), F.col(col) == F.col("_name"), "left_anti"))


def write_list(df: DataFrame, path: str, name: str, flag: str | None = None, says: str | None = None) -> str:
    """A list as text, an entry per row; ``flag`` is written with the value of
    the column ``says``."""
    entry = F.concat(F.lit('- name: "'), F.col(name), F.lit('"\n  note: listed'))
    if flag:
        entry = F.concat(entry, F.lit(f"\n  {flag}: "), F.col(says).cast("string"))
    df.select(entry.alias("value")).write.mode("overwrite").text(path)
    return path
