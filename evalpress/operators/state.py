"""Incremental state: change-stamped snapshot (op 94)."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def change_date(new: DataFrame, prev: DataFrame, key: str, content_hash: Column, stamp: Column) -> DataFrame:
    """Keep the previous date while the content hash is unchanged, stamp the
    new date otherwise; new keys get the new date; deleted keys disappear."""
    n = new.select(F.col(key), content_hash.alias("hash"))
    p = prev.select(F.col(key), F.col("hash").alias("_prev_hash"), F.col("stamp").alias("_prev_stamp"))
    j = n.join(p, key, "left")
    change = (F.when(F.col("_prev_hash").isNull(), F.lit("new"))
              .when(F.col("_prev_hash") == F.col("hash"), F.lit("unchanged")).otherwise(F.lit("changed")))
    return j.select(key, "hash",
                    F.when(change == "unchanged", F.col("_prev_stamp")).otherwise(stamp).alias("stamp"),
                    change.alias("change"))
