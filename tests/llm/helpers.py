"""Small documents tables for the text operators."""
from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: names that operators use inside; a table may have them too
CLASH = ("_id", "_h", "_row", "key", "part", "kind", "node", "label", "score", "_next", "keys", "_gone", "n_bytes")


def docs(spark: SparkSession, rows: list[tuple], clash: bool = False) -> DataFrame:
    """Rows (doc_id, text[, lang]) as documents, with clashing extra columns."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", None, len(r[1]) if r[1] is not None else None) for r in rows]
    df = spark.createDataFrame(full, SCHEMA)
    if clash:
        from pyspark.sql import functions as F
        df = df.select("*", *[F.lit(f"x{i}").alias(c) for i, c in enumerate(CLASH)])
    return df


def words(rng: random.Random, n: int, base: int = 400) -> str:
    return " ".join("w%d" % rng.randrange(base) for _ in range(n))


def collected(df: DataFrame) -> list[dict]:
    return [r.asDict() for r in df.collect()]
