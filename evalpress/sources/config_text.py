"""Config text to records (ops 4-7).

Text arrives as ordered lines ``(doc, pos, line)``; the "last opened record"
state of a line-by-line reader becomes a forward fill over (doc, pos), which
is chunked so one huge document still spreads over many tasks.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evalpress.functions import columns as C
from evalpress.operators.pick import forward_fill

# FIXED VALUES: line patterns of the config files
NAME_LINE = r'^\s*-\s*name:\s*"?([^"#\n]+?)"?\s*$'
FIELD_LINE = r'^\s+({keys}):\s*"?([^"#\n]+?)"?\s*$'
CHILD_LINE = r'^\s*{key}:\s*"?([^"#\s]+)"?'
META_KEYS = ("hf_repo", "release_date", "license", "provider")


def _openers(lines: DataFrame) -> DataFrame:
    name = C.nz(F.trim(F.regexp_extract("line", NAME_LINE, 1)))
    return lines.withColumn("_name", name).withColumn(
        "_opener", F.when(F.col("_name").isNotNull(), F.struct(F.col("pos").alias("opos"), F.col("_name").alias("oname"))))


def line_records(lines: DataFrame, keys: Sequence[str] = META_KEYS, doc: str = "doc",
                 pos: str = "pos") -> DataFrame:
    """A name line opens a record; later known ``key: value`` lines attach to
    the last opened record; a repeated name replaces the earlier record
    entirely (last block wins).  Output: one row per name, one column per key."""
    field_re = FIELD_LINE.format(keys="|".join(keys))
    o = _openers(lines.select(F.col(doc).alias("doc"), F.col(pos).alias("pos"), "line"))
    filled = forward_fill(o, "doc", "pos", "_opener", "_owner")
    fields = (filled.where(F.col("_name").isNull() & F.col("_owner").isNotNull()
                           & F.col("line").rlike(field_re))
              .select(F.col("_owner.oname").alias("name"), "doc", F.col("_owner.opos").alias("opos"),
                      F.regexp_extract("line", field_re, 1).alias("key"),
                      F.trim(F.regexp_extract("line", field_re, 2)).alias("value"), "pos"))
    # the last block per name (document order, then position)
    blocks = o.where(F.col("_name").isNotNull()).groupBy(F.col("_name").alias("name")).agg(
        F.max(F.struct("doc", "pos")).alias("_last"))
    per_key = fields.groupBy("name", "doc", "opos", "key").agg(F.max_by("value", "pos").alias("value"))
    kept = per_key.join(blocks, "name").where(
        (F.col("_last.doc") == F.col("doc")) & (F.col("_last.pos") == F.col("opos")))
    wide = kept.groupBy("name").agg(*[F.max(F.when(F.col("key") == k, F.col("value"))).alias(k) for k in keys])
    return blocks.select("name").join(wide, "name", "left")


def first_child(lines: DataFrame, key: str = "dir", doc: str = "doc", pos: str = "pos") -> DataFrame:
    """Only the first ``key:`` line after a name counts, then the name is
    closed; a later block of the same name with such a line replaces it."""
    child_re = CHILD_LINE.format(key=key)
    o = _openers(lines.select(F.col(doc).alias("doc"), F.col(pos).alias("pos"), "line"))
    filled = forward_fill(o, "doc", "pos", "_opener", "_owner")
    kids = (filled.where(F.col("_name").isNull() & F.col("_owner").isNotNull() & F.col("line").rlike(child_re))
            .select(F.col("_owner.oname").alias("name"), "doc", F.col("_owner.opos").alias("opos"), "pos",
                    F.regexp_extract("line", child_re, 1).alias(key)))
    first = kids.groupBy("name", "doc", "opos").agg(F.min_by(key, "pos").alias(key))
    return first.groupBy("name").agg(F.max_by(key, F.struct("doc", "opos")).alias(key))


def split_blocks(df: DataFrame, text: str, delimiter: str, keys: Sequence[str]) -> DataFrame:
    """Split a text at a delimiter regex, drop the preamble (block 0) and keep
    each block with its 1-based position."""
    parts = F.posexplode(F.split(F.col(text), delimiter))
    return (df.select(*keys, parts.alias("block_no", "block"))
            .where(F.col("block_no") > 0))


def block_field(block: Column | str, pattern: str, group: int = 1) -> Column:
    b = F.col(block) if isinstance(block, str) else block
    return C.nz(F.regexp_extract(b, pattern, group))


def keyed_json(df: DataFrame, text: str, value_type: T.DataType, key_name: str = "id") -> DataFrame:
    """JSON object keyed by id -> lookup rows; unreadable text gives no rows."""
    parsed = F.from_json(F.col(text), T.MapType(T.StringType(), value_type), {"mode": "PERMISSIVE"})
    return df.select(F.explode(parsed).alias(key_name, "_v")).select(key_name, "_v.*")
