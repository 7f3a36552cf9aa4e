"""Order-dependent operators: latest per key, arg-max/min, cohort choice,
best-in-column marks, forward fill and ranks.

None of them puts a whole group into one task: latest/argmax are
``max_by``/``min_by`` aggregates with partial combine; best-in-column is a
global aggregate (one row) joined back; forward fill and ranks split the
ordered rows into bounded chunks and carry state between chunks through a
small table.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evalpress.functions import columns as C


def _cols(xs) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Newest row per key by ``order`` (ties broken by later order columns).
    ``max_by`` over a struct of the whole row: partial aggregation per task."""
    others = [c for c in df.columns if c not in keys]
    ordering = F.struct(*_cols(order))
    best = F.max_by(F.struct(*[F.col(c) for c in others]), ordering).alias("_row")
    return df.groupBy(*keys).agg(best).select(*keys, "_row.*")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """First row per key by ``order`` (the "first seen wins" rule)."""
    others = [c for c in df.columns if c not in keys]
    best = F.min_by(F.struct(*[F.col(c) for c in others]), F.struct(*_cols(order))).alias("_row")
    return df.groupBy(*keys).agg(best).select(*keys, "_row.*")


def argmax_first(df: DataFrame, metric: str, position: str | Column, group: Sequence[str] = ()) -> DataFrame:
    """Row with the highest metric, null counted as 0, first position on ties."""
    pos = F.col(position) if isinstance(position, str) else position
    key = F.struct(-F.coalesce(F.col(metric).cast("double"), F.lit(0.0)), pos)
    row = F.min_by(F.struct(*[F.col(c) for c in df.columns if c not in group]), key).alias("_row")
    return df.groupBy(*group).agg(row).select(*group, "_row.*")


def argmin_default(df: DataFrame, metric: str, position: str | Column, default: float = 9e9,
                   group: Sequence[str] = ()) -> DataFrame:
    """Row with the lowest metric; null and zero count as ``default``."""
    m = F.col(metric).cast("double")
    pos = F.col(position) if isinstance(position, str) else position
    key = F.struct(F.when(m.isNull() | (m == 0), F.lit(default)).otherwise(m), pos)
    row = F.min_by(F.struct(*[F.col(c) for c in df.columns if c not in group]), key).alias("_row")
    return df.groupBy(*group).agg(row).select(*group, "_row.*")


def pick_cohort_pinned(classified: DataFrame, cohort: str, pin: str | None) -> DataFrame:
    """Local cohort: the pinned directory when it is a local cohort, else the
    newest local one.  Input: one row per directory; output: at most one row."""
    local = classified.where(~F.col("is_saas"))
    key = F.struct((F.col(cohort) == F.lit(pin)) if pin else F.lit(False), F.col(cohort))
    return local.agg(F.max_by(F.col(cohort), key).alias(cohort)).where(F.col(cohort).isNotNull())


def pick_cohort_latest(classified: DataFrame, cohort: str) -> DataFrame:
    """SaaS cohort: the newest directory classified SaaS."""
    return (classified.where(F.col("is_saas")).agg(F.max(cohort).alias(cohort))
            .where(F.col(cohort).isNotNull()))


def best_in_column(df: DataFrame, directions: dict[str, str], prefix: str = "best_") -> DataFrame:
    """Flag every cell equal to its column's min or max (ties all flagged,
    nulls ignored).  One global aggregate row is broadcast back; no window
    without PARTITION BY."""
    aggs = [(F.max(c) if d == "max" else F.min(c)).alias(f"_ext_{c}") for c, d in directions.items()]
    ext = df.agg(*aggs)
    joined = df.crossJoin(F.broadcast(ext))
    flags = {f"{prefix}{c}": F.coalesce(F.col(c) == F.col(f"_ext_{c}"), F.lit(False)) for c in directions}
    return joined.withColumns(flags).drop(*[f"_ext_{c}" for c in directions])


def best_shown(df: DataFrame, directions: dict[str, str]) -> DataFrame:
    """Flag the best of what is shown: a cell counts with its number as shown
    (unit and rounding included), so cells that look equal are marked alike and
    cells without a number never are.  ``x_cell`` gives ``best_x``."""
    numbers = {f"_shown_{c}": C.cell_number(c) for c in directions}
    marked = best_in_column(df.withColumns(numbers), {f"_shown_{c}": d for c, d in directions.items()})
    names = {f"best__shown_{c}": f"best_{c.removesuffix('_cell')}" for c in directions}
    return marked.drop(*numbers).withColumnsRenamed(names)


def forward_fill(df: DataFrame, part: str, order: str, value: str, out: str,
                 chunk: int = 4096) -> DataFrame:
    """Attach to each row the last non-null ``value`` at or before it within
    ``part`` ordered by ``order`` (an integer position).

    Rows are cut into chunks of ``chunk`` consecutive positions.  Inside a
    chunk the fill is a window over at most ``chunk`` rows; each chunk's last
    value goes to a small table (one row per chunk) whose running fill gives
    the carry-in of the next chunk.  A document holding a third of all lines
    is therefore spread over many tasks.
    """
    c = df.withColumn("_chunk", F.floor(F.col(order) / chunk))
    w_in = (Window.partitionBy(part, "_chunk").orderBy(order)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = c.withColumn("_local", F.last(value, ignorenulls=True).over(w_in))
    # one row per chunk: its last non-null value (rows with a null value have
    # a null ordering and are skipped by max_by)
    chunks = c.groupBy(part, "_chunk").agg(
        F.max_by(F.col(value), F.when(F.col(value).isNotNull(), F.col(order))).alias("_tail"))
    w_chunks = (Window.partitionBy(part).orderBy("_chunk")
                .rowsBetween(Window.unboundedPreceding, -1))
    carry = chunks.withColumn("_carry", F.last("_tail", ignorenulls=True).over(w_chunks)).drop("_tail")
    carry = carry.select(F.col(part).alias("_cpart"), F.col("_chunk").alias("_cchunk"), "_carry")
    same = F.col(part).eqNullSafe(F.col("_cpart")) & F.col("_chunk").eqNullSafe(F.col("_cchunk"))
    res = local.join(carry, same, "left")
    return res.withColumn(out, F.coalesce("_local", "_carry")).drop("_chunk", "_local", "_carry", "_cpart", "_cchunk")


def rank_within(df: DataFrame, part: Sequence[str], order: Sequence[Column], out: str = "rank",
                num_partitions: int | None = None) -> DataFrame:
    """Dense 1-based row number per ``part`` following ``order``.

    Range partitioning on (part, order) balances rows by sampled bounds, so a
    cohort with a third of all rows spreads over many tasks.  Each task
    numbers its rows; the offset of a (task, cohort) pair is the sum of
    earlier tasks' counts for that cohort, computed on a table with one row
    per (task, cohort).  ``order`` must be a total order (add a unique key).
    """
    part = list(part)
    sort_cols = [F.col(p) for p in part] + list(order)
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *sort_cols).withColumn("_pid", F.spark_partition_id())
    w = Window.partitionBy("_pid", *part).orderBy(*order)
    # the task ids must be the same for the counts and the rows they offset:
    # cut lineage once (reliable checkpoint in the shared checkpoint dir)
    from evalpress.plans.stage import checkpointed
    numbered = checkpointed(ranged.withColumn("_rn", F.row_number().over(w)))
    counts = numbered.groupBy("_pid", *part).agg(F.count(F.lit(1)).alias("_cnt"))
    w_off = Window.partitionBy(*part).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    if not part:
        w_off = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_cnt").over(w_off), F.lit(0))).drop("_cnt")
    return (numbered.join(offsets, ["_pid", *part])
            .withColumn(out, (F.col("_off") + F.col("_rn")).cast("long"))
            .drop("_pid", "_rn", "_off"))


def discover_json_keys(df: DataFrame, json_col: str, position: str, hidden: Sequence[str] = ()) -> DataFrame:
    """Names whose value is a JSON number in any row's object, whatever the
    names are: (key, first_row, first_kpos) by the least row and the place of
    the key in that row's text, minus hidden keys.  Values are typed as VARIANT,
    so the text "1" is no number; unreadable text gives no keys."""
    d = df.select(F.col(position).alias("_row"), F.col(json_col).alias("_json"), F.try_parse_json(json_col).alias("_v"))
    d = d.where(F.schema_of_variant("_v").startswith("OBJECT"))
    e = d.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("_v").outer()))
    number = F.schema_of_variant("value").rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$")
    e = (e.where(number & ~F.col("key").isin(list(hidden)))
         .select("key", F.struct("_row", (F.array_position(F.json_object_keys("_json"), F.col("key")) - 1).alias("_kpos")).alias("_at")))
    return (e.groupBy("key").agg(F.min("_at").alias("_first"))
            .select("key", F.col("_first._row").alias("first_row"), F.col("_first._kpos").cast("int").alias("first_kpos")))


def typed_sort_keys(df: DataFrame, cell: str) -> DataFrame:
    """Sort keys for a display column: numeric when every non-blank cell is a
    number with optional unit, else natural text order; blanks last.  The
    column type is decided by one global aggregate (one row, broadcast)."""
    k = df.withColumns({"_blank": C.cell_blank(cell), "_num": C.cell_number(cell)})
    kind = k.agg(F.min(F.col("_blank") | F.col("_num").isNotNull()).alias("_all_num"))
    k = k.crossJoin(F.broadcast(kind))
    return k.withColumns({
        "_num_key": F.when(F.col("_all_num"), F.col("_num")),
        "_text_key": F.when(~F.col("_all_num"), C.natural_sort_key(cell)),
    }).drop("_num", "_all_num")
