"""Lookups: metadata, revision, license precedence, first-needle rules,
registry status and the status cache (ops 30-33, 39, 40, 48, 95).

Dimension tables here are data (they grow with the input), so none is
hinted for broadcast: AQE broadcasts a side only after measuring it below
``spark.sql.autoBroadcastJoinThreshold`` and otherwise keeps a shuffle join.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evalpress.constants import NO_VALUE, REGISTRY_STATUSES, SAAS_LICENSE_DEFAULT

OK, GATED, MISSING, UNDETERMINED, ERROR = REGISTRY_STATUSES
from evalpress.functions import columns as C


def first_needle_case(text: Column | str, rules: Sequence[tuple[int, str, str]], default=None) -> Column:
    """First rule in list order whose needle occurs in the lower-cased text.
    The rule list is a parameter of bounded size, compiled into one CASE."""
    low = F.lower(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))
    expr = None
    for _no, needle, label in sorted(rules):
        cond = low.contains(needle.lower())
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default))


def license_for(profile: Column, is_saas: Column, cache_license: Column, meta_license: Column) -> Column:
    """SaaS: provider label, else a fixed text.  Local: cache unless empty or a
    dash, else metadata license, else a dash."""
    saas = C.provider_case(profile, 1, SAAS_LICENSE_DEFAULT)
    cached = F.when(cache_license.isNotNull() & (cache_license != "") & (cache_license != NO_VALUE), cache_license)
    local = F.coalesce(cached, C.nz(meta_license), F.lit(NO_VALUE))
    return F.when(is_saas, saas).otherwise(local)


def with_license(df: DataFrame, lic_cache: DataFrame, meta: DataFrame, profile: str = "profile",
                 name: str = "name", is_saas: str = "is_saas", out: str = "license") -> DataFrame:
    cache = lic_cache.select(F.col("profile").alias("_lc_profile"), F.col("license").alias("_lc_license"))
    m = meta.select(F.col("name").alias("_m_name"), F.col("license").alias("_m_license"))
    j = (df.join(cache, F.col(profile) == F.col("_lc_profile"), "left")
         .join(m, F.col(name) == F.col("_m_name"), "left"))
    return j.withColumn(out, license_for(F.coalesce(F.col(profile), F.lit("")), F.col(is_saas),
                                         F.col("_lc_license"), F.col("_m_license"))
                        ).drop("_lc_profile", "_lc_license", "_m_name", "_m_license")


def registry_status(ids: DataFrame, cache: DataFrame, store: DataFrame, mode: str,
                    id_col: str = "id") -> DataFrame:
    """Status per id: the cached answer for this access mode, else ok when the
    store holds the id, else undetermined; an undetermined id that the store
    holds is lifted to ok."""
    c = (cache.where(F.col("mode") == mode)
         .select(F.col("id").alias("_c_id"), F.col("status").alias("_c_status"), F.col("detail").alias("_c_detail")))
    s = store.select(F.col("id").alias("_s_id")).distinct().withColumn("_in_store", F.lit(True))
    j = (ids.select(id_col).where(F.col(id_col).isNotNull()).distinct()
         .join(c, F.col(id_col) == F.col("_c_id"), "left")
         .join(s, F.col(id_col) == F.col("_s_id"), "left"))
    in_store = F.coalesce(F.col("_in_store"), F.lit(False))
    first = F.coalesce(F.col("_c_status"), F.when(in_store, F.lit(OK)).otherwise(F.lit(UNDETERMINED)))
    detail = F.when(F.col("_c_status").isNotNull(), F.col("_c_detail")).otherwise(F.lit("offline"))
    lifted = (first == UNDETERMINED) & in_store
    return j.select(
        F.col(id_col).alias("id"),
        F.when(lifted, F.lit(OK)).otherwise(first).alias("status"),
        F.when(lifted, F.lit("in store")).otherwise(detail).alias("detail"),
        in_store.alias("in_store"))


def merge_status_cache(ids: DataFrame, cache: DataFrame, store: DataFrame, mode: str) -> DataFrame:
    """Only ids without a cached answer for ``mode`` are looked up (answers
    from the store table); the new answers are appended to the cache."""
    ids = ids.select("id").where(F.col("id").isNotNull()).distinct()
    cached_ids = cache.where(F.col("mode") == mode).select("id")
    new = ids.join(cached_ids, "id", "left_anti")
    s = store.select("id").distinct().withColumn("_in_store", F.lit(True))
    answers = new.join(s, "id", "left").select(
        "id", F.lit(mode).alias("mode"),
        F.when(F.col("_in_store"), F.lit(OK)).otherwise(F.lit(UNDETERMINED)).alias("status"),
        F.lit("looked up").alias("detail"), F.lit("new").alias("origin"))
    old = cache.select("id", "mode", "status", "detail", F.lit("cached").alias("origin"))
    return old.unionByName(answers)


def status_counts(status: DataFrame) -> DataFrame:
    """Ids per status with the resolved share; ids stay rows, never one list."""
    per = status.groupBy("status").agg(F.count(F.lit(1)).alias("n_ids"))
    # the total comes from the per-status table (a handful of rows), so the
    # status table itself is read once
    tot = per.agg(F.sum("n_ids").alias("_total"),
                  F.coalesce(F.sum(F.when(F.col("status") == OK, F.col("n_ids"))), F.lit(0)).alias("_ok"))
    return per.crossJoin(F.broadcast(tot)).select(
        "status", "n_ids", (F.col("_ok").cast("double") / F.col("_total")).alias("ok_share"))
