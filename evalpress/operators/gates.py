"""Gates over reports and cohorts.

All are aggregations with partial (map-side) combine: a report or a run
directory holding a third of the rows only meets the tiny final merge.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evalpress.constants import ERROR_VERDICT


def case_counts(cases: DataFrame, keys: Sequence[str], verdict: str = "verdict",
                error: str = ERROR_VERDICT) -> DataFrame:
    """Total and error cases per report (op 41, flat input)."""
    return cases.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col(verdict) == error).alias("err"))


def map_case_counts(playbooks: Column | str, total_field: str = "total",
                    error_field: str = "n_error") -> tuple[Column, Column]:
    """Total and error cases folded over a map of playbook aggregates, row
    local (op 41 on nested input: no shuffle)."""
    m = F.col(playbooks) if isinstance(playbooks, str) else playbooks
    vals = F.map_values(m)
    total = F.aggregate(vals, F.lit(0).cast("long"), lambda acc, v: acc + F.coalesce(v[total_field], F.lit(0)))
    err = F.aggregate(vals, F.lit(0).cast("long"), lambda acc, v: acc + F.coalesce(v[error_field], F.lit(0)))
    return total, err


def error_share_ok(total: Column | str = "total", err: Column | str = "err",
                   max_share: tuple[int, int] = (3, 10)) -> Column:
    """``total > 0 and err/total <= num/den`` in integer arithmetic (0.3 itself passes)."""
    t = F.col(total) if isinstance(total, str) else total
    e = F.col(err) if isinstance(err, str) else err
    num, den = max_share
    return (t > 0) & (e * den <= t * num)


def gate_error_rate(counts: DataFrame, total: str = "total", err: str = "err",
                    max_share: tuple[int, int] = (3, 10)) -> DataFrame:
    return counts.where(error_share_ok(total, err, max_share))


def validity(counts: DataFrame, total: str = "total", err: str = "err",
             max_share: tuple[int, int] = (3, 10)) -> DataFrame:
    """Keep every report with its error rate (1.0 without results) and flag."""
    t, e = F.col(total), F.col(err)
    return counts.withColumns({
        "err_rate": F.when(t > 0, e.cast("double") / t).otherwise(F.lit(1.0)),
        "valid": error_share_ok(total, err, max_share),
    })


def cohort_sizes(df: DataFrame, cohort: str, name: str = "n") -> DataFrame:
    return df.groupBy(cohort).agg(F.count(F.lit(1)).alias(name))


def min_cohort(df: DataFrame, cohort: str, min_rows: int = 3) -> DataFrame:
    """Drop run directories with fewer than ``min_rows`` rows.  The counts are
    one row per directory, joined back by key."""
    keep = cohort_sizes(df, cohort, "_n").where(F.col("_n") >= min_rows).select(cohort)
    return df.join(keep, cohort, "left_semi")


def classify_cohort(rows: DataFrame, cohort: str, flag: str) -> DataFrame:
    """A directory is SaaS when flagged rows * 2 >= rows (after the gates)."""
    return rows.groupBy(cohort).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.col(flag).cast("int")).cast("long").alias("n_flagged"),
    ).withColumn("is_saas", F.col("n_flagged") * 2 >= F.col("n_rows"))


def zero_or_null(col: Column | str) -> Column:
    """Validity rule: an error count of 0 or null is valid."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c, F.lit(0)) == 0
