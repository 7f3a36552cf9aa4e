"""Operators on nested report columns; all are row-local higher-order
functions (no shuffle)."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def map_to_sorted_structs(m: Column, key_name: str) -> Column:
    """map<name, struct> -> array<struct<name, ...>> sorted by name; null stays
    null.  Names become values, so a new name does not change the schema."""
    entries = F.array_sort(F.map_entries(m))
    return F.transform(entries, lambda e: e["value"].withField(key_name, e["key"]))


def first_match(arr: Column, field: str, value: str) -> Column:
    """First element whose ``field`` equals ``value``; null when none."""
    return F.try_element_at(F.filter(arr, lambda x: x[field] == F.lit(value)), F.lit(1))


def playbook_aggregates(m: Column, keep: Sequence[str] = ("pass_rate", "mean_score", "total", "passed"),
                        list_len: str = "knockouts") -> Column:
    """Per playbook keep only aggregates and the length of one list; the case
    lists never leave this expression."""
    return F.transform_values(m, lambda k, v: F.struct(
        *[v[f].alias(f) for f in keep],
        F.coalesce(F.size(v[list_len]), F.lit(0)).cast("int").alias(list_len)))


def fold_sum(m: Column, fn) -> Column:
    """Sum of ``fn(value)`` over a map's values."""
    return F.aggregate(F.map_values(m), F.lit(0).cast("long"), lambda acc, v: acc + F.coalesce(fn(v), F.lit(0)))
