"""Publication filter: allow-list, deny-list, raw fields, withheld playbooks."""
from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evalpress.constants import RAW_FIELDS, RAW_SUFFIXES


class PublicationError(RuntimeError):
    """Raised when the publication filter cannot decide (fail closed)."""


def require_allow_list(allowed: Sequence[str]) -> tuple[str, ...]:
    """An empty allow-list aborts instead of allowing everything."""
    names = tuple(a for a in allowed if a)
    if not names:
        raise PublicationError("no playbook is released: the allow-list is empty, nothing is built")
    return names


def allowed_flag(col: Column | str, allowed: Sequence[str]) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.isin(list(require_allow_list(allowed)))


def filter_allowed(df: DataFrame, col: str, allowed: Sequence[str]) -> DataFrame:
    """Keep rows whose ``col`` is on the allow-list (a bounded list of names,
    evaluated in the scan as an ``In`` predicate)."""
    return df.where(allowed_flag(col, allowed))


def filter_allowed_df(df: DataFrame, col: str, allow_df: DataFrame, allow_col: str = "name") -> DataFrame:
    """Allow-list as a DataFrame (read from config).  Emptiness is checked
    with one tiny job before the plan is built (an in-plan ``raise_error``
    can be skipped when the optimizer proves the semi join empty), so an
    empty or unreadable list aborts instead of publishing nothing silently."""
    if allow_df.select(allow_col).where(F.col(allow_col).isNotNull()).limit(1).count() == 0:
        raise PublicationError("no playbook is released: the allow-list is empty, nothing is built")
    return df.join(allow_df.select(F.col(allow_col).alias(col)).distinct(), col, "left_semi")


def filter_map_keys(map_col: Column | str, allowed: Sequence[str]) -> Column:
    """Allow-list applied to a map's keys before it is exploded."""
    names = require_allow_list(allowed)
    m = F.col(map_col) if isinstance(map_col, str) else map_col
    arr = F.array(*[F.lit(a) for a in names])
    return F.map_filter(m, lambda k, v: F.array_contains(arr, k))


def exclude_subjects(df: DataFrame, col: str, deny: DataFrame, deny_col: str = "name") -> DataFrame:
    """Deny-list: drop rows whose subject is listed.  The list is data, so it
    is not hinted; AQE broadcasts it when its measured size allows."""
    return df.join(deny.select(F.col(deny_col).alias(col)).distinct(), col, "left_anti")


def is_raw_field(name: str) -> bool:
    return name in RAW_FIELDS or name.endswith(RAW_SUFFIXES)


def raw_paths(schema: T.StructType, exempt: Iterable[str] = (), top_level_only: bool = False,
              prefix: str = "") -> list[str]:
    """Paths of raw fields in a schema (driver-side walk over names only)."""
    exempt = set(exempt)
    out = []
    for f in schema.fields:
        path = prefix + f.name
        if is_raw_field(f.name) and path not in exempt:
            out.append(path)
            continue
        if top_level_only:
            continue
        dt = f.dataType
        while isinstance(dt, (T.ArrayType, T.MapType)):
            dt = dt.elementType if isinstance(dt, T.ArrayType) else dt.valueType
        if isinstance(dt, T.StructType):
            out.extend(raw_paths(dt, exempt, False, path + "."))
    return out


def _without_raw(col: Column, dt: T.DataType, exempt: set[str], path: str) -> Column | None:
    """``col`` without raw fields at any depth, through structs, arrays and map
    values; None if there is nothing to remove."""
    if isinstance(dt, T.ArrayType):
        if _without_raw(F.lit(None), dt.elementType, exempt, path) is None:
            return None
        return F.transform(col, lambda x: _without_raw(x, dt.elementType, exempt, path))
    if isinstance(dt, T.MapType):
        if _without_raw(F.lit(None), dt.valueType, exempt, path) is None:
            return None
        return F.transform_values(col, lambda _, v: _without_raw(v, dt.valueType, exempt, path))
    if not isinstance(dt, T.StructType):
        return None
    kept, changed = [], False
    for f in dt.fields:
        own = f"{path}.{f.name}"
        if is_raw_field(f.name) and own not in exempt:
            changed = True
            continue
        inner = _without_raw(col.getField(f.name), f.dataType, exempt, own)
        changed = changed or inner is not None
        kept.append((col.getField(f.name) if inner is None else inner).alias(f.name))
    if not changed:
        return None
    if not kept:
        raise PublicationError(f"every field of {path} is a raw field")
    return F.when(col.isNotNull(), F.struct(*kept))


def drop_raw_fields(df: DataFrame, exempt: Iterable[str] = ()) -> DataFrame:
    """Remove raw fields at any depth: columns, fields of structs, of structs in
    arrays and in map values.  Paths name fields only (``cases.response``)."""
    exempt = set(exempt)
    out = []
    for f in df.schema.fields:
        if is_raw_field(f.name) and f.name not in exempt:
            continue
        col = F.col(f"`{f.name}`")
        clean = _without_raw(col, f.dataType, exempt, f.name)
        out.append(col if clean is None else clean.alias(f.name))
    return df.select(*out)


def assert_no_raw_fields(df: DataFrame, origin: str = "", exempt: Iterable[str] = (),
                         top_level_only: bool = True) -> DataFrame:
    """Last gate before writing: raise when a raw field is present; never
    clean silently.  Runs on the schema, before any job."""
    bad = sorted(raw_paths(df.schema, exempt, top_level_only))
    if bad:
        where = f" ({origin})" if origin else ""
        raise PublicationError(f"raw field in dataset row{where}: {', '.join(bad)}")
    return df


def raw_field_report(spark: SparkSession, tables: dict[str, T.StructType],
                     exempt: Iterable[str] = ()) -> DataFrame:
    """One row per (table, field path) with its verdict; the walk is over
    schema names only, the result is a small DataFrame."""
    exempt = set(exempt)
    rows = []

    def walk(tname, st, prefix):
        for f in st.fields:
            path = prefix + f.name
            rows.append((tname, path, is_raw_field(f.name) and path not in exempt, prefix == ""))
            dt = f.dataType
            while isinstance(dt, (T.ArrayType, T.MapType)):
                dt = dt.elementType if isinstance(dt, T.ArrayType) else dt.valueType
            if isinstance(dt, T.StructType):
                walk(tname, dt, path + ".")

    for tname, st in tables.items():
        walk(tname, st, "")
    return spark.createDataFrame(rows, "table string, path string, raw boolean, top_level boolean")


def withheld_playbooks(seen: DataFrame, col: str, allowed: Sequence[str]) -> DataFrame:
    """Seen minus released playbook names as one sorted list.  Distinct first,
    so the collected set is bounded by the number of playbook names."""
    names = require_allow_list(allowed)
    return (seen.select(col).where(~F.col(col).isin(list(names))).distinct()
            .agg(F.sort_array(F.collect_set(col)).alias("excluded")))
