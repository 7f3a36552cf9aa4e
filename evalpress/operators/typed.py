"""Typed projection with lenient casts (ops 21, 22)."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evalpress.functions import columns as C


def cast_lenient(col: Column, dtype: T.DataType) -> Column:
    """'' and null -> null; int via double, truncated; bad number -> null;
    date from the first 10 characters (a bad date fails); bool by truthiness;
    anything else as text."""
    if isinstance(dtype, T.IntegerType):
        return C.lenient_int(col)
    if isinstance(dtype, T.DoubleType):
        return C.lenient_double(col)
    if isinstance(dtype, T.DateType):
        return C.strict_date(col)
    if isinstance(dtype, T.BooleanType):
        return C.truthy(col)
    return C.nz(col.cast("string"))


def project_typed(df: DataFrame, columns: Sequence[tuple[str, T.DataType]],
                  source: Mapping[str, str] | None = None) -> DataFrame:
    """Declared columns in order: present ones cast leniently (typed inputs
    keep their value), missing ones null of the declared type, undeclared
    ones dropped."""
    source = source or {}
    have = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for name, dtype in columns:
        src = source.get(name, name)
        if src not in have:
            out.append(F.lit(None).cast(dtype).alias(name))
        elif have[src] == dtype:
            out.append(F.col(src).alias(name))
        elif isinstance(have[src], T.StringType):
            out.append(cast_lenient(F.col(src), dtype).alias(name))
        elif isinstance(dtype, T.BooleanType) and isinstance(have[src], T.NumericType):
            out.append((F.col(src) != 0).alias(name))
        else:
            out.append(cast_lenient(F.col(src).cast("string"), dtype).alias(name))
    return df.select(*out)
