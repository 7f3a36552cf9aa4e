"""Audits of the built dataset (ops 89-93, 96)."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evalpress.operators.lookups import MISSING


def expected_counts(rows: DataFrame, expected: Mapping[str, int] | DataFrame, config: str = "config") -> DataFrame:
    """Actual rows per config against the expectations, given as a mapping or as
    a table (config, expected) (full outer)."""
    exp = expected
    if not isinstance(expected, DataFrame):
        exp = rows.sparkSession.createDataFrame(list(expected.items()), f"{config} string, expected int")
    act = rows.groupBy(config).agg(F.count(F.lit(1)).alias("actual"))
    j = act.join(exp, config, "full_outer")
    return j.select(config, F.coalesce("actual", F.lit(0)).alias("actual"), "expected",
                    (F.coalesce("actual", F.lit(0)) == F.coalesce("expected", F.lit(-1))).alias("ok"))


def one_to_one(rows: DataFrame, runs: DataFrame, key: str = "run_id", config: str = "config") -> DataFrame:
    """Per config: metric rows, run-metadata rows, different keys of the metric
    rows, keys that are not exactly once on both sides, verdict.  One
    aggregation per key over both sides, then one per config."""
    side = lambda d, r, m: d.select(config, key, F.lit(r).alias("_r"), F.lit(m).alias("_m"))
    per = (side(rows, 1, 0).unionByName(side(runs, 0, 1)).groupBy(config, key)
           .agg(F.sum("_r").alias("_r"), F.sum("_m").alias("_m")))
    off = (F.col("_r") != 1) | (F.col("_m") != 1) | F.col(key).isNull()
    j = per.groupBy(config).agg(F.sum("_r").alias("n_rows"), F.sum("_m").alias("n_runs"),
                                F.count_if((F.col("_r") > 0) & F.col(key).isNotNull()).alias("n_keys"),
                                F.count_if(off).alias("n_unmatched"))
    return j.withColumn("one_to_one", F.col("n_unmatched") == 0)


def unmatched_keys(rows: DataFrame, runs: DataFrame, key: str = "run_id", config: str | None = None) -> DataFrame:
    """Keys (of a ``config``, if given) missing on either side, duplicated or
    null.  One aggregation over both sides, as in ``one_to_one``."""
    by = [key] if config is None else [config, key]
    side = lambda d, r, m: d.select(*by, F.lit(r).alias("_r"), F.lit(m).alias("_m"))
    per = side(rows, 1, 0).unionByName(side(runs, 0, 1)).groupBy(*by).agg(F.sum("_r").alias("n_rows"), F.sum("_m").alias("n_runs"))
    return per.where((F.col("n_rows") != 1) | (F.col("n_runs") != 1) | F.col(key).isNull())


def string_columns(schema: T.StructType, prefix: str = "") -> list[str]:
    """Paths of every string leaf, nested structs included (arrays excluded)."""
    out = []
    for f in schema.fields:
        path = f"{prefix}{f.name}"
        if isinstance(f.dataType, T.StringType):
            out.append(path)
        elif isinstance(f.dataType, T.StructType):
            out.extend(string_columns(f.dataType, path + "."))
    return out


def _matches(pattern: str):
    return lambda x: x.rlike(pattern)


def _field(name: str):
    return lambda x: x.getField(name)


def _counted(df: DataFrame, cells: Sequence[tuple[str, Column, bool]], rules: Sequence[tuple[str, str]]) -> DataFrame:
    """Findings per (column, rule) by one aggregate: a counter for each pair,
    so no row is multiplied and nothing but the counters is shuffled.  A cell is
    (name, value, whether the value is an array of strings)."""
    names, counters = [], []
    for name, v, many in cells:
        for rule, pattern in rules:
            hits = (F.sum(F.size(F.filter(v, _matches(pattern)))) if many else F.count_if(v.rlike(pattern)))
            counters.append(F.coalesce(hits, F.lit(0)).cast("long").alias(f"_{len(names)}"))
            names.append((name, rule))
    one = df.agg(*counters)
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(r).alias("rule"), F.col(f"_{k}").alias("n"))
                     for k, (c, r) in enumerate(names)])
    return one.select(F.inline(rows)).where("n > 0")


def leak_columns(df: DataFrame, columns: Sequence[str], rules: Sequence[tuple[str, str]]) -> DataFrame:
    """Values of the string columns that match a rule, per (column, rule)."""
    return _counted(df, [(c, F.col(c if "." in c else f"`{c}`"), False) for c in columns], rules)


def _leaves(v: Column, dt: T.DataType, path: str) -> list[tuple[str, Column, bool]]:
    """(path, value, in an array) of every string leaf, through structs, arrays
    and map values."""
    if isinstance(dt, T.StringType):
        return [(path, v, False)]
    if isinstance(dt, T.StructType):
        return [x for f in dt.fields for x in _leaves(v.getField(f.name), f.dataType, f"{path}.{f.name}")]
    if isinstance(dt, T.MapType):
        return _leaves(F.map_values(v), T.ArrayType(dt.valueType), path)
    if not isinstance(dt, T.ArrayType):
        return []
    inner = dt.elementType
    if isinstance(inner, T.StringType):
        return [(path, v, True)]
    if isinstance(inner, T.StructType):
        return [x for f in inner.fields
                for x in _leaves(F.transform(v, _field(f.name)), T.ArrayType(f.dataType), f"{path}.{f.name}")]
    if isinstance(inner, T.MapType):
        return _leaves(F.flatten(F.transform(v, lambda m: F.map_values(m))), T.ArrayType(inner.valueType), path)
    return _leaves(F.flatten(v), inner, path) if isinstance(inner, T.ArrayType) else []


def leak_all(df: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """``leak_columns`` over every string of a table, those in structs, arrays
    and maps included: findings per (column, rule)."""
    return _counted(df, [x for f in df.schema.fields for x in _leaves(F.col(f"`{f.name}`"), f.dataType, f.name)], rules)


def leak_files(spark: SparkSession, paths: str | Sequence[str], rules: Sequence[tuple[str, str]], cut: int = 40) -> DataFrame:
    """(file, rule, match) of every finding in written text files, whatever they
    hold; each line is read once."""
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("file"))
    return leak_text(lines, "file", "value", rules, cut)


def leak_text(df: DataFrame, key: str, text: str, rules: Sequence[tuple[str, str]], cut: int = 40) -> DataFrame:
    """One finding per match, the match cut to ``cut`` characters.  One pass
    over the table: every rule is a literal-pattern ``regexp_extract_all``,
    the per-rule match lists are concatenated and exploded once."""
    def tagged(name: str, pattern: str):
        return F.transform(F.regexp_extract_all(F.col(text), F.lit(pattern), 0),
                           lambda m: F.struct(F.lit(name).alias("rule"), m.alias("m")))

    per_rule = [tagged(n, p) for n, p in rules]
    found = df.select(F.col(key), F.explode(F.concat(*per_rule)).alias("f"))
    return found.select(key, F.col("f.rule").alias("rule"), F.substring("f.m", 1, cut).alias("match"))


def json_paths(df: DataFrame, col: str) -> DataFrame:
    """(key, n) of every key in the JSON objects of a column, at any depth:
    ``a.b`` is b in a, ``a[].b`` is b in an object of the array a; n counts the
    values.  Levels are exploded until none has an object or array left, which a
    look for one row tells, so nothing is cut at a fixed depth.  Text that is no
    JSON object gives no keys."""
    v = df.select(F.try_parse_json(col).alias("_v"))
    explode = df.sparkSession.tvf.variant_explode
    level = v.where(F.schema_of_variant("_v").startswith("OBJECT")).select(F.lit("").alias("_at"), "_v")
    found = None
    while not level.isEmpty():
        e = level.lateralJoin(explode(F.col("_v").outer())).select(
            F.when(F.col("key").isNull(), F.concat("_at", F.lit("[]")))
            .when(F.col("_at") == "", F.col("key")).otherwise(F.concat("_at", F.lit("."), "key")).alias("_at"),
            F.col("key").isNotNull().alias("_named"), F.col("value").alias("_v"))
        names = e.where("_named").select(F.col("_at").alias("key"))
        found = names if found is None else found.unionByName(names)
        level = e.where(F.schema_of_variant("_v").rlike("^(OBJECT|ARRAY)")).select("_at", "_v")
    if found is None:
        return df.sparkSession.createDataFrame([], "key string, n long")
    return found.groupBy("key").agg(F.count(F.lit(1)).alias("n"))


def withheld(key: Column | str, pattern: str) -> Column:
    """Whether a part of a key path has a name that is never published."""
    k = F.col(key) if isinstance(key, str) else key
    return F.exists(F.split(F.regexp_replace(k, r"\[\]", ""), r"\."), lambda part: part.rlike(pattern))


def field_names(spark: SparkSession, tables: Mapping[str, T.StructType], pattern: str) -> DataFrame:
    """Column names (all nesting levels) with a flag for the withheld pattern."""
    import re
    rows = []

    def walk(t, st, prefix):
        for f in st.fields:
            rows.append((t, prefix + f.name, bool(re.search(pattern, f.name))))
            dt = f.dataType
            while isinstance(dt, T.ArrayType):
                dt = dt.elementType
            if isinstance(dt, T.StructType):
                walk(t, dt, prefix + f.name + ".")

    for t, st in tables.items():
        walk(t, st, "")
    return spark.createDataFrame(rows, "table string, path string, withheld boolean")


def verdict(counts: DataFrame, leaks: DataFrame, status: DataFrame, fields: DataFrame | None = None,
            matched: DataFrame | None = None) -> DataFrame:
    """One row: all counts as expected, no leak finding, no missing id and, if
    ``fields`` (with a flag ``withheld``) is given, no withheld field, and, if
    ``matched`` (of ``one_to_one``) is given, every key once on both sides."""
    c = counts.agg(F.bool_and("ok").alias("counts_ok"))
    lk = leaks.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n_leaks"))
    ms = status.agg(F.count_if(F.col("status") == MISSING).alias("n_missing"))
    one = c.crossJoin(lk).crossJoin(ms)
    passed = F.col("counts_ok") & (F.col("n_leaks") == 0) & (F.col("n_missing") == 0)
    if fields is not None:
        one = one.crossJoin(fields.agg(F.count_if("withheld").alias("n_withheld")))
        passed = passed & (F.col("n_withheld") == 0)
    if matched is not None:
        one = one.crossJoin(matched.agg(F.coalesce(F.bool_and("one_to_one"), F.lit(True)).alias("one_to_one")))
        passed = passed & F.col("one_to_one")
    return one.withColumn("passed", passed)
